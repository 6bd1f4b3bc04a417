"""WARC archives: written by Spark's own committed writer, read back by byte ranges.

Writing. Every record is a gzip member of its own. Spark's text sink writes a column's bytes as they are and ends each row
with a line separator; the separator here is a zero byte, which is the last byte of every gzip member of less than 16 MiB
(the high byte of its length). A member is handed over without that byte, so the file is an unbroken series of members. A
longer one is followed by an empty member, which ends in zero too. Tasks may be run again, as the sink commits files.

Reading. Files are cut into byte ranges. A task looks for gzip's magic bytes in its range, decodes the head of a candidate
and takes it for a member if it starts a WARC record; it owns the members that start inside its range and reads the last
one to its end, beyond the range if need be.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import Any, BinaryIO
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.llm.common import shared_path, stored

MAGIC = b"\x1f\x8b\x08"
#: Shorter payloads are never replaced by a revisit.
LEAST_PAYLOAD = 100
RANGE_BYTES = 8 * 2**20
_READ = 2**18
_STEP = 2**14


# ---- records --------------------------------------------------------------------------------------------------------

def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_EMPTY = _member(b"")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head only, whose Content-Length is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        # Line ends and other controls cannot stand in a header.
        head.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_kinds(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_type and refers_to of every row.

    Of the rows with equal payloads of at least 100 bytes, those with the smallest page_id are responses and the others
    revisit it; a row repeated with that page_id is a response again, and so is a row whose page_id is null. Payloads
    are grouped by SHA-256 with partial sums; only groups of several pages are kept, and a group of any size is never
    gathered. Whether that table is sent to all tasks or joined by shuffle is Spark's choice by its size on disk.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= LEAST_PAYLOAD).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first")
    revisit = F.coalesce(F.col("page_id") > F.col("first"), F.lit(False))
    return rows.join(stored(groups, "warc-groups"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every row of pages (page_id, url, html; null html is empty) as a record under ``path``, a new folder."""
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            out, size = [], 0
            for row in zip(*columns):
                page_id, url, payload, digest, kind, refers_to = (x.as_py() for x in row)
                member = _member(record(page_id, url, payload.encode(), digest, kind, refers_to))
                if member[-1]:
                    member += _EMPTY
                out.append(member[:-1])
                size += len(member)
                if size > 2**24:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    with_kinds(pages).mapInArrow(members, "member binary").select(
        F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


# ---- reading --------------------------------------------------------------------------------------------------------

def open_binary(uri: str) -> BinaryIO:
    """A shared file for random access; anything but a plain path goes through pyarrow's file systems."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else uri, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


class _Window:
    """Bytes of a file from any position on; what was read last is kept."""

    def __init__(self, file: BinaryIO) -> None:
        self.file, self.start, self.kept = file, 0, b""

    def at(self, position: int, size: int) -> bytes:
        """Up to ``size`` bytes from a position; none only at the end of the file."""
        inside = position - self.start
        if not 0 <= inside <= len(self.kept) - size:
            self.file.seek(position)
            self.start, self.kept, inside = position, self.file.read(max(size, _READ)), 0
        return self.kept[inside:inside + size]


def member_at(window: _Window, position: int) -> tuple[bytes, int] | None:
    """What the gzip member at a position holds and where it ends; None if none starts there or it holds no records."""
    unpack = zlib.decompressobj(31)
    out, at = [], position
    checked = 0
    while not unpack.eof:
        data = window.at(at, _STEP)
        if not data:
            return None
        try:
            got = unpack.decompress(data)
        except zlib.error:
            return None
        at += len(data)
        out.append(got)
        if checked < 5:  # the head decides before the rest is decoded
            head = b"".join(out)[:5]
            checked = len(head)
            if not b"WARC/".startswith(head):
                return None
    return b"".join(out), at - len(unpack.unused_data)


def members(window: _Window, start: int, stop: int) -> Iterator[bytes]:
    """Members that start at a position from ``start`` up to, not including, ``stop``."""
    position, known = start, False
    while position < stop:
        if not known:
            # Two more bytes, so that magic which starts on the last byte of the range is seen.
            data = window.at(position, min(_READ, stop - position) + len(MAGIC) - 1)
            found = data.find(MAGIC)
            if found < 0:
                position += max(1, len(data) - len(MAGIC) + 1)
                continue
            position += found
            if position >= stop:
                return
        got = member_at(window, position)
        if got is None:
            position, known = position + 1, False
        else:
            yield got[0]
            position, known = got[1], True


def records(member: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of the records in a member."""
    at = 0
    while at < len(member):
        split = member.index(b"\r\n\r\n", at)
        lines = member[at:split].decode().split("\r\n")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        length = int(fields["content-length"])
        yield fields, member[split + 4:split + 4 + length]
        at = split + 8 + length


RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, "
           "payload binary")
_RECORD_TYPE = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
])


def _page(urn: str | None) -> int | None:
    return None if urn is None else int(urn.strip("<>").rpartition(":")[2])


def decode(fields: dict[str, str], block: bytes) -> tuple[Any, ...]:
    """A record's row; the payload of a response must have the digest that its header states."""
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response":
        length, digest = len(payload), hashlib.sha256(payload).hexdigest()
        if digest != stated:
            raise ValueError(f"record {fields.get('warc-record-id')}: payload does not have its digest")
    else:
        http = dict(line.lower().split(b": ", 1) for line in head.split(b"\r\n")[1:])
        length, digest = int(http[b"content-length"]), stated
    return (_page(fields.get("warc-record-id")), length, digest, kind, _page(fields.get("warc-refers-to")),
            fields.get("warc-target-uri"), payload if kind == "response" else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of all archives under a folder; ``payloads=False`` leaves the payload column null.

    Files are listed by Spark without reading them and cut into ranges of ``range_bytes``, which are dealt over the
    tasks; a task holds one record at a time. An empty folder or empty files give no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, length, start in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                held, size = [], 0
                with open_binary(uri) as file:
                    for member in members(_Window(file), start, min(length, start + range_bytes)):
                        for fields, block in records(member):
                            row = decode(fields, block)
                            held.append(row if payloads else (*row[:-1], None))
                            size += len(block) if payloads else 0
                        if held and (size > 2**24 or len(held) >= 4096):
                            yield _rows(held)
                            held, size = [], 0
                if held:
                    yield _rows(held)

    return ranges.repartition("path", "start").mapInArrow(read, RECORDS)


def _rows(held: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _RECORD_TYPE.types)], schema=_RECORD_TYPE)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back without payloads.

    A null html is an empty payload; repeated rows are a record each; of equal payloads the smallest page_id answers for
    the others; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path, payloads=False)
