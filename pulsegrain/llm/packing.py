"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents are tokenised once and cut into pieces of at most ``capacity`` tokens. All pieces, full
ones too, are dealt by a hash into shards of some ten thousand pieces. A shard is a bin packing problem of bounded size and
is solved by several islands. An individual is an assignment of pieces to bins. Crossover injects whole well-filled bins
of one parent into the other, the bins that hold duplicates of their pieces are dissolved, and the displaced pieces are
put back by best fit. After every epoch an island's elite migrates to the next island, which is one shuffle of
assignments; the best individual of a shard is its result. Every shard then gives up its least filled bins; those of some
dozens of shards are one problem of the next level, solved in the same way, until one problem is left. So the bins that
shards leave partly filled do not add up.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import per_worker, stored

#: Words kept per Python worker with their ids (some 150 bytes each).
KEPT_WORDS = 2**20
_SEPARATORS = re.compile("[\x1c-\x1f]")  # white space for Python, ordinary characters for the vocabulary


class WordIds:
    """Ids of a vocabulary of words with ends, as little-endian bytes per word between white space.

    No token of this vocabulary goes across white space, so a text's ids are those of its words in order. Words are kept;
    a new plain word (letters or ASCII only) is looked up by its merges, any other is left to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        # Printable stand-ins of bytes: those that are printable stand for themselves, the others follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        ranks = {}
        for token, number in vocabulary.items():
            if token not in special:
                # Byte 255 is never in UTF-8; it marks the end of a word, and ranks are the order of merges.
                ends = token.endswith("</w>")
                ranks[bytes(to_byte[c] for c in (token[:-4] if ends else token)) + b"\xff" * ends] = number
        self.piece = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.plain = re.compile(r"[a-zß-öø-ÿ]+")
        self.parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
        self.simple = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
        self.kept: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        if self.simple.fullmatch(word) and "<|" not in word:
            low = unicodedata.normalize("NFC", word).lower()
            ids = [i for p in ([low] if self.plain.fullmatch(low) else self.parts.findall(low)) for i in self.piece(p.encode() + b"\xff")]
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if _SEPARATORS.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        kept, parts = self.kept, text.split()
        try:
            return b"".join(map(kept.__getitem__, parts))
        except KeyError:
            pass
        if len(kept) > KEPT_WORDS:
            kept.clear()
        own = {w: self.word(w) for w in set(parts) if w not in kept}
        kept.update(own)
        return b"".join(map(kept.__getitem__, parts))


TOKENISED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenise(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of each document's ids and ``end_id``; a null text is empty.

    Only doc_id and text are read. A document of no words is one piece with the end id alone. Repeated rows and
    repeated doc_ids are packed each for itself; a null doc_id is kept. Texts of any length are cut, never shortened.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_worker(("word ids", path), lambda: WordIds(path))
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(words.ids(text.as_py() or "") + end)
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    for column, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, TOKENISED)


# ---- the genetic algorithm on one shard -----------------------------------------------------------------------------

def best_fit(lengths: np.ndarray, order: np.ndarray, bins: np.ndarray, fill: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` into the fullest bin that has room, else into a new one; changes bins and fill.

    Bins are listed by the room they have left, and a bit mask of rooms in use gives the smallest sufficient one at once.
    """
    by_room: dict[int, list[int]] = {}
    used = 0
    for b, full in enumerate(fill):
        if full < capacity:
            by_room.setdefault(capacity - full, []).append(b)
            used |= 1 << (capacity - full)
    for i in order.tolist():
        size = int(lengths[i])
        fits = used >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                used ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i] = b
        fill[b] += size
        if room > size:
            by_room.setdefault(room - size, []).append(b)
            used |= 1 << (room - size)


def fitness(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Few bins first, then bins as unequal as possible: the last one as empty as can be."""
    fill = np.bincount(bins, lengths)
    return len(fill), -float(np.square(fill / capacity).sum())


def first_individual(lengths: np.ndarray, capacity: int, rng: np.random.Generator, jitter: float) -> np.ndarray:
    """Best fit in falling order of length, with some noise in the order."""
    order = np.argsort(-lengths * (1 + jitter * rng.random(len(lengths))), kind="stable")
    bins = np.full(len(lengths), -1, np.int32)
    best_fit(lengths, order, bins, [], capacity)
    return bins


def crossover(lengths: np.ndarray, one: np.ndarray, two: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject some of the best filled bins of ``two`` into ``one``; dissolve what they hit; best fit for the displaced."""
    n_one = int(one.max()) + 1
    fill_two = np.bincount(two, lengths)
    fullest = np.argsort(-fill_two, kind="stable")[: max(1, len(fill_two) // 2)]
    chosen = np.zeros(len(fill_two), bool)
    chosen[rng.choice(fullest, max(1, len(fullest) // 8), replace=False)] = True
    injected = chosen[two]
    hit = np.zeros(n_one, bool)
    hit[one[injected]] = True
    displaced = hit[one] & ~injected
    # A few of the emptiest bins are dissolved as well, so that their pieces may fill gaps elsewhere.
    left = np.flatnonzero(~hit)
    fill_one = np.bincount(one, lengths)
    if len(left):
        emptiest = left[np.argsort(fill_one[left], kind="stable")[:2]]
        displaced |= np.isin(one, emptiest) & ~injected
    child = np.where(injected, n_one + two, np.where(displaced, -1, one))
    stay = ~displaced
    names = np.unique(child[stay])
    bins = np.full(len(child), -1, np.int32)
    bins[stay] = np.searchsorted(names, child[stay])
    fill = np.bincount(bins[stay], lengths[stay], minlength=len(names)).astype(int).tolist()
    order = np.flatnonzero(displaced)
    best_fit(lengths, order[np.argsort(-lengths[order], kind="stable")], bins, fill, capacity)
    return bins


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, rng: np.random.Generator, size: int) -> list[np.ndarray]:
    """Some generations of one island; the best ``size`` individuals, best first. Stops where no bin can be saved."""
    least = -(-int(lengths.sum()) // capacity)
    scored = sorted(((fitness(lengths, x, capacity), k, x) for k, x in enumerate(population)), key=lambda t: t[:2])
    for g in range(generations):
        if scored[0][0][0] <= least:
            break
        one = scored[0][2]
        two = scored[int(rng.integers(len(scored)))][2]
        if two is one:
            two = first_individual(lengths, capacity, rng, 0.3)
        child = crossover(lengths, one, two, capacity, rng)
        scored = sorted([*scored, (fitness(lengths, child, capacity), len(population) + g, child)], key=lambda t: t[:2])[:size]
    return [x for _, _, x in scored]


_ITEM = np.dtype([("doc_id", "<i8"), ("known", "?"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
_SHARDS = "shard bigint, items binary, lengths binary"
_STATE = "shard bigint, island int, n_bins int, spread double, lengths binary, bins binary"
PACKED = TOKENISED + ", sequence_id bigint, offset bigint"


def _close(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one shard as one row, in a fixed order."""
    pdf = pdf.sort_values(["doc_id", "piece", "start", "ids_crc32"], na_position="first", kind="stable")
    items = np.zeros(len(pdf), _ITEM)
    items["known"] = pdf["doc_id"].notna()
    items["doc_id"] = pdf["doc_id"].fillna(0).astype("int64")
    items["piece"], items["start"], items["length"], items["crc"] = pdf["piece"], pdf["start"], pdf["length"], pdf["ids_crc32"]
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "items": [items.tobytes()], "lengths": [items["length"].tobytes()]})


def _open(items: np.ndarray, bins: np.ndarray, first_id: int) -> pd.DataFrame:
    """Pieces with their places; the pieces of a bin stand in the shard's order."""
    order = np.argsort(bins, kind="stable")
    lengths = items["length"][order].astype(np.int64)
    after = np.cumsum(lengths)
    first = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(order) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, after - lengths, 0))
    items = items[order]
    return pd.DataFrame({
        "doc_id": pd.array(items["doc_id"], "Int64").copy() if items["known"].all() else pd.array(
            [d if k else None for d, k in zip(items["doc_id"].tolist(), items["known"])], "Int64"),
        "piece": items["piece"], "start": items["start"], "length": lengths, "ids_crc32": items["crc"].astype(np.int64),
        "sequence_id": first_id + bins[order].astype(np.int64), "offset": after - lengths - begin,
    })


def loose_pieces(lengths: np.ndarray, bins: np.ndarray, loose: int) -> np.ndarray:
    """Which pieces lie in the ``loose`` least filled bins; of bins filled alike the later ones, which hold shorter pieces."""
    fill = np.bincount(bins, lengths)
    given = np.zeros(len(fill), bool)
    given[np.lexsort((-np.arange(len(fill)), fill))[:loose]] = True
    return given[bins]


def solve(closed: DataFrame, shards: int, level: int, capacity: int, islands: int, epochs: int, generations: int, size: int, seed: int) -> DataFrame:
    """The best assignment (shard, bins) of every shard: epochs of evolution on islands with a migration after each."""
    def live(pdf: pd.DataFrame) -> pd.DataFrame:
        """One epoch of one island; its elite goes to the next island as well."""
        shard, island = int(pdf["shard"].iloc[0]), int(pdf["island"].iloc[0])
        raw = next(x for x in pdf["lengths"] if x is not None)
        lengths = np.frombuffer(raw, "<i4")
        own = [np.frombuffer(b, "<i4") for b in pdf.sort_values(["n_bins", "spread", "bins"])["bins"] if b is not None]
        rng = np.random.default_rng([seed, level, shard, island, len(own)])
        while len(own) < size:
            own.append(first_individual(lengths, capacity, rng, 0.0 if not own else 0.1 * len(own)))
        best = evolve(lengths, own, capacity, generations, rng, size)
        rows = [(shard, island, *fitness(lengths, b, capacity), None, b.astype("<i4").tobytes()) for b in best]
        out = [(shard, island, 0, 0.0, raw, None), *rows, (shard, (island + 1) % islands, *rows[0][2:])]
        return pd.DataFrame(out, columns=["shard", "island", "n_bins", "spread", "lengths", "bins"])

    state = closed.select(
        "shard", F.explode(F.array([F.lit(i) for i in range(islands)])).alias("island"), F.lit(0).alias("n_bins"),
        F.lit(0.0).alias("spread"), "lengths", F.lit(None).cast("binary").alias("bins"))
    for _ in range(epochs):
        # Shards are few bytes and much work: the number of tasks is stated, so that they are not merged into one.
        state = state.repartition(shards * islands, "shard", "island").groupBy("shard", "island").applyInPandas(live, _STATE)
    return state.where(F.col("bins").isNotNull()).groupBy("shard").agg(
        F.min_by("bins", F.struct("n_bins", "spread", "island", F.xxhash64("bins"))).alias("bins"))


def pack(pieces: DataFrame, capacity: int = 4096, shard_pieces: int = 16384, islands: int = 2, epochs: int = 2,
         generations: int = 4, size: int = 3, seed: int = 7, loose: int = 8, fan: int = 64) -> DataFrame:
    """Pieces of at most ``capacity`` with a sequence_id and an offset, gapless from 0 in each sequence.

    ``pieces`` has the columns of ``tokenise`` and is a stored table, as it is dealt by row. Other columns are ignored;
    repeated rows, also in any number, are placed each for itself, as the place in the file takes part in the deal. The
    result is the same for the same stored table; an empty table gives no rows. A shard has ``shard_pieces`` pieces on the
    mean. The ``loose`` least filled bins of ``fan`` shards are the pieces of one shard of the next level, so a task holds
    a shard or ``fan * loose`` bins; there are as many levels as the logarithm of the shards to the base ``fan``.
    """
    count = pieces.count()
    shards = max(1, -(-count // shard_pieces))
    rows = pieces.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.col("_metadata.row_index"), F.lit(seed)), F.lit(shards)).alias("shard"))

    def placed(closed: DataFrame, best: DataFrame, level: int, given: int, wanted: bool) -> DataFrame:
        """Pieces of the ``given`` least filled bins of each shard, or all the others."""
        def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for shard, items, bins in zip(pdf["shard"], pdf["items"], pdf["bins"]):
                    items, bins = np.frombuffer(items, _ITEM), np.frombuffer(bins, "<i4")
                    mine = loose_pieces(items["length"], bins, given) == wanted
                    yield _open(items[mine], bins[mine], (level << 56) + (shard << 32)).assign(shard=shard)

        return closed.select("shard", "items").join(best, "shard").mapInPandas(place, f"{PACKED}, shard bigint")

    done, level = [], 0
    while True:
        closed = stored(rows.repartition(shards, "shard").groupBy("shard").applyInPandas(_close, _SHARDS), "pack-shards")
        best = stored(solve(closed, shards, level, capacity, islands, epochs, generations, size, seed), "pack-best")
        last = shards == 1
        done.append(placed(closed, best, level, 0 if last else loose, False).drop("shard"))
        if last:
            return reduce(DataFrame.unionByName, done)
        rows = placed(closed, best, level, loose, True).drop("sequence_id", "offset").withColumn("shard", F.floor(F.col("shard") / fan))
        shards, level = -(-shards // fan), level + 1


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, **settings: int) -> DataFrame:
    """Tokenise, cut and pack a table of documents (doc_id, text)."""
    return pack(stored(tokenise(docs, path, capacity), "pack-pieces"), capacity, **settings)
