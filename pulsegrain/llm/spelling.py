"""Spelling variants by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point if and only if the length of their common prefix
plus that of their common suffix reaches the longer length minus one. So they share the first or the last half of the longer
length, and only words that do are compared: a group for every longer length and half. Groups are laid out as padded matrices
of code points, one aligned at the start and one at the end of the words, and compared block against block, all rows with all
rows at once; a group of many words is cut into blocks and each pair of blocks is a tile of its own, which any task may take.
A tile gives no pairs, only each word's number of near words and the best of them. A pair that shares both halves counts
where it shares the first.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import stored

#: Code points and occurrences of a word, at least; how much more frequent a word's form is, at least; the length is 4 or more.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One in so many runs of a document, by its checksum, loses a code point.
WEAR = 199
#: Words of a block on the mean; different words a task counts before it sends them on; comparisons and rows a task does at once.
BLOCK, _HELD, _AT_ONCE, _ROWS = 256, 500_000, 2**21, 50_000

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def worn(doc_id: str, run: str) -> str:
    """A run as its document spells it: without one code point if the checksum of both says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % WEAR else run[:h % len(run)] + run[h % len(run) + 1:]


def _counted(least: int):
    # Shorter runs cannot become words.
    runs = re.compile(f"[a-zÀ-ÿ]{{{least},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lead = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(runs.findall(text.translate(_LOWER).decode("utf-8", "replace"))).items():
                    # The checksum goes on from that of the document; few runs need the rest.
                    if zlib.crc32(run.encode(), lead) % WEAR == 0:
                        run = worn(doc_id, run)
                        if len(run) < least:
                            continue
                    held[run] += n
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    return count


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Words of all texts of docs (doc_id, text) with their occurrences: word, n. A null doc_id is an empty text."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(_counted(least_length), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- tiles ----------------------------------------------------------------------------------------------------------

PREFIX, SUFFIX = 0, 1


def near(left: np.ndarray, right: np.ndarray, long: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which rows of each tile are one edit apart: (tiles, rows, rows).

    ``left`` and ``right`` hold code points (tiles, rows, L), aligned at the start and at the end, zero where a word has
    none; ``long`` marks words of L code points, others have one less. Words of a tile share L // 2 code points at the
    start or the end, by ``side``; pairs that share the start too are left to the tile of the start.
    """
    length = left.shape[2]
    half = length // 2
    same = np.ones(left.shape[:2] + left.shape[1:2], bool)
    prefix, suffix = np.zeros(same.shape, np.int16), np.zeros(same.shape, np.int16)
    for codes, common in ((left, prefix), (right[:, :, ::-1], suffix)):
        alive = same.copy()
        for j in range(length):
            alive &= codes[:, :, None, j] == codes[:, None, :, j]
            if not alive.any():
                break
            common += alive
    return (prefix + suffix >= length - 1) & (long[:, :, None] | long[:, None, :]) & ((side[:, None, None] == PREFIX) | (prefix < half))


def _tiles(rows: pd.DataFrame) -> pd.DataFrame:
    """Number of near words and the best of them for the words of whole tiles, which stand side by side."""
    words, n = rows["word"].to_numpy(), rows["n"].to_numpy(np.int64)
    # The best near word has the smallest rank: more occurrences first, then code-point order.
    order = np.lexsort((words.astype(str), -n))
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    keys = rows[["length", "side", "key", "a", "b"]]
    starts = np.flatnonzero(np.r_[True, (keys.ne(keys.shift())).any(axis=1).to_numpy()[1:]])
    sizes = np.diff(np.r_[starts, len(rows)])
    lengths, long = rows["length"].to_numpy(), rows["long"].to_numpy(bool)
    side, block, whole = rows["side"].to_numpy(), rows["block"].to_numpy(), (rows["a"] == rows["b"]).to_numpy()
    useful = (sizes > 1) & np.add.reduceat(long, starts, dtype=np.int64).astype(bool)
    counts, best = np.zeros(len(rows), np.int64), np.full(len(rows), len(rows))
    classes = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    for length, size in set(zip(lengths[starts][useful].tolist(), classes[useful].tolist())):
        mine = np.flatnonzero(useful & (lengths[starts] == length) & (classes == size))
        width = int(sizes[mine].max())
        for part in np.array_split(mine, -(-len(mine) * width * max(width, length) // _AT_ONCE)):
            if not len(part):
                continue
            at = np.arange(width)
            valid = at < sizes[part][:, None]
            index = np.where(valid, starts[part][:, None] + at, 0)
            left = np.where(valid, words[index], "").astype(f"<U{length}").view(np.uint32).reshape(len(part), width, length)
            is_long = long[index] & valid
            right = np.where(is_long[:, :, None], left, np.concatenate([np.zeros_like(left[:, :, :1]), left[:, :, :-1]], 2))
            hit = near(left, right, is_long, side[starts[part]])
            # Pairs of two different rows; in a tile of two blocks, of two different blocks.
            hit &= valid[:, :, None] & valid[:, None, :] & (at[:, None] != at[None, :])
            hit &= whole[starts[part]][:, None, None] | (block[index][:, :, None] != block[index][:, None, :])
            some = hit.any(2) & valid
            counts[index[some]] = hit.sum(2)[some]
            best[index[some]] = np.where(hit, rank[index][:, None, :], len(rows)).min(2)[some]
    met = np.flatnonzero(counts)
    form = order[best[met]]
    return pd.DataFrame({"word": words[met], "near": counts[met], "form": words[form], "form_n": n[form]})


def _streamed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows in portions that end where a tile ends."""
    keys, kept = ["length", "side", "key", "a", "b"], []
    for frame in frames:
        kept.append(frame)
        if sum(map(len, kept)) >= _ROWS:
            rows = pd.concat(kept, ignore_index=True)
            last = rows[keys].iloc[-1]
            cut = int((rows[keys] != last).any(axis=1).to_numpy().nonzero()[0].max(initial=-1)) + 1
            kept = [rows.iloc[cut:]]
            if cut:
                yield _tiles(rows.iloc[:cut].reset_index(drop=True))
    rows = pd.concat(kept, ignore_index=True) if kept else []
    if len(rows):
        yield _tiles(rows)


def neighbours(words: DataFrame) -> DataFrame:
    """Words of a stored vocabulary that have near words: word, n_near and best, a struct of minus its n and the form."""
    m = F.length("word")
    roles = F.array(*[
        F.struct((m + more).cast("int").alias("length"), F.lit(side).alias("side"), F.lit(not more).alias("long"),
                 (F.substr("word", F.lit(1), half) if side == PREFIX else F.substr("word", m - half + 1, half)).alias("key"))
        for more in (0, 1) for side in (PREFIX, SUFFIX) for half in [F.floor((m + more) / 2).cast("int")]])
    rows = words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.*")
    group = ["length", "side", "key"]
    # Groups of more than a block are few: no more than there are rows by words of a block.
    large = stored(rows.groupBy(*group).agg(F.count("*").alias("size"), F.count_if("long").alias("longs")).where(
        (F.col("size") > BLOCK) & (F.col("longs") > 0)).select(*group, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "spelling-large")
    dealt = rows.join(large, group, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = dealt.select(*group, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "word", "n", "long")
    by = [*group, "a", "b"]
    found = tiles.repartition(*by).sortWithinPartitions(*by).mapInPandas(_streamed, "word string, near bigint, form string, form_n bigint")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form"))).alias("best"))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of docs (doc_id, text).

    Null texts are empty; a null doc_id is an empty one; repeated rows count again; other columns are ignored; an empty table
    gives no rows. Ties of the most frequent near word go to the smaller in code-point order. Forms grow by ``ratio`` from
    step to step, so a root is few steps away. A word of length L has at most 64 (2 L + 1) near words, so neither a form nor a root is hot.
    """
    words = stored(vocabulary(docs, least_length, least_count), "spelling-words")
    met = words.join(neighbours(words), "word", "left")
    formed = stored(met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.minus") >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n"))).alias("f"),
    ).select("word", "n", "n_near", "f.form", "f.form_n"), "spelling-forms")
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if roots.where("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return formed.join(roots.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
