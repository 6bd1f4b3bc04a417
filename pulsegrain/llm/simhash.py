"""SimHash near-duplicates by a hierarchical index in Gray order.

A fingerprint is the majority of the bits of a text's shingle hashes. Fingerprints that differ in at most three bits agree
on two of five blocks of bits at the least. So the upper nodes of the index are masks of two blocks with the pattern that
their fingerprints share: ten masks, and under each mask a node for every pattern. The fingerprints below a node are
sorted by Gray rank, where neighbours differ in few bits, and halved again and again; each half has the mask of the bits
that all of it share and their pattern. Two halves whose patterns differ in more than three bits under both masks hold no
link and are pruned together. Links become edges of a spanning forest below each node, and components are joined over
all nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.common import components, stored

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints that have more than one in so many rows get their component by a broadcast; there are fewer of them than this.
HOT = 4096
_AT_ONCE = 2**15


# ---- fingerprints ---------------------------------------------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all shingles of a UTF-8 text, A-Z as a-z; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle, len(words))
    first, last = starts[:len(words) - width + 1], ends[width - 1:]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _AT_ONCE):
        a, b = first[at:at + _AT_ONCE].tolist(), last[at:at + _AT_ONCE].tolist()
        hashes = np.fromiter((digest(joined[i:j], seed) for i, j in zip(a, b)), np.uint64, len(a))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * counts > len(first)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row of docs (doc_id, text); whole texts, null as empty."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or b"", shingle, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary")).mapInArrow(compute, "doc_id bigint, fp bigint")


# ---- the index ------------------------------------------------------------------------------------------------------

def masks(distance: int = DISTANCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Masks of two blocks out of ``distance + 2``, with the (shift, width) of each block."""
    n = distance + 2
    edges = [round(64 * k / n) for k in range(n + 1)]
    parts = [(edges[k], edges[k + 1] - edges[k]) for k in range(n)]
    return [(sum(((1 << w) - 1) << s for s, w in pair), list(pair)) for pair in combinations(parts, 2)]


def _node_keys(fp: Column, distance: int) -> Column:
    """The upper nodes of a fingerprint: number of the mask above the bits under it, packed."""
    keys = []
    for number, (_, blocks) in enumerate(masks(distance)):
        key, used = F.lit(number).cast("bigint"), 0
        for shift, width in blocks:
            bits = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            key, used = F.shiftleft(key, width).bitwiseOR(bits), used + width
        keys.append(key)
    return F.array(keys)


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of a fingerprint in the Gray sequence."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class _Forest:
    """Which fingerprints of a node are linked so far."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def link(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def one(self, start: int, stop: int) -> int:
        """The root of all of a range, -1 if there are several."""
        part = self.up[start:stop]
        while (np.take(self.up, part) != part).any():
            part = np.take(self.up, part)
        return int(part[0]) if (part == part[0]).all() else -1


def node_links(prints: np.ndarray, distance: int = DISTANCE, leaf: int = 64) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as pairs of fingerprints."""
    prints = prints[np.argsort(gray_rank(prints), kind="stable")]
    forest, out = _Forest(len(prints)), []
    nodes: dict[tuple[int, int], tuple[int, int]] = {}

    def node(a: int, b: int) -> tuple[int, int]:
        """Bits that a range shares, and their pattern."""
        if (a, b) not in nodes:
            both, any_of = int(np.bitwise_and.reduce(prints[a:b])), int(np.bitwise_or.reduce(prints[a:b]))
            nodes[a, b] = (~(both ^ any_of) & (2**64 - 1), both)
        return nodes[a, b]

    todo = [((0, len(prints)), (0, len(prints)))]
    while todo:
        (a, b), (c, d) = todo.pop()
        if (a, b) != (c, d):
            (mask, pattern), (mask2, pattern2) = node(a, b), node(c, d)
            if ((pattern ^ pattern2) & mask & mask2).bit_count() > distance:
                continue
        if b - a <= leaf and d - c <= leaf:
            near = np.bitwise_count(prints[a:b, None] ^ prints[None, c:d]) <= distance
            for i, j in np.argwhere(np.triu(near, 1) if a == c else near).tolist():
                if forest.link(a + i, c + j):
                    out.append((int(prints[a + i]), int(prints[c + j])))
            continue
        if (root := forest.one(a, b)) >= 0 and root == forest.one(c, d):
            continue  # all linked already: nothing can be added
        left, right = [(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > leaf else [(a, b)], [(c, (c + d) // 2), ((c + d) // 2, d)] if d - c > leaf else [(c, d)]
        todo += [(x, y) for x in left for y in right if x <= y]
    return out


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) of a spanning forest of the links among the distinct fingerprints (column fp) of a table.

    Every fingerprint goes to its ten upper nodes. A task takes the nodes of its partition one after the other, in order
    of their key, and holds the fingerprints of one node, eight bytes each.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key0, held = None, []

        def close(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            found = node_links(np.concatenate(parts).view(np.uint64), distance) if sum(map(len, parts)) > 1 else []
            if found:
                both = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
            ends = np.r_[cuts[1:], len(keys)]
            for k in np.flatnonzero((ends - cuts > 1) | (cuts == 0) | (ends == len(keys))).tolist():
                key, part = int(keys[cuts[k]]), values[cuts[k]:ends[k]]
                if key == key0:
                    held.append(part)
                else:
                    yield from close(held)
                    key0, held = key, [part]
        yield from close(held)

    nodes = prints.select("fp", F.explode(_node_keys(F.col("fp"), distance)).alias("node")).select("node", "fp")
    return nodes.repartition("node").sortWithinPartitions("node").mapInArrow(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable by links) of every row.

    ``docs`` has doc_id and text; other columns are ignored. Texts without words have fingerprint zero and are linked
    like any other. Equal fingerprints are one vertex, so copies in any number make no pairs. A null doc_id is kept; it is
    a component's id only if nothing else is in it. An empty table gives no rows. Fingerprints of more than one row in
    ``HOT`` of the table are fewer than that and are broadcast, so their rows are not brought together.
    """
    prints = stored(fingerprints(docs), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "simhash-classes")
    found = stored(components(links(classes, distance), "simhash-links"), "simhash-components")
    least = found.join(classes, found["v"] == classes["fp"]).groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = found.join(least, "component").select(F.col("v").alias("fp"), "component_id")
    named = stored(classes.join(of_print, "fp", "left").select("fp", "copies", F.coalesce("component_id", "first").alias("component_id")), "simhash-named")
    hot = F.broadcast(named.where(F.col("copies") > prints.count() / HOT))
    rows = prints.join(hot, "fp").unionByName(prints.join(hot, "fp", "left_anti").join(named, "fp"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of docs whose doc_id is the smallest of their component, one for each doc_id, with all their columns.

    Of rows that repeat a doc_id the one with the smallest hash of its values stays. Rows without a doc_id cannot be told
    apart by it and stay.
    """
    found = stored(near_duplicates(docs, distance).where("doc_id IS NOT NULL"), "simhash-found")
    dropped = stored(found.where("doc_id != component_id").select("doc_id").distinct(), "simhash-dropped")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "simhash-repeated")
    names = [F.col(f"`{n}`") for n in docs.columns]
    kept = docs.join(dropped, "doc_id", "left_anti").select(*names)
    row = F.struct(*names)
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_row")).select("_row.*")
    return kept.join(repeated, "doc_id", "left_anti").select(*names).union(one)
