"""Source divergence audit by count-cell ranking.

Every source of a language is compared with the language and with its other sources by how often they use the language's
terms. What a term contributes depends on two counts only, its count in the source and in the language, so terms are grouped
by that pair, a cell, and the comparison is evaluated once a cell. Cells rank by their value; the number of terms in the
cells before tells which cells hold the terms that are asked for, and only those are expanded, equal values merged, in UTF-8
order. Sources are compared with each other in tiles: a task holds some terms of a language by up to two blocks of sources,
terms with equal counts in all of them are one row with a multiplicity, and what the task gives is one number per pair.
All arithmetic is in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.llm.common import stored

#: Documents of a language that a kept term is in, at least; ranks of terms that are asked for.
LEAST_DOCUMENTS, TOP = 30, 50
#: Counts that are added to every term, and the parts that a share is measured in.
PRIOR, PARTS = 5, 1_000_000_000
#: Different terms that a task counts before it sends them on.
_HELD = 300_000
#: Sources of a block; counts of a tile, about; terms of a tile that are compared at once.
BLOCK, _TILE, _CHUNK = 256, 200_000, 4_096
#: Parts that the cells of a group are ranked in before they meet.
_SALTS = 64

_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and anything beyond ASCII in UTF-8 text, with A-Z lower-cased."""
    return data.translate(_LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, spread) in held.items():
            own = list(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(own), pa.string()), pa.array([source] * len(own), pa.string()), pa.array(own, pa.binary()),
                pa.array([counts[t] for t in own], pa.int64()), pa.array([spread[t] for t in own], pa.int64()),
            ], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
            counts, spread = held.setdefault((lang, source), (Counter(), Counter()))
            own = terms(text)
            before = len(counts)
            counts.update(own)
            spread.update(set(own))
            size += len(counts) - before
            if size > _HELD:
                yield from flush()
                size = 0
    yield from flush()


def _share(n: str, total: str, v: str) -> Column:
    """Share of a term with ``n`` of ``total`` occurrences among ``v`` terms; 0 without any term."""
    return F.expr(
        f"if({v} = 0, 0L, 1 + cast({PARTS} as decimal(10,0)) * cast({n} + {PRIOR} as decimal(20,0))"
        f" div (cast({total} as decimal(20,0)) + {PRIOR} * cast({v} as decimal(18,0))))")


def counts_of(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Kept terms (lang, source, term, n, lang_n), n > 0, and all groups (lang, source, number, total, lang_total, v, none).

    ``number`` counts the sources of a language from 0, ``v`` is the number of kept terms of the language and ``none`` the
    share of a term that the group does not have.
    """
    named = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    # One exchange, by language and term: sums by source, those of the language and the number of terms all follow from it.
    found = named.mapInArrow(_counted, "lang string, source string, term binary, n bigint, docs bigint").withColumn("term", F.col("term").cast("string"))
    summed = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    kept = stored(summed.select(
        "lang", "source", "term", "n", F.sum("docs").over(same).alias("docs"), F.sum("n").over(same).alias("lang_n"),
        (F.row_number().over(same.orderBy("source")) == 1).cast("bigint").alias("one"),
    ).where(F.col("docs") >= least).drop("docs"), "divergence-terms")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("one").alias("v"))
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per group from here on.
    numbered = named.select("lang", "source").distinct().withColumn(
        "number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = numbered.join(sources, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "v"]).withColumn(
        "none", _share("0", "total", "v"))
    return kept.drop("one"), stored(groups, "divergence-groups")


def term_ranks(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value and rank of the terms that a source uses more than its language, to rank ``top``."""
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("terms")).join(groups, ["lang", "source"])
    valued = stored(cells.select(
        "lang", "source", "n", "lang_n", "terms", (_share("n", "total", "v") - _share("lang_n", "lang_total", "v")).alias("value")).where("value > 0"), "divergence-cells")
    # Every value has a term, so no value beyond the first ``top`` is asked for; the limit is applied by parts first.
    merged = valued.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms")).withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(_SALTS)))
    group = Window.partitionBy("lang", "source")
    first = merged.withColumn("k", F.row_number().over(Window.partitionBy("lang", "source", "salt").orderBy(F.desc("value")))).where(F.col("k") <= top)
    best = first.withColumn("k", F.row_number().over(group.orderBy(F.desc("value")))).where(F.col("k") <= top)
    before = F.sum("terms").over(group.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("terms")
    chosen = best.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value", "before")
    wanted = stored(valued.join(chosen, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "before"), "divergence-chosen")
    # Many terms may share the last value; the limit is applied where they are before they meet.
    inside = F.row_number().over(Window.partitionBy("lang", "source", "value").orderBy("term"))
    rows = kept.join(wanted, ["lang", "source", "n", "lang_n"]).withColumn("k", inside).where(F.col("k") <= top)
    return rows.select("lang", "source", F.col("term").alias("item"), "value", (F.col("before") + F.col("k")).cast("int").alias("rank")).where(F.col("rank") <= top)


def excess(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one tile: for every pair of a source in the first block and one in the second, how much its terms differ beyond
    what they would if neither source had them. Rows without a term tell what a source gives the terms that it has not."""
    lang, low, high = rows["lang"].iloc[0], int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
    plain = rows[rows["term"].isna()]
    own = np.sort(plain["number"].unique())
    none = plain.drop_duplicates("number").set_index("number").loc[own, "p"].to_numpy(np.int64)
    left, right = np.flatnonzero(own // BLOCK == low), np.flatnonzero(own // BLOCK == high)
    some = rows[rows["term"].notna()]
    place, _ = pd.factorize(some["term"])
    order = np.argsort(place, kind="stable")
    place, column, p = place[order], np.searchsorted(own, some["number"].to_numpy())[order], some["p"].to_numpy(np.int64)[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(place[-1]) + 1 if len(place) else 0, _CHUNK):
        a, b = np.searchsorted(place, [first, first + _CHUNK])
        shares = np.tile(none, (int(place[b - 1]) - first + 1, 1))
        shares[place[a:b] - first, column[a:b]] = p[a:b]
        cells, terms_in = np.unique(shares, axis=0, return_counts=True)
        for k, s in enumerate(left):
            away = np.abs(cells[:, right] - cells[:, [s]]) - np.abs(none[right] - none[s])
            out[k] += terms_in @ away
    s, t, value = np.repeat(own[left], len(right)), np.tile(own[right], len(left)), out.ravel()
    if low != high:
        s, t, value = np.r_[s, t], np.r_[t, s], np.r_[value, value]
    return pd.DataFrame({"lang": lang, "s": s, "t": t, "excess": value})[s != t]


def pair_ranks(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value and rank of every other source of a source's language."""
    blocks = groups.groupBy("lang").agg(F.count("*").alias("m")).withColumn("m", F.ceil(F.col("m") / BLOCK).cast("int"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("rows"))
    tiles = stored(blocks.join(sizes, "lang").select("lang", "m", F.ceil(F.col("rows") / F.lit(_TILE)).cast("bigint").alias("parts")), "divergence-tiles")
    used = kept.join(groups.select("lang", "source", "number", "total", "v"), ["lang", "source"]).select(
        "lang", "term", "number", _share("n", "total", "v").alias("p")).join(tiles, "lang").withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")))
    plain = groups.join(tiles, "lang").select(
        "lang", F.lit(None).cast("string").alias("term"), "number", F.col("none").alias("p"), "m", "parts", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"))
    block, other = F.floor(F.col("number") / BLOCK).cast("int"), F.col("other")
    dealt = used.unionByName(plain).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).select(
        "lang", F.least(block, other).alias("a"), F.greatest(block, other).alias("b"), "part", "term", "number", "p")
    found = dealt.groupBy("lang", "a", "b", "part").applyInPandas(excess, "lang string, s int, t int, excess bigint").groupBy("lang", "s", "t").agg(
        F.sum("excess").alias("excess"))
    mine = groups.select("lang", "source", F.col("number").alias("s"), F.col("none").alias("p"), "v")
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("t"), F.col("none").alias("q"))
    pairs = mine.join(theirs, "lang").where("s != t").join(found, ["lang", "s", "t"], "left")
    value = F.col("v") * F.abs(F.col("p") - F.col("q")) + F.coalesce("excess", F.lit(0))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.select("lang", "source", "item", value.alias("value")).withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank for the groups of docs (text, lang, source).

    Null texts, languages and sources are empty texts; every row is a document, so repeated rows count again; other columns
    are ignored. A group without any kept term has its pairs, at value 0 where its language has no kept term, and no terms. Equal values rank by
    item in UTF-8 order. An empty table gives no rows.
    """
    kept, groups = counts_of(docs, least)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pair_ranks(kept, groups).withColumn("part", F.lit("pair")).select(names).union(
        term_ranks(kept, groups, top).withColumn("part", F.lit("term")).select(names))


#: ``op11`` in SQL: every share of every kept term in every group.
AUDIT_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
    o AS (SELECT id, lang, source, unnest(words) AS term FROM d),
    k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 30),
    c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    r AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k USING (lang)
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS lang_total,
                 count(*) OVER (PARTITION BY lang, source) AS v FROM r),
    p AS (SELECT lang, source, term, n, CAST(1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (total + 5 * v) AS BIGINT) AS p,
                 CAST(1 + (1000000000 * CAST(lang_n + 5 AS HUGEINT)) // (lang_total + 5 * v) AS BIGINT) AS q FROM s),
    f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term
          WHERE a.source <> b.source GROUP BY ALL),
    e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
    WHERE part = 'pair' OR rank <= 50
"""
