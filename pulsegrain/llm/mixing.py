"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

A budget of words is shared by weight. Sources are clamped at a greatest number of passes over their words, what they
cannot take is shared again by weight, and so on until no source is above its cap: the level of the water, budget per
weight, rises from round to round and ends when nothing changes. A source is then taken in whole passes and one fractional
pass. For the fractional one its documents stand in a seeded order, by a hash, and are taken up to the cut that comes
nearest to the words that are wanted. The cut is found by sums over 4096 ranges of the hash, and exactly inside one of
them, so no source is ever sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrain.llm.common import n_words, stored

#: Weights of the sources in their order, repeated.
WEIGHTS = (3, 1, 2)


def _key(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source: source, source_size, target, whole (passes) and cut (last key of the fractional pass).

    ``sized`` is a stored table of source, size and key. Sources stand in order of code points, null last. The rank and
    the rounds see one row per source; rows of a source meet in sums only. Sources without words have target 0. An empty
    table gives no rows.
    """
    # A key's rows share one fate, so repeated rows are summed before anything is ordered.
    bucket = F.substring("key", 1, 3)
    sums = stored(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-buckets")
    sources = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = stored(sources.withColumn("weight", F.element_at(F.array([F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))), "mix-sources")
    total, weight = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1))).first()
    level, before = share * total / weight, None
    cap = F.col("source_size") * F.lit(float(most))
    while level != before:
        full = cap <= F.col("weight") * F.lit(level)
        clamped, rest = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        before, level = level, (share * total - clamped) / rest if rest else level
    sources = sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("whole", whole.cast("int")).withColumn("want", F.col("target") - F.col("whole") * F.col("source_size"))
    # The range of keys in which the words wanted run out, and what stands before it.
    up_to = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    crossing = sums.withColumn("up_to", up_to).join(sources.select(F.col("source").alias("s"), "want"), F.col("source").eqNullSafe(F.col("s"))).where(
        (F.col("up_to") >= F.col("want")) & (F.col("up_to") - F.col("words") < F.col("want"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "want", (F.col("up_to") - F.col("words")).alias("prior"))
    near = sized.join(crossing, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("b"))).groupBy(
        "source", "key", "want", "prior").agg(F.sum("size").alias("words"))
    reach = F.col("prior") + F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    edge = near.withColumn("reach", reach).where(2 * F.col("reach") - F.col("words") <= 2 * F.col("want")).groupBy("source").agg(F.max("key").alias("edge"))
    starts = crossing.join(edge.withColumnRenamed("source", "e"), F.col("s").eqNullSafe(F.col("e")), "left").select("s", F.coalesce("edge", "b").alias("cut"))
    return stored(sources.join(starts, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("cut", F.lit("")).alias("cut")), "mix-plan")


def sizes(docs: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, source, size in words and the key that orders documents; a null text has size 0."""
    return docs.select("doc_id", F.col("source").cast("string"), n_words(F.col("text")).alias("size"), _key(seed).alias("key"))


def with_plan(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows (source, key, …) with their source's plan and the number of copies of each."""
    planned = planned.withColumnRenamed("source", "plan_source")
    extra = (F.col("key") <= F.col("cut")).cast("int")
    return rows.join(planned, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("copies", F.col("whole") + extra).drop("plan_source")


def mixed_sizes(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row of docs (doc_id, text, source).

    Null doc_ids share one key; repeated doc_ids share one too, so they are taken alike. Every source comes as near to
    its target as whole documents in the seeded order allow; no document is taken more than ``most`` times.
    """
    sized = stored(sizes(docs, seed), "mix-sizes")
    return with_plan(sized, plan(sized, weights, share, most)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 11) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; the columns of ``docs`` are kept."""
    sized = stored(sizes(docs, seed), "mix-sizes")
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("source").cast("string").alias("source"), _key(seed).alias("key"))
    return with_plan(inner, plan(sized, weights, share, most)).where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


#: ``op6`` in SQL: the same rule, as one expression over the sources in order of cap per weight.
MIX_SQL = r"""
    WITH d AS (
        SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
               md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
    o AS (SELECT *, 2 * source_size AS cap, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS n FROM w),
    p AS (SELECT *, sum(cap) OVER (ORDER BY n) - cap AS below, sum(weight) OVER (ORDER BY n DESC) AS above,
                 1.5 * sum(source_size) OVER () AS budget FROM o),
    c AS (SELECT *, CAST(cap AS DOUBLE) * above <= CAST(weight AS DOUBLE) * (budget - below) AS clamped FROM p),
    l AS (SELECT (CAST(max(budget) AS DOUBLE) - CAST(coalesce(sum(cap) FILTER (clamped), 0) AS DOUBLE))
                 / CAST(sum(weight) FILTER (NOT clamped) AS DOUBLE) AS level FROM c),
    t AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE weight * level END AS target FROM c, l),
    g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
    r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.whole, g.target - g.whole * g.source_size AS want,
                 sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS reach,
                 sum(d.size) OVER (PARTITION BY d.source, d.key) AS own
          FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (whole + CASE WHEN want > 0 AND 2 * reach - own <= 2 * want THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM r
"""
