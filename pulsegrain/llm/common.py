"""Helpers of the training-data operators: shared tables, worker caches, connected components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.session import checkpoint_root

#: ASCII white space; what is between it is a word in every operator here.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table or archive in the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read and read it back; survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """An object made once in a Python process. Task code travels by value, so its modules' globals do not last."""
    kept = vars(sys).setdefault("_pulsegrain_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components: rows (v, component) for every vertex on an edge; component is its smallest vertex.

    ``edges`` has two comparable columns a and b. Large-star and small-star rounds alternate until nothing changes; each
    round is two aggregations and two joins over the edges that are left, so no component is ever in one task. Null
    ends, loops and repeated edges are ignored; no edges give no rows.
    """
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    now, before = stored(both, name), None
    while True:
        # Large star: larger neighbours of u go to the smallest of u and its neighbours.
        around = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select("u", "v").union(now.select(F.col("v").alias("u"), "v")).distinct().select(
        F.col("u").alias("v"), F.col("v").alias("component"))
