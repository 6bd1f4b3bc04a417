"""Readings that a stream holds, as a table, and readings to start a stream with.

All tables here have one row per counter key: layer, tag, entity, name (the constants of the key), value (integer text) and
time. ``readings`` reads them from the checkpoint of a stream, ``operators.arrival.last_readings`` takes them from bounded
data; either may be the ``initial`` of a new stream. So history can be replayed as a batch before a stream takes over, and a
stream whose counters get another entity, which needs a new checkpoint, goes on with what the old one knew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.streaming.counters import READINGS

COLUMNS = ("layer", "tag", "entity", "name", "value", "time")


def steps(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the stateful steps in a checkpoint, by layer. Steps are numbered from the end of the plan on."""
    rows = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()
    return sorted((row.operatorId for row in rows), reverse=True)


def readings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The readings in the last state that a stream has written to its checkpoint; read by Spark, one task per state partition."""
    found = None
    for layer, number in enumerate(steps(spark, checkpoint)):
        state = spark.read.format("statestore").option("operatorId", number).option("stateVarName", READINGS).load(checkpoint)
        rows = state.select(
            F.lit(layer).alias("layer"), F.col("key._tag").alias("tag"), F.col("key._entity").alias("entity"),
            F.explode(F.arrays_zip("value.names", "value.held", "value.times")).alias("one"),
        ).select("layer", "tag", "entity", F.col("one.names").alias("name"), F.col("one.held").alias("value"), F.col("one.times").alias("time"))
        found = rows if found is None else found.union(rows)
    if found is None:
        raise ValueError(f"no stateful step in {checkpoint!r}")
    return found
