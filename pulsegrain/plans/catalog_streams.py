"""Registered queries over streams: stored messages drained part by part, over restarts, from a batch, and the state they leave."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.operators import counters as C
from pulsegrain.operators.arrival import last_readings
from pulsegrain.plans import catalog_counters as K
from pulsegrain.plans import catalog_failures as B
from pulsegrain.plans.catalog_documents import event_messages
from pulsegrain.plans.pipeline import flatten
from pulsegrain.session import checkpoint_root
from pulsegrain.sources.readers import MESSAGE_SCHEMA, stored_batch, stored_stream
from pulsegrain.specs import App
from pulsegrain.streaming import progress
from pulsegrain.streaming.runner import run_stream
from pulsegrain.streaming.state import readings

PARTS = 3


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(
        spark, sf_dir, a=K._rising(39_916, 2**32),
        b=F.when(F.col("event_type") != "view", K._rising(71, 2**32).cast("string")),
    ).withColumn("topic", F.lit("events")).select(*[part.split(" ")[0] for part in MESSAGE_SCHEMA.split(", ")])


def _app(*names: str) -> App:
    return K._app(K._set(*names, kind="u32"), K._config(u32_limit=2**31 - 1))


def _part(messages: DataFrame) -> Column:
    """Third of the offsets that a message is in."""
    end = messages.agg(F.max("offset")).first()[0] or 0
    return F.floor(F.col("offset") * PARTS / F.lit(end + 1))


def _drain(spark: SparkSession, folder: str, app: App, initial: DataFrame | None = None) -> None:
    """Everything that is in the folder and not yet read, as one micro-batch, in which rows are ordered by offset."""
    output = run_stream(stored_stream(spark, f"{folder}/in", max_files=None), app, initial)
    query = output.select("topic", "offset", "value").writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def _drained(spark: SparkSession, sf_dir: str, apps: Sequence[App]) -> str:
    """A folder in which messages came in parts, each read by a stream that started again with an app of its own."""
    folder = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    messages = _messages(spark, sf_dir)
    part = _part(messages)
    for number, app in enumerate(apps):
        messages.where(part == number).write.mode("append").parquet(f"{folder}/in")
        _drain(spark, folder, app)
    return folder


def _out(spark: SparkSession, folder: str) -> DataFrame:
    return K._values(spark.read.schema("topic string, offset bigint, value string").parquet(f"{folder}/out"), "a", "b")


def counter_stream(spark, sf_dir):
    """The counters of ``counter_delta_u32`` over a stream in several micro-batches and restarts."""
    return _out(spark, _drained(spark, sf_dir, [_app("a", "b")] * PARTS))


def stream_changed_counters(spark, sf_dir):
    """Counters change places over the first restart, and one of them is no counter any more after the second."""
    return _out(spark, _drained(spark, sf_dir, [_app("a", "b"), _app("b", "a"), _app("a")]))


def stream_state(spark, sf_dir):
    """What a stream holds in the end, read from its checkpoint."""
    folder = _drained(spark, sf_dir, [_app("a", "b")] * PARTS)
    return readings(spark, f"{folder}/checkpoint").select(
        "tag", F.get(F.split("entity", ","), F.lit(1)).cast("bigint").alias("user_id"), F.get_json_object("name", "$[1]").alias("counter"), "value", "time")


def stream_from_batch(spark, sf_dir):
    """The last part of the messages as a stream that starts with what a batch over the parts before it holds."""
    folder, app = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}", _app("a", "b")
    messages = _messages(spark, sf_dir)
    part = _part(messages)
    messages.where(part < PARTS - 1).write.parquet(f"{folder}/before")
    messages.where(part == PARTS - 1).write.parquet(f"{folder}/in")
    before = C.read_counters(flatten(stored_batch(spark, f"{folder}/before"), app), app)
    _drain(spark, folder, app, last_readings(before, app))
    return _out(spark, folder)


def stream_progress(spark, sf_dir):
    """Counts of all micro-batches of a stream, over restarts, from the table that a listener writes. Messages break in every step."""
    folder = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    messages = B._some_broken(spark, sf_dir).withColumn("topic", F.lit("events")).select(*[part.split(" ")[0] for part in MESSAGE_SCHEMA.split(", ")])
    part = _part(messages)
    log = progress.ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)
    try:
        for number in range(PARTS):
            messages.where(part == number).write.mode("append").parquet(f"{folder}/in")
            output = run_stream(stored_stream(spark, f"{folder}/in", max_files=None), B._checked(), observed="steps")
            query = output.select("topic", "offset", "value").writeStream.format("parquet").option("path", f"{folder}/out").option(
                "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
            log.wait(query)
    finally:
        spark.streams.removeListener(log)
    return progress.totals(progress.read(spark, f"{folder}/progress")).where("part <> 'duration-ms'")


QUERIES = {query.__name__: query for query in (counter_stream, stream_changed_counters, stream_state, stream_from_batch, stream_progress)}

_THIRD = f"floor(event_id * {PARTS} / (SELECT max(event_id) + 1.0 FROM events))"


def _last_sql(name: str, value: str, where: str) -> str:
    return f"""
        SELECT 'c' AS tag, user_id, '{name}' AS counter, CAST(arg_max({value}, event_id) AS VARCHAR) AS value,
               CAST(max(epoch_us(ts) // 1000) AS BIGINT) AS time FROM events WHERE {where} GROUP BY user_id"""


SQL = {
    "counter_stream": K._U32,
    "stream_changed_counters": f"""
        SELECT event_id, a, CASE WHEN {_THIRD} < {PARTS - 1} THEN b WHEN event_type <> 'view' THEN CAST({K._rising_sql(71, 2**32)} AS BIGINT) END AS b
        FROM ({K._U32}) JOIN events USING (event_id)""",
    "stream_state": _last_sql("a", K._rising_sql(39_916, 2**32), "true") + " UNION ALL " + _last_sql(
        "b", K._rising_sql(71, 2**32), "event_type <> 'view'"),
    "stream_progress": f"""
        WITH good AS ({B._READY}), rows AS (
            SELECT 'clicks' AS tag, 'emitted' AS kind FROM good WHERE kind = 'click'
            UNION ALL SELECT 'strict', CASE WHEN id % 3 = 0 THEN 'error' ELSE 'emitted' END FROM good WHERE kind <> 'view'
            UNION ALL SELECT NULL, 'discarded' FROM good WHERE kind = 'view'
            UNION ALL SELECT NULL, 'error' FROM events WHERE event_id % 11 = 0 OR event_type = 'error'
        )
        SELECT 'source' AS part, 'rows' AS name, count(*) AS n FROM events
        UNION ALL SELECT 'steps', 'read', count(*) FROM events
        UNION ALL SELECT 'steps', 'parse', count(*) FROM events WHERE event_id % 11 = 0
        UNION ALL SELECT 'steps', 'pre-transform', count(*) FROM events WHERE event_id % 11 <> 0 AND event_type = 'error'
        UNION ALL SELECT 'steps', 'dropped', count(*) FROM events WHERE event_id % 11 <> 0 AND event_type = 'signup'
        UNION ALL SELECT 'steps-rows', 'rows', count(*) FROM rows
        UNION ALL SELECT 'steps-rows', o.kind, count(rows.kind) FROM (VALUES ('emitted'), ('discarded'), ('error')) o(kind)
                  LEFT JOIN rows ON rows.kind = o.kind GROUP BY o.kind
        UNION ALL SELECT 'steps-rows', 'tag:' || o.tag, count(rows.tag) FROM (VALUES ('clicks'), ('strict')) o(tag)
                  LEFT JOIN rows ON rows.tag = o.tag GROUP BY o.tag""",
    "stream_from_batch": f"SELECT event_id, a, b FROM ({K._U32}) WHERE {_THIRD} = {PARTS - 1}",
}
