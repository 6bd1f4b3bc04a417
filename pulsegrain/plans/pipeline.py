"""The whole dataflow as one plan: parse, pre-transform, route, count, emit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.operators import counters as C
from pulsegrain.operators import documents as D
from pulsegrain.operators import routing as R
from pulsegrain.operators.arrival import RUN_LENGTH, normalize_arrival
from pulsegrain.operators.metrics import observe_messages
from pulsegrain.sources.staging import staged
from pulsegrain.specs import App


def flatten(messages: DataFrame, app: App, observed: str | None = None) -> DataFrame:
    """Messages (key, value, timestamp, partition, offset and, where there are several, topic) to flat rows with a tag.

    No shuffle. ``observed`` names metrics of the messages before they fan out: read, failed by step, dropped by the gate."""
    ready = R.pre_transform(D.parse_documents(messages), app)
    return R.route(ready if observed is None else observe_messages(ready, observed), app)


def emit(rows: DataFrame, app: App) -> DataFrame:
    """Flat rows to (topic, key, value) plus the tag, time and position they come from."""
    good = F.col("error").isNull()
    topic = F.when(good, R.topic_of(F.col("tag"), app)).otherwise(F.lit(app.dlq_topic))
    failed = F.coalesce(D.serialise(F.col("row")), D.json_text(F.col("raw")))
    letter = D.error_json(D.error_record(app.name, F.col("step"), F.col("error"), failed))
    return rows.select(
        topic.alias("topic"),
        F.col("key").cast("string").alias("key"),
        F.when(good, D.serialise(F.col("row"))).otherwise(letter).alias("value"),
        "tag", "timestamp", "partition", "offset", "pos",
    )


def run(messages: DataFrame, app: App, order: str = "arrival", run_length: int = RUN_LENGTH) -> DataFrame:
    """Bounded data, with the results of the stream (``pulsegrain.streaming``) over the same messages.

    ``order="arrival"``: counters follow the position of messages, so late readings are treated as in a stream. History is
    played in runs of ``run_length`` offsets.
    ``order="time"``: counters follow the rows' own time, so a late reading finds its place. Both give the same results where
    no reading is late.

    The source is read, parsed and transformed once: with counters, flat rows are written to the shared folder when this is
    called, and what follows reads from there, narrow columns for the counters and whole rows once at the end. Without
    counters nothing is written and nothing shuffled.
    """
    if messages.isStreaming:
        raise ValueError("a stream goes through pulsegrain.streaming.runner.run_stream")
    if order not in ("arrival", "time"):
        raise ValueError(f"order is arrival or time, not {order!r}")
    rows = C.read_counters(flatten(messages, app), app)
    if not C.layers(app):
        return emit(rows, app)
    rows = staged(rows, "flat-rows")
    counted = normalize_arrival(rows, app, run_length) if order == "arrival" else C.normalize_time(rows, app)
    return emit(C.write_counters(counted, app), app)


def to_sink(output: DataFrame) -> DataFrame:
    """The columns a Kafka sink reads."""
    return output.select("topic", "key", "value")
