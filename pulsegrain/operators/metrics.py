"""Counts of the dataflow as data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrain.operators import documents as D
from pulsegrain.operators import routing as R
from pulsegrain.specs import App


def outcome(app: App) -> Column:
    """``error``, ``discarded`` or ``emitted`` for a row of the output."""
    return (
        F.when(F.col("topic") == app.dlq_topic, "error")
        .when(F.col("topic") == app.discard_topic, "discarded")
        .otherwise("emitted")
    )


def counts(output: DataFrame, app: App) -> DataFrame:
    """Rows per pipeline tag and outcome."""
    return output.groupBy("tag", outcome(app).alias("outcome")).agg(F.count("*").alias("n"))


def _steps() -> dict[str, Column]:
    """Counts over messages after the pre-transform, before they fan out."""
    return {
        "read": F.count("*"), "parse": F.count(F.when(F.col("failed_at") == D.PARSE, True)),
        "pre-transform": F.count(F.when(F.col("failed_at") == D.PRE_TRANSFORM, True)), "dropped": F.count(F.when(F.col("dropped"), True)),
    }


def observe_messages(ready: DataFrame, name: str) -> DataFrame:
    """Attach the counts of the steps before the fan-out; they are collected while the data flows."""
    return ready.observe(name, *[count.alias(step) for step, count in _steps().items()])


def step_counts(messages: DataFrame, app: App) -> DataFrame:
    """Rows (step, tag, outcome, n): messages read, failed in parsing or before the fan-out, dropped, and rows by pipeline."""
    ready = R.pre_transform(D.parse_documents(messages), app)
    before = ready.agg(*[count.alias(step) for step, count in _steps().items()]).select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(step) for step in _steps()]), F.array(*[F.col(f"`{step}`") for step in _steps()]))).alias("step", "n"))
    after = R.route(ready, app).where(F.col("error").isNull() | F.col("tag").isNotNull()).groupBy(
        "tag", F.when(F.col("error").isNotNull(), "error").when(F.col("tag").isNull(), "discarded").otherwise("emitted").alias("outcome")).agg(F.count("*").alias("n"))
    none = F.lit(None).cast("string")
    return before.select("step", none.alias("tag"), none.alias("outcome"), "n").unionByName(after.select(F.lit("rows").alias("step"), "tag", "outcome", "n"))


def observe(output: DataFrame, app: App, name: str = "dataflow") -> DataFrame:
    """Attach counters that are collected while the data flows; read them from the query's progress."""
    kind = outcome(app)
    return output.observe(
        name,
        F.count("*").alias("rows"),
        *[
            F.count(F.when(kind == value, True)).alias(value) for value in ("emitted", "discarded", "error")
        ],
        *[
            F.count(F.when(F.col("tag") == tag, True)).alias(f"tag:{tag}") for tag in app.topics
        ],
    )


def state_numbers(query: StreamingQuery) -> list[dict]:
    """State rows, removals and memory per stateful operator of the last micro-batch."""
    progress = query.lastProgress
    if progress is None:
        return []
    return [
        {
            "operator": state.operatorName, "rows": state.numRowsTotal, "updated": state.numRowsUpdated,
            "removed": state.numRowsRemoved, "memory_bytes": state.memoryUsedBytes,
        }
        for state in progress.stateOperators
    ]


def step_durations(query: StreamingQuery) -> dict[str, int]:
    """Milliseconds per phase of the last micro-batch."""
    return dict(query.lastProgress.durationMs) if query.lastProgress is not None else {}
