"""Sinks: the topic is a column, so one write serves all pipelines, the discard topic and the dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

SINK = ("topic", "key", "value")


def kafka_writer_options(
    servers: str, acks: str = "all", idempotent: bool = True, compression: str = "gzip", **extra: str
) -> dict[str, str]:
    """Delivery settings of the producer."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": acks,
        "kafka.enable.idempotence": str(idempotent).lower(),
        "kafka.compression.type": compression,
        **{f"kafka.{name}": value for name, value in extra.items()},
    }


def write_files(output: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """One folder per topic."""
    output.select(*SINK, "tag", "timestamp").write.format(fmt).mode(mode).partitionBy("topic").save(path)


def write_kafka(output: DataFrame, **options) -> None:
    output.select(*SINK).write.format("kafka").options(**kafka_writer_options(**options)).save()


def stream_files(output: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Exactly-once files, one folder per topic."""
    return (
        output.select(*SINK, "tag", "timestamp").writeStream.format(fmt).outputMode("append")
        .partitionBy("topic").option("path", path).option("checkpointLocation", checkpoint)
    )


def stream_kafka(output: DataFrame, checkpoint: str, **options) -> DataStreamWriter:
    """At-least-once to topics."""
    return (
        output.select(*SINK).writeStream.format("kafka").outputMode("append")
        .options(**kafka_writer_options(**options)).option("checkpointLocation", checkpoint)
    )
