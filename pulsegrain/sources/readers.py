"""Message sources. Every reader gives key, value, timestamp, topic, partition, offset.

Positions (topic, partition, offset) must be unique and the same each time a task is run again, since they break ties of
time. Kafka and stored messages bring their own. For other files the place of a record in its split is taken right at
the scan, where it depends on nothing but the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrain.operators.documents import typed_document, typed_to_messages

MESSAGE_SCHEMA = "key string, value string, timestamp timestamp, topic string, partition int, offset bigint"


def kafka_options(
    servers: str, topic: str | None = None, pattern: str | None = None, starting: str = "latest",
    max_offsets: int | None = None, **extra: str,
) -> dict[str, str]:
    """Reader options; a topic pattern wins over a topic name. ``max_offsets`` bounds a micro-batch of a stream and with it the
    rows of one entity that a task sorts at a time; without it a micro-batch takes all there is."""
    if topic is None and pattern is None:
        raise ValueError("a topic or a topic pattern is needed")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting, **extra}
    if pattern is not None:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = topic
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def _from_kafka(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "timestamp", "topic", "partition", "offset",
    )


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """Topics as a stream; needs Spark's Kafka package on the class path."""
    return _from_kafka(spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def kafka_batch(spark: SparkSession, **options) -> DataFrame:
    """A bounded replay of topics; all of it, so there is no limit to give."""
    if "max_offsets" in options:
        raise TypeError("max_offsets bounds micro-batches of a stream")
    options.setdefault("starting", "earliest")
    return _from_kafka(spark.read.format("kafka").options(**kafka_options(**options)).load())


def stored_stream(spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Messages stored as files in the message schema, as a stream; ``path`` may be a glob.

    Files arrive in order of their modification time. ``max_files`` bounds a micro-batch; None takes all there are at once,
    for files that were written side by side and so have no order of their own.
    """
    reader = spark.readStream.format(fmt).schema(MESSAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stored_batch(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files with one message per line."""
    return spark.read.text(path).select(
        F.lit(None).cast("string").alias("key"), "value", F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(path).alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
    )


def typed_batch(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None,
    key: str | None = None, timestamp: str | None = None, unions: Sequence[str] = (),
) -> DataFrame:
    """Records of a typed format (Parquet, ORC; Avro where its package is present) as JSON messages."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    names = rows.columns
    when = F.col(timestamp) if timestamp else F.col("_metadata.file_modification_time")
    held = rows.select(*names, when.alias("_time"), F.monotonically_increasing_id().alias("_place"))
    document = typed_document(rows, names, unions)
    return held.select(
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"), document.alias("value"),
        F.col("_time").cast("timestamp").alias("timestamp"), F.lit(path).alias("topic"),
        F.lit(0).alias("partition"), F.col("_place").alias("offset"),
    )


__all__ = [
    "MESSAGE_SCHEMA", "json_lines", "kafka_batch", "kafka_options", "kafka_stream", "stored_batch", "stored_stream",
    "typed_batch", "typed_to_messages",
]
