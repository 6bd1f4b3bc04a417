"""Text to document and back, and the record of a failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.functions.scalars import parse_text

# What rows keep of their message. Names are those of Spark's Kafka source; ``origin`` is the topic it came from, empty
# where a source has none.
ENVELOPE = ("key", "timestamp", "origin", "partition", "offset")

# The place of a row; unique, since ``pos`` counts the rows of a message. Several topics may share offsets.
POSITION = ("origin", "partition", "offset", "pos")

# Names of the steps that can send a message to the dead letters.
PARSE, PRE_TRANSFORM, TRANSFORM, COUNTERS = "parse", "pre-transform", "transform", "counters"

_SPACE = " \t\r\n"


def opens_object(value: Column, doc: Column) -> Column:
    """The parsed text is an object. Judged by its first sign; only text led by a comment is looked into."""
    lead = F.ltrim(value, F.lit(_SPACE))
    return doc.isNotNull() & (lead.startswith("{") | (lead.startswith("/") & V.is_object(doc)))


def is_whole(value: Column) -> Column:
    """Whether nothing but white space and comments follows the JSON value that a text begins with. Spark's parser stops behind it. A text
    that closes one kind of bracket too many, or holds another value, does not fit between the other kind, or is one of several."""
    options = {"allowComments": "true", "allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), value, F.lit("\n]")), "array<string>", options)
    held = F.from_json(F.concat(F.lit('{"":'), value, F.lit("\n}")), "map<string,string>", options)
    return F.coalesce((F.size(listed) == 1) & held.isNotNull(), F.lit(False))


def parse_documents(messages: DataFrame) -> DataFrame:
    """Add ``doc`` (VARIANT, NULL if bad) and ``error`` (text, NULL if good)."""
    origin = F.coalesce(F.col("topic"), F.lit("")) if "topic" in messages.columns else F.lit("")
    parsed = messages.withColumn("origin", origin).withColumn("doc", parse_text(F.col("value")))
    good = F.coalesce(opens_object(F.col("value"), F.col("doc")), F.lit(False))
    bad = F.col("doc").isNull() | ~is_whole(F.col("value"))
    reason = F.when(F.col("value").isNull(), "no value").when(bad, "not valid JSON")
    return parsed.withColumn("error", F.when(~good, F.coalesce(reason, F.lit("not a JSON object")))).withColumn(
        "doc", F.when(good, F.col("doc"))
    )


def serialise(doc: Column) -> Column:
    """JSON text of a document; JSON nulls stay visible, integers have all their digits."""
    return V.plain_json(F.to_json(doc))


def json_text(value: Column) -> Column:
    """A text as a JSON string literal, quotes and escapes included."""
    return F.to_json(V.variant(value))


def error_record(app_name: str, step: Column, message: Column, failed: Column) -> Column:
    """The nine fields of a dead letter; ``failed`` is JSON text already."""
    return F.struct(
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp"),
        F.lit(app_name).alias("applicationId"),
        F.lit(None).cast("string").alias("taskId"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        step.alias("processingStep"),
        F.col("key").cast("string").alias("key"),
        message.alias("errorMessage"),
        failed.alias("failedValue"),
    )


def error_json(record: Column) -> Column:
    return F.to_json(record, {"ignoreNullFields": "false"})


# Names that Avro's JSON form gives the branches of a union.
_BRANCHES = {
    "string": "string", "int": "int", "bigint": "long", "float": "float", "double": "double", "boolean": "boolean",
}


def typed_document(rows: DataFrame, names: Sequence[str], unions: Sequence[str] = ()) -> Column:
    """JSON text of typed columns, nulls visible. Columns in ``unions`` are shown the way Avro's JSON form shows optional
    fields: ``null`` or an object named after the type."""
    types = dict(rows.dtypes)

    def shown(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name in unions:
            return F.when(column.isNotNull(), F.struct(column.alias(_BRANCHES[types[name]]))).alias(name)
        return column.alias(name)

    document = F.to_json(F.struct(*[shown(name) for name in names]), {"ignoreNullFields": "false"})
    return V.round_doubles(document) if any("double" in types[name] or "float" in types[name] for name in names) else document


def typed_to_messages(
    rows: DataFrame, key: Column, timestamp: Column, partition: Column, offset: Column, unions: Sequence[str] = (),
) -> DataFrame:
    """Rows of a typed source (a stream or a table) as JSON messages."""
    return rows.select(
        key.cast("string").alias("key"),
        typed_document(rows, rows.columns, unions).alias("value"),
        timestamp.cast("timestamp").alias("timestamp"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
    )
