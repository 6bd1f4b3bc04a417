"""Registered queries over messages that are odd or fail: nothing in a message ends the job, and every step is counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.operators import metrics
from pulsegrain.operators import routing as R
from pulsegrain.plans.catalog_documents import as_messages, dealt, event_messages, table
from pulsegrain.plans.pipeline import flatten, run
from pulsegrain.specs import App, Pipeline


def _kind():
    return F.col("event_type")


def _rows(messages, transform):
    return flatten(messages, App([Pipeline("t", "t", {}, transform)])).where("error IS NULL AND tag IS NOT NULL")


def rename_collision(spark, sf_dir):
    """A field is renamed to a name that some documents have already: both values are kept in a list."""
    messages = event_messages(spark, sf_dir, label=F.when(_kind() == "click", F.col("user_id")))
    rows = _rows(messages, lambda doc: F.array(V.rename(doc, {"node": "label"})))
    row = F.col("row")
    return rows.select(
        F.col("offset").alias("event_id"), V.read(row, "$.label", "bigint").alias("one"),
        V.read(row, "$.label[0]", "bigint").alias("first"), V.read(row, "$.label[1]", "bigint").alias("second"), S.size(row).alias("n"))


def merge_mixed_list(spark, sf_dir):
    """A list to merge holds numbers, nulls and texts among its objects."""
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    odd = F.when(_kind() == "click", ', 5, null, "x", [1]').otherwise("")
    text = F.concat(F.lit('{"keys": [{"a": '), "event_id", F.lit("}"), odd, F.lit("]}"))
    messages = as_messages(events, F.col("user_id"), text, F.col("ts"), F.col("event_id"))
    rows = _rows(messages, lambda doc: F.array(V.merge_objects(V.elements(doc, "$.keys"))))
    return rows.select(F.col("offset").alias("event_id"), V.read(F.col("row"), "$.a", "bigint").alias("a"), S.size(F.col("row")).alias("n"))


def sort_mixed_list(spark, sf_dir):
    """Lists of number-like texts, of numbers, and of both with nulls; items come back as they were."""
    n = F.pmod(F.col("event_id"), F.lit(50))
    items = F.when(_kind() == "click", F.to_json(F.array(F.lit("10"), F.lit("9"), F.concat(F.lit("00"), n.cast("string"))))).when(
        _kind() == "view", F.concat(F.lit("["), n, F.lit(", 7.5, -1]"))).otherwise(F.concat(F.lit('["b", null, '), n, F.lit(', "NaN"]')))
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    messages = as_messages(events, F.col("user_id"), F.concat(F.lit('{"l": '), items, F.lit("}")), F.col("ts"), F.col("event_id"))
    rows = _rows(messages, lambda doc: F.array(V.row_of({"s": S.sort_list(V.get(doc, "$.l"))})))
    return rows.select(F.col("offset").alias("event_id"), F.to_json(V.get(F.col("row"), "$.s")).alias("sorted"))


def match_long_number(spark, sf_dir):
    """Integers of 38 digits are told apart in their last digit."""
    n = F.pmod(F.col("event_id"), F.lit(10))
    number = (F.lit("9" * 37 + "0").cast("decimal(38,0)") + n.cast("decimal(2,0)")).cast("decimal(38,0)")
    hits = flatten(event_messages(spark, sf_dir, big=number), App([Pipeline("hit", "hits", {"jsonpath": "$.big", "value": int("9" * 37 + "7")})]))
    return hits.where(F.col("tag").isNotNull()).select(F.col("offset").alias("event_id"))


def _checked() -> App:
    return App(
        [
            Pipeline("clicks", "t-clicks", {"jsonpath": "$.kind", "value": "click"}),
            Pipeline("strict", "t-strict", {"not": {"jsonpath": "$.kind", "value": "view"}}, check=lambda doc: F.when(
                V.read(doc, "$.id", "bigint") % 3 == 0, F.lit("a multiple of three"))),
        ],
        pre_check=lambda doc: F.when(V.text(doc, "$.kind") == "error", F.lit("kind is error")),
        pre_transform=lambda doc: R.gate(doc, F.coalesce(V.text(doc, "$.kind") != "signup", F.lit(False))),
        name="catalog",
    )


def _some_broken(spark, sf_dir):
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    document = F.to_json(F.struct(F.col("event_id").alias("id"), _kind().alias("kind")))
    text = F.when((F.col("event_id") % 11 == 0), F.concat(F.lit("{broken "), "event_id")).otherwise(document)
    return as_messages(events, F.col("user_id"), text, F.col("ts"), F.col("event_id"))


def pre_transform_failure(spark, sf_dir):
    """A document that fails before the fan-out goes to the dead letters whole, with that step's name."""
    out = run(_some_broken(spark, sf_dir), _checked()).where(F.col("topic") == "dlq")
    return out.select(
        F.col("offset").alias("event_id"), F.get_json_object("value", "$.processingStep").alias("step"),
        F.get_json_object("value", "$.errorMessage").alias("message"),
        F.get_json_object(F.get_json_object("value", "$.failedValue"), "$.id").cast("bigint").alias("failed_id"))


def step_counts(spark, sf_dir):
    """Messages read, failed and dropped, and rows by pipeline and outcome."""
    return metrics.step_counts(_some_broken(spark, sf_dir), _checked())


def transform_raises(spark, sf_dir):
    """Casts, parsers and divisions that raise: the message goes to the dead letters for that pipeline only, all others go on."""
    n = V.text(F.col("doc"), "$.n")
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    text = F.to_json(F.struct(
        F.col("event_id").alias("id"),
        F.when(_kind() == "click", F.concat(F.lit("#"), "event_id")).otherwise(F.col("event_id").cast("string")).alias("n"),
        F.array(F.col("user_id"), F.pmod("user_id", F.lit(7))).alias("l")))
    app = App([
        Pipeline("twice", "t-twice", {}, lambda doc: F.array(V.row_of({"id": V.get(doc, "$.id"), "n": n.cast("bigint") + n.cast("bigint")}))),
        Pipeline("share", "t-share", {}, lambda doc: F.transform(V.elements(doc, "$.l"), lambda item: V.row_of({
            "id": V.get(doc, "$.id"), "n": (F.lit(420) / V.read(item, "$", "int")).cast("bigint")}))),
    ], pre_check=lambda doc: F.when(F.substring(V.text(doc, "$.n"), -2, 2).cast("int") == 13, F.lit("ends in 13")))
    out = run(as_messages(events, F.col("user_id"), text, F.col("ts"), F.col("event_id")), app)
    failed = F.get_json_object(F.get_json_object("value", "$.failedValue"), "$.id").cast("bigint")
    return out.select(
        "topic", F.col("tag"), F.coalesce(F.get_json_object("value", "$.id").cast("bigint"), failed).alias("event_id"),
        F.get_json_object("value", "$.n").cast("bigint").alias("n"), F.get_json_object("value", "$.processingStep").alias("step"),
        F.get_json_object("value", "$.errorMessage").alias("message"))


QUERIES = {
    f.__name__: f for f in (
        rename_collision, merge_mixed_list, sort_mixed_list, match_long_number, pre_transform_failure, step_counts, transform_raises,
    )
}

_READY = "SELECT event_id AS id, event_type AS kind FROM events WHERE event_id % 11 <> 0 AND event_type NOT IN ('error', 'signup')"

SQL = {
    "rename_collision": """
        SELECT event_id, CASE WHEN event_type <> 'click' THEN user_id END AS one,
               CASE WHEN event_type = 'click' THEN user_id END AS first, CASE WHEN event_type = 'click' THEN user_id END AS second, 4 AS n
        FROM events""",
    "merge_mixed_list": "SELECT event_id, event_id AS a, 1 AS n FROM events",
    "sort_mixed_list": """
        SELECT event_id, CASE
            WHEN event_type = 'click' AND n <= 9 THEN '["00' || n || '","9","10"]'
            WHEN event_type = 'click' AND n < 10 THEN '["9","00' || n || '","10"]'
            WHEN event_type = 'click' AND n = 10 THEN '["9","0010","10"]'
            WHEN event_type = 'click' THEN '["9","10","00' || n || '"]'
            WHEN event_type = 'view' AND n < 7.5 THEN '[-1,' || n || ',7.5]'
            WHEN event_type = 'view' THEN '[-1,7.5,' || n || ']'
            ELSE '[' || n || ',"NaN","b",null]' END AS sorted
        FROM (SELECT *, event_id % 50 AS n FROM events)""",
    "match_long_number": "SELECT event_id FROM events WHERE event_id % 10 = 7",
    "pre_transform_failure": """
        SELECT event_id, 'parse' AS step, 'not valid JSON' AS message, NULL AS failed_id FROM events WHERE event_id % 11 = 0
        UNION ALL
        SELECT event_id, 'pre-transform', 'kind is error', event_id FROM events WHERE event_id % 11 <> 0 AND event_type = 'error'
        UNION ALL
        SELECT event_id, 'transform', 'a multiple of three', event_id FROM events
        WHERE event_id % 11 <> 0 AND event_id % 3 = 0 AND event_type NOT IN ('error', 'signup', 'view')""",
    "transform_raises": """
        WITH read AS (
            SELECT *, CASE WHEN event_type = 'click' THEN '#' || event_id ELSE event_id::VARCHAR END AS text FROM events
        ), tried AS (
            SELECT *, right(text, 2) AS tail FROM read
        ), ready AS (SELECT * FROM tried WHERE try_cast(tail AS INT) <> 13)
        SELECT 'dlq' AS topic, NULL AS tag, event_id, NULL::BIGINT AS n, 'pre-transform' AS step,
               CASE WHEN try_cast(tail AS INT) = 13 THEN 'ends in 13' ELSE 'an expression raised an error' END AS message
        FROM tried WHERE coalesce(try_cast(tail AS INT) = 13, TRUE)
        UNION ALL
        SELECT CASE WHEN event_type = 'click' THEN 'dlq' ELSE 't-twice' END, 'twice', event_id, CASE WHEN event_type <> 'click' THEN 2 * event_id END,
               CASE WHEN event_type = 'click' THEN 'transform' END, CASE WHEN event_type = 'click' THEN 'an expression raised an error' END
        FROM ready
        UNION ALL
        SELECT 'dlq', 'share', event_id, NULL, 'transform', 'an expression raised an error' FROM ready WHERE user_id % 7 = 0
        UNION ALL
        SELECT 't-share', 'share', event_id, trunc(420 / item)::BIGINT, NULL, NULL
        FROM (SELECT event_id, unnest([user_id, user_id % 7]) AS item FROM ready WHERE user_id % 7 <> 0)""",
    "step_counts": f"""
        SELECT 'read' AS step, NULL AS tag, NULL AS outcome, count(*) AS n FROM events
        UNION ALL SELECT 'parse', NULL, NULL, count(*) FROM events WHERE event_id % 11 = 0
        UNION ALL SELECT 'pre-transform', NULL, NULL, count(*) FROM events WHERE event_id % 11 <> 0 AND event_type = 'error'
        UNION ALL SELECT 'dropped', NULL, NULL, count(*) FROM events WHERE event_id % 11 <> 0 AND event_type = 'signup'
        UNION ALL SELECT 'rows', 'clicks', 'emitted', count(*) FROM ({_READY}) WHERE kind = 'click' HAVING count(*) > 0
        UNION ALL SELECT 'rows', 'strict', CASE WHEN id % 3 = 0 THEN 'error' ELSE 'emitted' END, count(*) FROM ({_READY}) WHERE kind <> 'view' GROUP BY ALL
        UNION ALL SELECT 'rows', NULL, 'discarded', count(*) FROM ({_READY}) WHERE kind = 'view' HAVING count(*) > 0""",
}
