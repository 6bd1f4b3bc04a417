"""Registered queries over documents: parsing, matching, routing, scalar functions, time rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.functions.times import epoch_millis
from pulsegrain.operators import documents as D
from pulsegrain.operators import metrics
from pulsegrain.operators import routing as R
from pulsegrain.operators.counters import counter_key
from pulsegrain.plans.pipeline import emit, flatten, run
from pulsegrain.session import configure
from pulsegrain.sources.readers import typed_batch
from pulsegrain.specs import App, CounterSpec, KeyPart, Pipeline


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over partitions by a key, as a topic would bring them. The tables come as single files of one row group, which one
    task would read alone; rows are dealt whatever their number."""
    return df.repartition(key)


def as_messages(df: DataFrame, key: Column, document: Column, timestamp: Column, offset: Column) -> DataFrame:
    """Rows of a table as messages; the row's own number is its position."""
    return df.select(
        key.cast("string").alias("key"), document.alias("value"), timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"),
    )


def event_messages(spark: SparkSession, sf_dir: str, **fields: Column) -> DataFrame:
    """Every event as a JSON message; further fields are added to the document."""
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    document = F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("user_id").alias("node"), F.col("event_type").alias("kind"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
        *[column.alias(name) for name, column in fields.items()],
    ))
    return as_messages(events, F.col("user_id"), document, F.col("ts"), F.col("event_id"))


def docs(messages: DataFrame) -> DataFrame:
    """Messages to offset and document."""
    return D.parse_documents(messages).select("offset", "doc")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# ---- parsing ---------------------------------------------------------------------------------------------------

def _mixed(spark, sf_dir) -> DataFrame:
    texts = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events")
    return as_messages(texts, F.lit("documents"), F.col("text"), F.lit(0).cast("timestamp"), F.col("doc_id")).unionByName(
        as_messages(events, F.lit("events"), F.col("props"), F.col("ts"), F.col("event_id"))
    )


def parse_ok(spark, sf_dir):
    parsed = flatten(_mixed(spark, sf_dir), App([])).where(F.col("error").isNull())
    return parsed.select("key", F.col("offset").alias("id"), V.read(F.col("row"), "$.k", "bigint").alias("k"))


def parse_errors(spark, sf_dir):
    app = App([], name="catalog")
    letters = run(_mixed(spark, sf_dir), app).where(F.col("topic") == "dlq")
    return letters.select(
        F.get_json_object("value", "$.key").alias("key"),
        F.get_json_object("value", "$.offset").cast("bigint").alias("id"),
        F.get_json_object("value", "$.processingStep").alias("step"),
        F.get_json_object("value", "$.applicationId").alias("app"),
        F.get_json_object("value", "$.errorMessage").alias("message"),
        F.md5(F.get_json_object("value", "$.failedValue").cast("binary")).alias("failed_md5"),
    )


def big_ints_kept(spark, sf_dir):
    big = (F.lit("18446744073700000000").cast("decimal(20,0)") + F.col("event_id")).cast("string")
    events = table(spark, sf_dir, "events")
    text = F.concat(F.lit('{"n": '), big, F.lit(', "s": "'), big, F.lit('", "neg": -'), big, F.lit("}"))
    parsed = docs(as_messages(events, F.col("user_id"), text, F.col("ts"), F.col("event_id")))
    return parsed.select(
        F.col("offset").alias("event_id"),
        *[S.whole(V.get(F.col("doc"), f"$.{name}")).cast("string").alias(name) for name in ("n", "s", "neg")],
        V.text(F.col("doc"), "$.n").alias("shown"),
    )


def long_integers_kept(spark, sf_dir):
    """Integers of 60 digits, as numbers and as texts, leave in the form they came in."""
    big = F.concat(F.lit("7" * 48), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    text = F.concat(F.lit('{"id": '), "event_id", F.lit(', "l": ['), big, F.lit(', "'), big, F.lit('"], "neg": -'), big, F.lit("}"))
    out = run(as_messages(table(spark, sf_dir, "events"), F.col("user_id"), text, F.col("ts"), F.col("event_id")), App([]))
    return out.select(F.col("offset").alias("event_id"), "value")


# ---- matching --------------------------------------------------------------------------------------------------

def _matched(messages: DataFrame, match: dict) -> DataFrame:
    hits = flatten(messages, App([Pipeline("hit", "hits", match)])).where(F.col("tag").isNotNull())
    return hits.select(F.col("offset").alias("event_id"))


def match_value(spark, sf_dir):
    return _matched(event_messages(spark, sf_dir), {"jsonpath": "$.kind", "value": "click"})


def match_number(spark, sf_dir):
    """Numbers match by value, and a number text is no number."""
    k = _k()
    messages = event_messages(
        spark, sf_dir, num=F.when(k % 2 == 0, k), half=F.round(k / 2, 1), txt=k.cast("string")
    )
    return _matched(messages, {"or": [
        {"jsonpath": "$.num", "value": 42}, {"jsonpath": "$.half", "value": 10.5}, {"jsonpath": "$.txt", "value": 7},
    ]})


def match_exists(spark, sf_dir):
    k = _k()
    messages = event_messages(
        spark, sf_dir, extra=F.when(k < 50, k),
        items=F.when(k % 3 == 0, F.array(k)).when(k % 3 == 1, F.array().cast("array<int>")),
    )
    return _matched(messages, {"or": [{"jsonpath": "$.extra"}, {"jsonpath": "$.items"}]})


def match_and_or_not(spark, sf_dir):
    messages = event_messages(spark, sf_dir, extra=F.when(_k() < 50, _k()))
    return _matched(messages, {"and": [
        {"not": {"jsonpath": "$.missing.path", "value": "x"}},
        {"or": [{"jsonpath": "$.kind", "value": "view"}, {"not": {"jsonpath": "$.extra"}}, {"constant": False}]},
        {}, {"constant": True}, {"and": []}, {"not": {"or": []}},
    ]})


def match_wildcard(spark, sf_dir):
    k = _k()
    item = F.struct(F.when(k % 2 == 0, k).alias("v:even"), F.when(k % 5 == 0, k).alias("v-five"))
    messages = event_messages(spark, sf_dir, list=F.array(item, item))
    return _matched(messages, {"jsonpath": "$.list[*]['v:even']"})


# ---- routing ---------------------------------------------------------------------------------------------------

def _gate(doc: Column) -> Column:
    return R.gate(
        R.whitelist(doc, ["id", "kind", "absent"]),
        F.coalesce(V.text(doc, "$.kind").isin("click", "view"), F.lit(False)),
    )


def gate_whitelist(spark, sf_dir):
    """Only two kinds get in, only listed fields stay; the rest vanishes without trace."""
    app = App([], pre_transform=_gate)
    out = run(event_messages(spark, sf_dir), app)
    return out.select("topic", F.col("offset").alias("event_id"), "value")


def nested_gate(spark, sf_dir):
    """A gate on a key deep inside the document, whatever its value."""
    deep = F.struct(F.struct(F.when(_k() % 4 == 0, F.lit("")).alias("ns:encode-json")).alias("encoding"))
    app = App([], pre_transform=lambda doc: R.gate(
        doc, V.get(doc, "$['ns:meta'].encoding['ns:encode-json']").isNotNull()))
    out = run(event_messages(spark, sf_dir, **{"ns:meta": deep}), app)
    return out.select("topic", F.col("offset").alias("event_id"))


def _routes() -> App:
    return App([
        Pipeline("clicks", "t-clicks", {"jsonpath": "$.kind", "value": "click"}),
        Pipeline("small", "t-small", {"jsonpath": "$.small"}),
        Pipeline("never", "t-never", {"constant": False}),
        Pipeline("empty", "t-empty", {"jsonpath": "$.kind", "value": "view"}, lambda doc: F.array().cast("array<variant>")),
    ])


def _routed(spark, sf_dir) -> DataFrame:
    return flatten(event_messages(spark, sf_dir, small=F.when(_k() < 30, _k())), _routes())


def multi_route(spark, sf_dir):
    """One row per message and matching branch."""
    return _routed(spark, sf_dir).where(F.col("tag").isNotNull()).select(
        "tag", F.col("offset").alias("event_id"), V.text(F.col("row"), "$.kind").alias("kind"))


def route_unmatched(spark, sf_dir):
    return _routed(spark, sf_dir).where(F.col("tag").isNull()).select(F.col("offset").alias("event_id"))


def route_counts(spark, sf_dir):
    app = _routes()
    return metrics.counts(emit(_routed(spark, sf_dir), app), app)


def topic_dispatch(spark, sf_dir):
    return emit(_routed(spark, sf_dir), _routes()).select("topic", F.col("offset").alias("event_id"))


def transform_failure(spark, sf_dir):
    """A branch whose check fails sends the document to the dead letters; the other branch is not touched."""
    app = App([
        Pipeline("strict", "t-strict", {}, check=lambda doc: F.when(
            V.text(doc, "$.kind") == "error", F.lit("kind is error"))),
        Pipeline("easy", "t-easy", {}),
    ])
    out = run(event_messages(spark, sf_dir), app)
    return out.select(
        "topic", "tag", F.col("offset").alias("event_id"),
        F.get_json_object("value", "$.errorMessage").alias("message"),
        F.get_json_object(F.get_json_object("value", "$.failedValue"), "$.id").cast("bigint").alias("failed_id"),
    )


def typed_source(spark, sf_dir):
    """Typed records as JSON documents, then the same dataflow."""
    configure(spark)
    messages = typed_batch(spark, f"{sf_dir}/supplier.parquet", key="s_name")
    rich = {"not": {"jsonpath": "$.s_nationkey", "value": 7}}
    app = App([Pipeline("suppliers", "t-suppliers", rich, lambda doc: F.array(
        V.row_of({"renamed": V.get(doc, "$.s_name"), "nation": V.get(doc, "$.s_nationkey")})))])
    return run(messages, app).select("topic", "key", "value")


# ---- functions -------------------------------------------------------------------------------------------------

def decode_json_strings(spark, sf_dir):
    """JSON inside text is decoded, alone and in lists; other text stays."""
    messages = event_messages(
        spark, sf_dir, inner=F.concat(F.lit("  "), "props", F.lit(" ")), plain=F.col("event_type"),
        several=F.array(F.col("props"), F.col("event_type"), F.lit("[1, 2]")),
    )
    doc = F.col("doc")
    changed = V.put(doc, {name: S.decode_json(V.get(doc, f"$.{name}")) for name in ("inner", "plain", "several")})
    new = docs(messages).select("offset", changed.alias("doc"))
    return new.select(
        F.col("offset").alias("event_id"), V.read(doc, "$.inner.k", "bigint").alias("k"),
        V.text(doc, "$.plain").alias("plain"), V.read(doc, "$.several[0].k", "bigint").alias("k0"),
        V.text(doc, "$.several[1]").alias("s1"), V.read(doc, "$.several[2][1]", "bigint").alias("two"),
    )


def arith_functions(spark, sf_dir):
    k = _k()
    messages = event_messages(
        spark, sf_dir, k=k, kt=k.cast("string"), ns=F.col("event_id") * 1_000_000_000 + 123_456,
        huge=F.lit(2**62), zero=k - k, list=F.array(k, k + 1, k + 2), word=F.col("event_type"),
    )
    doc = F.col("doc")

    def at(name):
        return V.get(doc, f"$.{name}")

    return docs(messages).select(
        F.col("offset").alias("event_id"),
        S.multiply(at("k"), at("kt")).alias("square"),
        S.multiply(at("k"), at("huge")).alias("overflow"),
        S.multiply(at("k"), at("word")).alias("no_number"),
        S.divide(at("ns"), F.parse_json(F.lit("1000000"))).try_cast("bigint").alias("ms"),
        S.divide(at("k"), at("zero")).alias("by_zero"),
        V.read(S.to_long(at("kt")), "$", "bigint").alias("as_long"),
        V.text(F.coalesce(S.to_integer(at("word")), at("word"))).alias("stays"),
        V.text(S.to_text(at("k"))).alias("as_text"),
        S.join(".", at("list")).alias("joined"),
        S.long_sum(at("list")).alias("total"),
        S.long_subtract(at("k"), at("id")).alias("less"),
        S.largest(at("list")).cast("bigint").alias("top"),
        S.smallest(at("list")).cast("bigint").alias("low"),
        S.average(at("list")).alias("mean"),
        V.read(S.absolute(V.variant(S.long_subtract(at("zero"), at("k")))), "$", "bigint").alias("positive"),
        V.read(S.last_element(at("list")), "$", "bigint").alias("last"),
        V.read(S.first_element(at("list")), "$", "bigint").alias("first"),
        V.read(S.element_at(at("list"), 1), "$", "bigint").alias("second"),
        V.text(F.coalesce(S.last_element(at("word")), at("word"))).alias("not_a_list"),
    )


def text_functions(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    messages = as_messages(
        part, F.col("p_partkey"),
        F.to_json(F.struct("p_partkey", "p_name", "p_brand", "p_type", F.array("p_type", "p_brand", "p_type").alias("l"))),
        F.lit(0).cast("timestamp"), F.col("p_partkey"),
    )
    doc = F.col("doc")

    def at(name):
        return V.get(doc, f"$.{name}")

    return docs(messages).select(
        F.col("offset").alias("p_partkey"),
        V.text(S.to_upper(at("p_name"))).alias("up"), V.text(S.to_lower(at("p_brand"))).alias("low"),
        S.concat(at("p_brand"), at("p_type")).alias("both"), S.substring(at("p_brand"), 1, 4).alias("sub"),
        S.substring(at("p_brand"), 3, 99).alias("sub_out"),
        S.left_pad(at("p_type"), 12, "*").alias("lp"), S.right_pad(at("p_type"), 3, "*").alias("rp"),
        S.size(at("l")).alias("n"), S.size(at("p_name")).alias("n_chars"),
        S.join("|", S.squash_duplicates(at("l"))).alias("uniq"), S.join("|", S.sort_list(at("l"))).alias("sorted"),
        S.is_null(at("nothing")).alias("gone"), S.not_null(at("p_name")).alias("there"),
        S.join("|", S.to_list(at("p_name"))).alias("listed"),
    )


def iso_to_epoch(spark, sf_dir):
    """Instants with zones of several forms; text without a zone stays as it is."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    messages = event_messages(
        spark, sf_dir, z=F.concat(stamp, F.lit("Z")), plus=F.concat(stamp, F.lit("+01:00")),
        bare=stamp, blank=F.concat(F.translate(stamp, "T", " "), F.lit("Z")),
    )
    doc = F.col("doc")

    def converted(name):
        now = V.get(doc, f"$.{name}")
        return V.text(F.coalesce(V.variant(S.iso_to_epoch(now)), now)).alias(name)

    return docs(messages).select(F.col("offset").alias("event_id"), *[converted(n) for n in ("z", "plus", "bare", "blank")])


def time_rules(spark, sf_dir):
    """The four ways to read a row's own time, as epoch milliseconds."""
    # timestamps without a zone here, so the text is the wall clock
    wall = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    messages = event_messages(
        spark, sf_dir, local=wall, iso=F.concat(F.translate(wall, " ", "T"), F.lit("Z")), ms=millis,
        ms_text=millis.cast("string"), sec=F.floor(millis / 1000), bad=F.concat(F.lit("x"), wall),
    )
    row = F.col("doc")
    return docs(messages).select(
        F.col("offset").alias("event_id"),
        epoch_millis(row, "$.local", "RFC2822").alias("local"), epoch_millis(row, "$.iso", "ISO8601").alias("iso"),
        epoch_millis(row, "$.ms", "EpochMilli").alias("ms"), epoch_millis(row, "$.ms_text", "EpochMilli").alias("ms_text"),
        epoch_millis(row, "$.sec", "EpochSeconds").alias("sec"), epoch_millis(row, "$.bad", "RFC2822").alias("bad"),
    )


def counter_keys(spark, sf_dir):
    counter = CounterSpec(
        (KeyPart(path="$.node"), KeyPart(path="$.maybe"), KeyPart(path="$.kind"), KeyPart(constant="octets")),
        "u64", "$.v")
    messages = event_messages(spark, sf_dir, maybe=F.when(_k() < 10, _k()))
    return docs(messages).select(
        F.col("offset").alias("event_id"), counter_key(F.col("doc"), counter).alias("counter_key"))


QUERIES = {
    f.__name__: f for f in (
        parse_ok, parse_errors, big_ints_kept, long_integers_kept, match_value, match_number, match_exists, match_and_or_not,
        match_wildcard, gate_whitelist, nested_gate, multi_route, route_unmatched, route_counts, topic_dispatch,
        transform_failure, typed_source, decode_json_strings, arith_functions, text_functions, iso_to_epoch,
        time_rules, counter_keys,
    )
}

_EV = "(SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"
_ROUTED = f"""
    SELECT 'clicks' AS tag, event_id, event_type AS kind FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'small', event_id, event_type FROM {_EV} WHERE k < 30"""
_UNMATCHED = f"SELECT event_id FROM {_EV} WHERE event_type NOT IN ('click', 'view') AND k >= 30"

SQL = {
    "parse_ok": """
        SELECT 'events' AS "key", event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
        WHERE json_valid(props) AND ltrim(props, ' ') LIKE '{%'
        UNION ALL
        SELECT 'documents', doc_id, CAST(json_extract(text, '$.k') AS BIGINT) FROM documents
        WHERE json_valid(text) AND ltrim(text, ' ') LIKE '{%'""",
    "parse_errors": """
        SELECT 'documents' AS "key", doc_id AS id, 'parse' AS step, 'catalog' AS app,
               CASE WHEN json_valid(text) THEN 'not a JSON object' ELSE 'not valid JSON' END AS message,
               md5(CAST(to_json(text) AS VARCHAR)) AS failed_md5
        FROM documents WHERE NOT (json_valid(text) AND ltrim(text, ' ') LIKE '{%')""",
    "big_ints_kept": """
        SELECT event_id, n, n AS s, '-' || n AS neg, n AS shown
        FROM (SELECT event_id, CAST(CAST(18446744073700000000 AS HUGEINT) + event_id AS VARCHAR) AS n FROM events)""",
    "long_integers_kept": """
        SELECT event_id, '{"id":' || event_id || ',"l":[' || n || ',"' || n || '"],"neg":-' || n || '}' AS "value"
        FROM (SELECT event_id, repeat('7', 48) || lpad(event_id::VARCHAR, 12, '0') AS n FROM events)""",
    "match_value": "SELECT event_id FROM events WHERE json_extract_string(json_object('kind', event_type), '$.kind') = 'click'",
    "match_number": f"SELECT event_id FROM {_EV} WHERE k = 42 OR k = 21",
    "match_exists": f"SELECT event_id FROM {_EV} WHERE k < 50 OR k % 3 = 0",
    "match_and_or_not": f"SELECT event_id FROM {_EV} WHERE event_type = 'view' OR NOT k < 50",
    "match_wildcard": f"SELECT event_id FROM {_EV} WHERE k % 2 = 0",
    "gate_whitelist": """
        SELECT 'discard' AS topic, event_id, '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS "value"
        FROM events WHERE event_type IN ('click', 'view')""",
    "nested_gate": f"SELECT 'discard' AS topic, event_id FROM {_EV} WHERE k % 4 = 0",
    "multi_route": _ROUTED,
    "route_unmatched": _UNMATCHED,
    "route_counts": f"""
        SELECT tag, 'emitted' AS outcome, count(*) AS n FROM ({_ROUTED}) GROUP BY tag
        UNION ALL SELECT NULL, 'discarded', count(*) FROM ({_UNMATCHED})""",
    "topic_dispatch": f"""
        SELECT CASE tag WHEN 'clicks' THEN 't-clicks' ELSE 't-small' END AS topic, event_id FROM ({_ROUTED})
        UNION ALL SELECT 'discard', event_id FROM ({_UNMATCHED})""",
    "transform_failure": """
        SELECT 't-easy' AS topic, 'easy' AS tag, event_id, NULL AS message, NULL AS failed_id FROM events
        UNION ALL
        SELECT CASE WHEN event_type = 'error' THEN 'dlq' ELSE 't-strict' END, 'strict', event_id,
               CASE WHEN event_type = 'error' THEN 'kind is error' END,
               CASE WHEN event_type = 'error' THEN event_id END FROM events""",
    "typed_source": """
        SELECT CASE WHEN s_nationkey = 7 THEN 'discard' ELSE 't-suppliers' END AS topic, s_name AS "key",
               CASE WHEN s_nationkey = 7
                    THEN '{"s_acctbal":' || s_acctbal || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey ||
                         ',"s_suppkey":' || s_suppkey || '}'
                    ELSE '{"nation":' || s_nationkey || ',"renamed":"' || s_name || '"}' END AS "value"
        FROM supplier""",
    "decode_json_strings": f"""
        SELECT event_id, CAST(k AS BIGINT) AS k, event_type AS plain, CAST(k AS BIGINT) AS k0, event_type AS s1,
               CAST(2 AS BIGINT) AS two FROM {_EV}""",
    "arith_functions": f"""
        SELECT event_id, CAST(k * k AS BIGINT) AS square,
               CASE WHEN k <= 1 THEN CAST(k AS BIGINT) * 4611686018427387904 END AS overflow,
               CAST(NULL AS BIGINT) AS no_number,
               event_id * 1000 AS ms, CAST(NULL AS DOUBLE) AS by_zero, CAST(k AS BIGINT) AS as_long,
               event_type AS stays, CAST(k AS VARCHAR) AS as_text,
               k || '.' || (k + 1) || '.' || (k + 2) AS joined, CAST(3 * k + 3 AS BIGINT) AS total,
               k - event_id AS less, CAST(k + 2 AS BIGINT) AS top, CAST(k AS BIGINT) AS low,
               CAST(k + 1 AS DOUBLE) AS mean, CAST(k AS BIGINT) AS positive, CAST(k + 2 AS BIGINT) AS last,
               CAST(k AS BIGINT) AS first, CAST(k + 1 AS BIGINT) AS second, event_type AS not_a_list
        FROM {_EV}""",
    "text_functions": """
        SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, p_brand || p_type AS both,
               p_brand[2:4] AS sub, CAST(NULL AS VARCHAR) AS sub_out,
               CASE WHEN length(p_type) < 12 THEN lpad(p_type, 12, '*') ELSE p_type END AS lp,
               CASE WHEN length(p_type) < 3 THEN rpad(p_type, 3, '*') ELSE p_type END AS rp,
               3 AS n, CAST(length(p_name) AS INTEGER) AS n_chars, p_type || '|' || p_brand AS uniq,
               array_to_string(list_sort([p_type, p_brand, p_type]), '|') AS sorted,
               TRUE AS gone, TRUE AS there, p_name AS listed
        FROM part""",
    "iso_to_epoch": """
        SELECT event_id, printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000) AS z,
               printf('%d.%06d', epoch_us(ts) // 1000000 - 3600, epoch_us(ts) % 1000000) AS plus,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS bare, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || 'Z' AS blank
        FROM events""",
    "time_rules": """
        SELECT event_id, ms - 3600000 AS local, ms AS iso, ms, ms AS ms_text, ms // 1000 * 1000 AS sec,
               CAST(NULL AS BIGINT) AS bad
        FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)""",
    "counter_keys": f"""
        SELECT event_id, ',' || user_id || ',' || CASE WHEN k < 10 THEN CAST(k AS VARCHAR) ELSE 'null' END || ',' ||
               event_type || ',octets' AS counter_key FROM {_EV}""",
}
