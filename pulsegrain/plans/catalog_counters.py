"""Registered queries over counters, the stream form, and the whole dataflow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.operators import routing as R
from pulsegrain.plans import interfaces
from pulsegrain.plans.catalog_documents import as_messages, dealt, event_messages, table
from pulsegrain.plans.pipeline import run
from pulsegrain.specs import App, CounterSet, CounterSpec, KeyPart, NormalizeConfig, Pipeline, TimeRule

HOUR, DAY = 3_600_000, 86_400_000


def _big(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


def _rising(factor: int, modulus: int, offset: int = 0) -> Column:
    """A counter that rises with the event number and starts again at the end of its range."""
    return F.pmod(F.col("event_id").cast("decimal(19,0)") * _big(factor).cast("decimal(18,0)") + _big(offset), _big(modulus))


def _set(*names: str, kind: str, time: TimeRule = TimeRule("$.t", "EpochMilli"), extra=()) -> CounterSet:
    return CounterSet(time, tuple(
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant=name)), kind, f"$.{name}") for name in names
    ) + tuple(extra))


def _config(**limits) -> NormalizeConfig:
    base = dict(cache_age_ms=7 * DAY, wrap_time_ms=3 * DAY, cutoff_ms=DAY)
    return NormalizeConfig(**{**base, **limits})


def _timed(messages: DataFrame, app: App) -> DataFrame:
    return run(messages, app, order="time")


def _app(counters: CounterSet, config: NormalizeConfig, match=None) -> App:
    return App([Pipeline("c", "counted", match or {"jsonpath": "$.node"}, None, counters)], normalize=config)


def _values(output: DataFrame, *names: str) -> DataFrame:
    return output.where(F.col("topic") == "counted").select(
        F.col("offset").alias("event_id"),
        *[F.get_json_object("value", f"$.{name}").cast("bigint").alias(name) for name in names],
    )


def counter_delta_u32(spark, sf_dir):
    """Two 32-bit counters per message, one of them missing now and then."""
    messages = event_messages(
        spark, sf_dir, a=_rising(39_916, 2**32),
        b=F.when(F.col("event_type") != "view", _rising(71, 2**32).cast("string")),
    )
    return _values(_timed(messages, _app(_set("a", "b", kind="u32"), _config(u32_limit=2**31 - 1))), "a", "b")


def counter_dense(spark, sf_dir):
    """All rows of one kind share one key and all of another one time: even ranges whatever the keys."""
    kind = F.col("event_type")
    messages = event_messages(
        spark, sf_dir, who=F.when(kind != "click", F.col("user_id")), a=_rising(39_916, 2**32),
        own=F.when(kind == "view", F.lit(0)).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))),
        b=F.when(F.col("event_id") % 3 == 0, _rising(71, 2**32)))
    counters = CounterSet(TimeRule("$.own", "EpochMilli"), tuple(
        CounterSpec((KeyPart(path="$.who"), KeyPart(constant=name)), "u32", f"$.{name}") for name in ("a", "b")))
    return _values(_timed(messages, _app(counters, _config(u32_limit=2**31 - 1))), "a", "b")


def counter_wrap_u32(spark, sf_dir):
    messages = event_messages(spark, sf_dir, a=_rising(2_039_916, 2**32))
    return _values(_timed(messages, _app(_set("a", kind="u32"), _config(u32_limit=2_000_000_000))), "a")


def counter_wrap_u64(spark, sf_dir):
    """Runs through the signed and through the unsigned range."""
    messages = event_messages(
        spark, sf_dir, a=_rising(7_349_874_591_868_649, 2**64).cast("string"),
        b=_rising(3_674_937_295_934_324, 2**63).cast("string"),
    )
    return _values(_timed(messages, _app(_set("a", "b", kind="u64"), _config(u64_limit=2**62))), "a", "b")


def counter_reset(spark, sf_dir):
    """A counter that starts again far from the end of its range."""
    messages = event_messages(spark, sf_dir, a=_rising(40_503, 3_000_000))
    return _values(_timed(messages, _app(_set("a", kind="u64"), _config(u64_limit=10_000_000))), "a")


def counter_stale(spark, sf_dir):
    """Readings older than the cache age do not count; whatever their number."""
    messages = event_messages(spark, sf_dir, a=F.col("event_id"))
    config = _config(cache_age_ms=6 * HOUR, wrap_time_ms=HOUR)
    return _values(_timed(messages, _app(_set("a", kind="u64"), config)), "a")


def counter_time_local(spark, sf_dir):
    """Local time text, ages across the change to the cache age, and values under a nested path."""
    messages = event_messages(
        spark, sf_dir, local=F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        s=F.struct(F.struct(_rising(11, 2**40).alias("octets"), F.lit(1).alias("other")).alias("deep")),
    )
    counters = CounterSet(TimeRule("$.local", "RFC2822"), (
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant="o")), "u64", "$.s.deep.octets"),))
    out = _timed(messages, _app(counters, _config(cache_age_ms=12 * HOUR, wrap_time_ms=HOUR)))
    return out.where(F.col("topic") == "counted").select(
        F.col("offset").alias("event_id"),
        F.get_json_object("value", "$.s.deep.octets").cast("bigint").alias("octets"),
        F.get_json_object("value", "$.s.deep.other").cast("bigint").alias("other"),
    )


def counter_shared_key(spark, sf_dir):
    """Two counters of a row with the same key: the second compares with the first."""
    key = (KeyPart(path="$.node"), KeyPart(constant="same"))
    messages = event_messages(spark, sf_dir, a=F.col("event_id") * 3, b=F.when(F.col("event_type") != "view", F.col("event_id") * 3 + 1))
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec(key, "u64", "$.a"), CounterSpec(key, "u64", "$.b", {"jsonpath": "$.b"})))
    return _values(_timed(messages, _app(counters, _config())), "a", "b")


def counter_two_entities(spark, sf_dir):
    """Counters whose keys differ in more than their constants: one after another."""
    messages = event_messages(spark, sf_dir, a=F.col("event_id") * 5, b=F.col("event_id") * 7)
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant="a")), "u64", "$.a"),
        CounterSpec((KeyPart(path="$.node"), KeyPart(path="$.kind"), KeyPart(constant="b")), "u64", "$.b")))
    return _values(_timed(messages, _app(counters, _config(cache_age_ms=3 * DAY))), "a", "b")


def counter_multi_pipeline(spark, sf_dir):
    """Two branches with counters on the same messages keep their readings apart."""
    messages = event_messages(spark, sf_dir, a=_rising(1_999, 2**40))
    app = App([
        Pipeline("clicks", "t-clicks", {"jsonpath": "$.kind", "value": "click"}, None, _set("a", kind="u64")),
        Pipeline("every", "t-every", {}, None, _set("a", kind="u64")),
        Pipeline("plain", "t-plain", {"jsonpath": "$.kind", "value": "view"}),
    ], normalize=_config(cache_age_ms=5 * DAY))
    return _timed(messages, app).select(
        "topic", F.col("offset").alias("event_id"), F.get_json_object("value", "$.a").cast("bigint").alias("a"))


def counter_narrowing(spark, sf_dir):
    """Differences beyond 63 bits wrap to negative numbers."""
    messages = event_messages(spark, sf_dir, a=(F.lit("15000000000000000000").cast("decimal(20,0)") * F.when(
        F.col("event_type").isin("click", "view"), 1).otherwise(0) + F.col("event_id")).cast("string"))
    return _values(_timed(messages, _app(_set("a", kind="u64"), _config(u64_limit=0))), "a")


def counter_long_integers(spark, sf_dir):
    """Counters of 38 digits as numbers and of 60 digits as texts."""
    step = F.pmod(F.col("event_id"), F.lit(997)) * 7
    messages = event_messages(
        spark, sf_dir, a=(F.lit("1" + "0" * 37).cast("decimal(38,0)") + step.cast("decimal(5,0)")).cast("decimal(38,0)"),
        b=F.concat(F.lit("1"), F.lpad(step.cast("string"), 59, "0")))
    return _values(_timed(messages, _app(_set("a", "b", kind="u64"), _config(u64_limit=0))), "a", "b")


def counter_any_length(spark, sf_dir):
    """Counters that are JSON numbers of 60 digits, more than VARIANT holds."""
    step = F.pmod(F.col("event_id"), F.lit(997)) * 7
    messages = event_messages(spark, sf_dir, a=F.concat(F.lit("1"), F.lpad(step.cast("string"), 59, "0")))
    bare = messages.withColumn("value", F.regexp_replace("value", '"([0-9]{60})"', "$1"))
    return _values(_timed(bare, _app(_set("a", kind="u64"), _config(u64_limit=0))), "a")


def dlq_counters(spark, sf_dir):
    """A bad value or a bad time sends the whole row to the dead letters and leaves the readings alone."""
    kind = F.col("event_type")
    messages = event_messages(
        spark, sf_dir, a=F.when(kind == "error", F.concat("event_id", F.lit("x"))).when(
            kind == "view", F.concat("event_id", F.lit(".5"))).otherwise(F.col("event_id").cast("string")),
        when=F.when(kind != "signup", F.unix_millis(F.col("ts").cast("timestamp"))),
    )
    out = _timed(messages, _app(_set("a", kind="u64", time=TimeRule("$.when", "EpochMilli")), _config()))
    return out.select(
        "topic", F.col("offset").alias("event_id"), F.get_json_object("value", "$.a").cast("bigint").alias("a"),
        F.get_json_object("value", "$.processingStep").alias("step"),
        F.get_json_object("value", "$.errorMessage").alias("message"),
        F.get_json_object(F.get_json_object("value", "$.failedValue"), "$.id").cast("bigint").alias("failed_id"),
    )


def _late() -> Column:
    """Own time of an event: now and then far behind or far ahead of its arrival."""
    k = F.get_json_object("props", "$.k").cast("int")
    shift = F.when(k % 10 == 0, -k * (6 * HOUR // 10)).when(k == 99, 5 * DAY).otherwise(0)
    return F.unix_millis(F.col("ts").cast("timestamp")) + shift


def counter_late_fold(spark, sf_dir):
    """Order of arrival: late readings have no difference, very late ones make the state be forgotten."""
    messages = event_messages(
        spark, sf_dir, own=_late(), a=_rising(39_916, 2**32),
        b=F.when(F.col("event_type") != "view", _rising(71, 2**32)))
    app = _app(_set("a", "b", kind="u32", time=TimeRule("$.own", "EpochMilli")), _config(u32_limit=2**31 - 1))
    return _values(run(messages, app), "a", "b")


def interface_layouts(spark, sf_dir):
    """Interface messages of three device layouts, made from orders, to rows with differences."""
    orders = dealt(table(spark, sf_dir, "orders"), "o_orderkey")
    number = F.col("o_orderkey")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.pmod(number, F.lit(60_000)) * 1000
    octets = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    name, status = F.concat(F.lit("Gi"), "o_custkey"), F.col("o_orderstatus")
    state = F.struct(F.struct(octets.alias("in-octets"), number.alias("out-errors")).alias("counters"))
    object_data = F.struct(
        F.lit(interfaces.ENCODING_PATH).alias("encoding_path"), millis.cast("string").alias("msg_timestamp"),
        F.array(F.struct(F.struct(F.struct(name.alias("name"), state.alias("state")).alias("interface")).alias("content"))).alias("data_json"),
    )
    slash_data = F.struct(
        octets.alias("/state/counters/in-octets"), F.lit('"UP"').alias("/state/oper-status"),
        F.to_json(F.struct(F.lit("sys").alias("systemId"), F.lit("/interfaces/").alias("subscribedPath"))).alias("extension"),
        (millis * 1_000_000 + 173_512).alias("notification_timestamp"),
        F.array(F.struct(F.struct(name.alias("name"), F.lit("0").alias("index")).alias("filters"))).alias("sensor_path"),
    )
    decoded_data = F.struct(
        F.lit(interfaces.SENSOR_PATHS[1]).alias("sensor_path"), millis.alias("msg_timestamp"),
        F.array(F.to_json(F.struct(F.array(F.struct(name.alias("name"), F.struct(
            F.struct(octets.alias("inOctets")).alias("counters")).alias("state"))).alias("interface")))).alias("decoded"),
    )
    document = F.to_json(F.struct(
        number.alias("seq"), F.lit("10.0.0.1").alias("telemetry_node"),
        F.struct(F.lit("node").alias("nkey"), F.lit("plat").alias("pkey")).alias("label"),
        F.when(F.col("o_orderpriority") == "5-LOW", "gpb").otherwise("json").alias("serialization"),
        F.when(status == "O", F.to_json(object_data)).when(status == "F", F.to_json(slash_data))
        .otherwise(F.to_json(decoded_data)).alias("telemetry_data"),
    ))
    messages = as_messages(orders, name, document, F.col("o_orderdate"), number)
    app = App([interfaces.pipeline(topic="ifs")], pre_transform=interfaces.door, normalize=_LAYOUTS)
    texts, numbers = ("name", "oper_status", "node_id_str"), ("msg_timestamp", "in_octets", "out_errors")
    out = _timed(messages, app).select("topic", F.col("offset").alias("o_orderkey"), F.json_tuple("value", *texts, *numbers).alias(*texts, *numbers))
    return out.select("topic", "o_orderkey", *texts, *[F.col(field).cast("bigint").alias(field) for field in numbers])


_LAYOUTS = _config(cache_age_ms=400 * DAY, wrap_time_ms=400 * DAY, u64_limit=2**62)


def _end_to_end_app() -> App:
    def rows(doc: Column) -> Column:
        return F.transform(V.elements(doc, "$.parts"), lambda part: V.row_of({
            "node": V.get(doc, "$.node"), "id": V.get(doc, "$.id"), "t": V.get(doc, "$.t"),
            "port": V.get(part, "$.port"), "octets": V.get(part, "$.octets"), "drops": V.get(part, "$.drops"),
        }))

    key = (KeyPart(path="$.node"), KeyPart(path="$.port"))
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec(key + (KeyPart(constant="octets"),), "u32", "$.octets"),
        CounterSpec(key + (KeyPart(constant="drops"),), "u64", "$.drops"),
    ))
    return App(
        [
            Pipeline("ports", "t-ports", {"jsonpath": "$.parts"}, rows, counters),
            Pipeline("alarms", "t-alarms", {"jsonpath": "$.kind", "value": "error"}, lambda doc: F.array(V.row_of({
                "id": V.get(doc, "$.id"), "alarm": S.to_upper(V.get(doc, "$.kind"))}))),
        ],
        pre_transform=lambda doc: R.gate(
            V.put(doc, {"parts": S.decode_json(V.get(doc, "$.parts"))}),
            F.coalesce(V.text(doc, "$.kind") != "signup", F.lit(False)),
        ),
        normalize=_config(u32_limit=2**31 - 1, cache_age_ms=3 * DAY),
    )


def dataflow_end_to_end(spark, sf_dir):
    """Parse, gate, decode, route, fan out, count, and emit, with discards and dead letters."""
    events = dealt(table(spark, sf_dir, "events"), "event_id")
    kind = F.col("event_type")
    parts = F.array(*[
        F.struct(
            F.lit(port).alias("port"), _rising(39_916 * port, 2**32).alias("octets"),
            F.when(kind == "view", _rising(13 * port, 2**63).cast("string")).alias("drops"),
        ) for port in (1, 2)
    ])
    document = F.when(kind == "purchase", F.concat(F.lit("{broken "), "event_id")).otherwise(F.to_json(F.struct(
        F.col("event_id").alias("id"), F.col("user_id").alias("node"), kind.alias("kind"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
        F.when(kind != "click", F.to_json(parts)).alias("parts"),
    )))
    out = _timed(as_messages(events, F.col("user_id"), document, F.col("ts"), F.col("event_id")), _end_to_end_app())
    # Each value is parsed once for all fields.
    names, numbers = ("port", "octets", "drops", "alarm", "errorMessage"), ("port", "octets", "drops")
    return out.select("topic", F.col("offset").alias("event_id"), F.json_tuple("value", *names).alias(*names)).select(
        "topic", "event_id", *[F.col(name).cast("bigint").alias(name) for name in numbers], "alarm", F.col("errorMessage").alias("message"))


QUERIES = {
    f.__name__: f for f in (
        counter_delta_u32, counter_dense, counter_wrap_u32, counter_wrap_u64, counter_reset, counter_stale, counter_time_local,
        counter_shared_key, counter_two_entities, counter_multi_pipeline, counter_narrowing, counter_long_integers, counter_any_length, dlq_counters,
        counter_late_fold, interface_layouts, dataflow_end_to_end,
    )
}


def _signed(value: str) -> str:
    low = f"((({value}) % 18446744073709551616 + 18446744073709551616) % 18446744073709551616)"
    return f"CAST(CASE WHEN {low} > 9223372036854775807 THEN {low} - 18446744073709551616 ELSE {low} END AS BIGINT)"


def _delta_sql(source: str, kind: str, config: NormalizeConfig, keep: str = "") -> str:
    """Differences over a relation with ``grp``, ``t``, ``event_id`` and ``v`` (HUGEINT); rows without ``v`` stay NULL.

    ``n`` orders several readings of one row.
    """
    if kind == "u32":
        over, bits, limit = "4294967295 - pv + v", 2**32, config.u32_limit
    else:
        over = "CASE WHEN pv > 9223372036854775807 THEN 18446744073709551615::HUGEINT ELSE 9223372036854775807::HUGEINT END - pv + v"
        bits, limit = 2**64, config.u64_limit
    wrapped = f"((({over}) % {bits}::HUGEINT + {bits}::HUGEINT) % {bits}::HUGEINT) < {limit}"
    return f"""
        SELECT event_id{keep}, CASE
            WHEN pv IS NULL OR t - pt > {config.cache_age_ms} THEN NULL
            WHEN v >= pv THEN {_signed('v - pv')}
            WHEN t - pt <= {config.wrap_time_ms} AND {wrapped} THEN {_signed(over)}
        END AS d
        FROM (SELECT *, lag(v) OVER w AS pv, lag(t) OVER w AS pt FROM ({source}) WHERE v IS NOT NULL
              WINDOW w AS (PARTITION BY grp ORDER BY t, event_id, n))"""


_BASE = "SELECT event_id, user_id AS grp, epoch_us(ts) // 1000 AS t, 0 AS n, {v} AS v FROM events"


def _rising_sql(factor: int, modulus: int, offset: int = 0) -> str:
    return f"((event_id::HUGEINT * {factor} + {offset}) % {modulus}::HUGEINT)"


_DENSE = """
    SELECT event_id, CASE WHEN event_type <> 'click' THEN user_id ELSE -1 END AS grp, 0 AS n,
           CASE WHEN event_type = 'view' THEN 0 ELSE epoch_us(ts) // 1000 END AS t, {v} AS v FROM events"""


def _columns_sql(config: NormalizeConfig, kind: str, base: str = _BASE, **values: str) -> str:
    """One column per counter, all events kept."""
    joins = "".join(
        f" LEFT JOIN ({_delta_sql(base.format(v=value), kind, config)}) {name}_d ON {name}_d.event_id = e.event_id"
        for name, value in values.items()
    )
    return f"SELECT e.event_id{''.join(f', {name}_d.d AS {name}' for name in values)} FROM events e{joins}"


_U32 = _columns_sql(
    _config(u32_limit=2**31 - 1), "u32", a=_rising_sql(39_916, 2**32),
    b=f"CASE WHEN event_type <> 'view' THEN {_rising_sql(71, 2**32)} END",
)


def _multi_sql() -> str:
    config = _config(cache_age_ms=5 * DAY)
    value = _rising_sql(1_999, 2**40)
    every = _delta_sql(_BASE.format(v=value), "u64", config)
    clicks = _delta_sql(_BASE.format(v=value) + " WHERE event_type = 'click'", "u64", config)
    return f"""
        SELECT 't-every' AS topic, event_id, d AS a FROM ({every})
        UNION ALL SELECT 't-clicks', event_id, d FROM ({clicks})
        UNION ALL SELECT 't-plain', event_id, {value}::BIGINT FROM events WHERE event_type = 'view'"""


def _shared_sql() -> str:
    both = f"""{_BASE.format(v='(event_id * 3)::HUGEINT')} UNION ALL
        SELECT event_id, user_id, epoch_us(ts) // 1000, 1, (event_id * 3 + 1)::HUGEINT FROM events WHERE event_type <> 'view'"""
    return f"""
        SELECT event_id, max(CASE WHEN n = 0 THEN d END) AS a, max(CASE WHEN n = 1 THEN d END) AS b
        FROM ({_delta_sql(both, 'u64', _config(), ', n')}) GROUP BY event_id"""


def _two_entities_sql() -> str:
    config = _config(cache_age_ms=3 * DAY)
    a = _delta_sql(_BASE.format(v="(event_id * 5)::HUGEINT"), "u64", config)
    b = _delta_sql(_BASE.format(v="(event_id * 7)::HUGEINT").replace(
        "user_id AS grp", "user_id || ',' || event_type AS grp"), "u64", config)
    return f"SELECT a.event_id, a.d AS a, b.d AS b FROM ({a}) a JOIN ({b}) b ON a.event_id = b.event_id"


def _local_sql() -> str:
    config = _config(cache_age_ms=12 * HOUR, wrap_time_ms=HOUR)
    return f"""SELECT event_id, d AS octets, CAST(1 AS BIGINT) AS other
        FROM ({_delta_sql(_BASE.format(v=_rising_sql(11, 2**40)), 'u64', config)})"""


def _dlq_sql() -> str:
    good = _delta_sql(_BASE.format(v="event_id::HUGEINT") + " WHERE event_type NOT IN ('error', 'view', 'signup')",
                      "u64", _config())
    return f"""
        SELECT 'counted' AS topic, event_id, d AS a, NULL AS step, NULL AS message, NULL AS failed_id FROM ({good})
        UNION ALL
        SELECT 'dlq', event_id, NULL, 'counters',
               CASE WHEN event_type = 'signup' THEN 'the row has no readable timestamp' ELSE 'a counter is not an integer' END,
               event_id
        FROM events WHERE event_type IN ('error', 'view', 'signup')"""


def _end_to_end_sql() -> str:
    config = _config(u32_limit=2**31 - 1, cache_age_ms=3 * DAY)
    gated = "event_type NOT IN ('purchase', 'signup', 'click')"
    ports = []
    for port in (1, 2):
        octets = _delta_sql(_BASE.format(v=_rising_sql(39_916 * port, 2**32)) + f" WHERE {gated}", "u32", config)
        drops = _delta_sql(_BASE.format(v=_rising_sql(13 * port, 2**63)) + " WHERE event_type = 'view'", "u64", config)
        ports.append(f"""
            SELECT 't-ports' AS topic, o.event_id, CAST({port} AS BIGINT) AS port, o.d AS octets, p.d AS drops,
                   NULL AS alarm, NULL AS message
            FROM ({octets}) o LEFT JOIN ({drops}) p ON o.event_id = p.event_id""")
    return " UNION ALL ".join(ports) + """
        UNION ALL SELECT 't-alarms', event_id, NULL, NULL, NULL, 'ERROR', NULL FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'discard', event_id, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_type = 'click'
        UNION ALL SELECT 'dlq', event_id, NULL, NULL, NULL, NULL, 'not valid JSON' FROM events
                  WHERE event_type = 'purchase'"""


def _late_sql() -> str:
    config = _config(u32_limit=2**31 - 1)

    def fold(name: str, value: str) -> str:
        wrapped = f"((4294967295 - f.sv + s.v) % 4294967296 + 4294967296) % 4294967296 < {config.u32_limit}"
        fresh = f"f.st IS NULL OR s.t - f.st > {config.cache_age_ms}"
        gone = f"f.st - s.t > {config.cutoff_ms}"
        return f"""
        {name}_src AS (
            SELECT event_id, user_id AS grp, {value} AS v, epoch_us(ts) // 1000 + CASE
                   WHEN k % 10 = 0 THEN -k * {6 * HOUR} // 10 WHEN k = 99 THEN {5 * DAY} ELSE 0 END AS t,
                   row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn
            FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) WHERE {value} IS NOT NULL),
        {name}_fold AS (
            SELECT grp, rn, event_id, v AS sv, t AS st, CAST(NULL AS BIGINT) AS d FROM {name}_src WHERE rn = 1
            UNION ALL
            SELECT s.grp, s.rn, s.event_id,
                   CASE WHEN {fresh} OR s.t >= f.st THEN s.v WHEN {gone} THEN NULL ELSE f.sv END,
                   CASE WHEN {fresh} OR s.t >= f.st THEN s.t WHEN {gone} THEN NULL ELSE f.st END,
                   CASE WHEN {fresh} OR s.t < f.st THEN NULL WHEN s.v >= f.sv THEN CAST(s.v - f.sv AS BIGINT)
                        WHEN s.t - f.st <= {config.wrap_time_ms} AND {wrapped}
                        THEN CAST(4294967295 - f.sv + s.v AS BIGINT) END
            FROM {name}_fold f JOIN {name}_src s ON s.grp = f.grp AND s.rn = f.rn + 1)"""

    b = f"CASE WHEN event_type <> 'view' THEN {_rising_sql(71, 2**32)} END"
    return f"""
        WITH RECURSIVE {fold('a', _rising_sql(39_916, 2**32))}, {fold('b', b)}
        SELECT e.event_id, a_fold.d AS a, b_fold.d AS b FROM events e
        LEFT JOIN a_fold ON a_fold.event_id = e.event_id LEFT JOIN b_fold ON b_fold.event_id = e.event_id"""


def _layouts_sql() -> str:
    base = """
        SELECT o_orderkey AS event_id, o_custkey || CASE WHEN o_orderstatus = 'F' THEN '.0' ELSE '' END AS grp, 0 AS n,
               epoch_us(o_orderdate) // 1000 + o_orderkey % 60000 * 1000 AS t, {v} AS v
        FROM orders WHERE o_orderpriority <> '5-LOW'"""
    octets = _delta_sql(base.format(v="CAST(round(o_totalprice * 100) AS HUGEINT)"), "u64", _LAYOUTS)
    errors = _delta_sql(base.format(v="o_orderkey::HUGEINT") + " AND o_orderstatus = 'O'", "u64", _LAYOUTS)
    return f"""
        SELECT 'ifs' AS topic, o_orderkey,
               'Gi' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN '.0' ELSE '' END AS name,
               CASE WHEN o_orderstatus = 'F' THEN 'UP' END AS oper_status,
               CASE WHEN o_orderstatus = 'F' THEN 'sys' END AS node_id_str,
               epoch_us(o_orderdate) // 1000 + o_orderkey % 60000 * 1000 AS msg_timestamp,
               octets.d AS in_octets, errors.d AS out_errors
        FROM orders LEFT JOIN ({octets}) octets ON octets.event_id = o_orderkey
        LEFT JOIN ({errors}) errors ON errors.event_id = o_orderkey
        WHERE o_orderpriority <> '5-LOW'"""


SQL = {
    "counter_delta_u32": _U32,
    "counter_dense": _columns_sql(
        _config(u32_limit=2**31 - 1), "u32", base=_DENSE, a=_rising_sql(39_916, 2**32),
        b=f"CASE WHEN event_id % 3 = 0 THEN {_rising_sql(71, 2**32)} END"),
    "counter_wrap_u32": _columns_sql(_config(u32_limit=2_000_000_000), "u32", a=_rising_sql(2_039_916, 2**32)),
    "counter_wrap_u64": _columns_sql(
        _config(u64_limit=2**62), "u64", a=_rising_sql(7_349_874_591_868_649, 2**64),
        b=_rising_sql(3_674_937_295_934_324, 2**63)),
    "counter_reset": _columns_sql(_config(u64_limit=10_000_000), "u64", a=_rising_sql(40_503, 3_000_000)),
    "counter_stale": _columns_sql(_config(cache_age_ms=6 * HOUR, wrap_time_ms=HOUR), "u64", a="event_id::HUGEINT"),
    "counter_time_local": _local_sql(),
    "counter_shared_key": _shared_sql(),
    "counter_two_entities": _two_entities_sql(),
    "counter_multi_pipeline": _multi_sql(),
    "counter_narrowing": _columns_sql(
        _config(u64_limit=0), "u64",
        a="(CASE WHEN event_type IN ('click', 'view') THEN 15000000000000000000::HUGEINT ELSE 0 END + event_id)"),
    "counter_long_integers": _columns_sql(
        _config(u64_limit=0), "u64", a="(event_id % 997 * 7)::HUGEINT", b="(event_id % 997 * 7)::HUGEINT"),
    "counter_any_length": _columns_sql(_config(u64_limit=0), "u64", a="(event_id % 997 * 7)::HUGEINT"),
    "dlq_counters": _dlq_sql(),
    "counter_late_fold": _late_sql(),
    "interface_layouts": _layouts_sql(),
    "dataflow_end_to_end": _end_to_end_sql(),
}
