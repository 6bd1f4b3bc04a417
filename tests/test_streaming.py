"""Streams: differences across micro-batches and restarts, equality with the batch form, late readings."""

import json
import random

import pytest

from pulsegrain import App, CounterSet, CounterSpec, KeyPart, NormalizeConfig, Pipeline, TimeRule, run
from pulsegrain.functions import variants as V
from pulsegrain.operators import counters as C
from pulsegrain.operators import metrics
from pulsegrain.operators.arrival import last_readings
from pulsegrain.plans.pipeline import flatten
from pulsegrain.sources.readers import stored_batch, stored_stream
from pulsegrain.sources.writers import stream_files
from pulsegrain.streaming.counters import step
from pulsegrain.streaming import state
from pulsegrain.streaming.runner import run_stream

CONFIG = NormalizeConfig(cache_age_ms=10_000, u64_limit=1_000_000)


def counters():
    def key(name):
        return KeyPart(path="$.node"), KeyPart(constant=name)
    return CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec(key("a"), "u64", "$.c.a"), CounterSpec(key("b"), "u32", "$.b"),
    ))


def app():
    return App([Pipeline("p", "out", {"jsonpath": "$.node"}, lambda doc: V.F.array(doc), counters())], normalize=CONFIG)


def write(spark, path, docs, first=0):
    rows = [("k", json.dumps(doc), first + n) for n, doc in enumerate(docs)]
    spark.createDataFrame(rows, "key string, value string, offset bigint").selectExpr(
        "key", "value", "timestamp_millis(1700000000000 + offset) as timestamp", "'in' as topic",
        "0 as partition", "offset",
    ).coalesce(1).write.mode("append").parquet(str(path))


def drain(spark, source, target, checkpoint, spec=None, initial=None):
    query = stream_files(run_stream(stored_stream(spark, str(source)), spec or app(), initial), str(target), str(checkpoint)) \
        .trigger(availableNow=True).start()
    finished = query.awaitTermination(120)
    if not finished:
        query.stop()
    assert finished
    assert query.exception() is None
    return query


def docs_of(spark, path):
    return sorted(
        (json.loads(row.value) for row in spark.read.parquet(str(path)).collect()), key=lambda doc: doc.get("id", -1)
    )


def test_restart_goes_on_and_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    docs, clock, totals = [], 0, {}
    for number in range(60):
        node = rng.choice("xyz")
        clock += rng.randrange(0, 4000)
        totals[node] = totals.get(node, 2**64 - 5000) + rng.randrange(900)
        doc = {"id": number, "node": node, "t": clock, "c": {"a": str(totals[node] % 2**64)}}
        if rng.random() < 0.7:
            doc["b"] = (totals[node] * 7) % 2**32
        docs.append(doc)
    docs.append({"id": 60, "other": 1})
    docs.append({"id": 61, "node": "x", "t": clock, "c": {"a": 1.5}})
    source, target, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    write(spark, source, docs[:30])
    drain(spark, source, target, checkpoint)
    write(spark, source, docs[30:], 30)
    query = drain(spark, source, target, checkpoint)
    got = spark.read.parquet(str(target)).select("topic", "value").collect()
    want = run(stored_batch(spark, str(source)), app()).select("topic", "value").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {row.topic for row in got} == {"out", "discard", "dlq"}
    numbers = metrics.state_numbers(query)
    assert [state["rows"] for state in numbers] == [3] and numbers[0]["operator"].startswith("transformWithState")
    assert "addBatch" in metrics.step_durations(query)


def test_late_and_very_late_readings(spark, tmp_path):
    minute = 60_000
    # (time, value, difference) under CONFIG: a late reading has none and leaves the state alone; one from far ahead is stale itself,
    # and a reading more than the cutoff behind it makes the state be forgotten.
    rows = [
        (5_000, 70, None), (4_000, 60, None), (6_500, 71, 1), (6_500 + 45 * minute, 90, None),
        (7_000, 72, None), (7_500, 75, None), (8_000, 79, 4),
    ]
    write(spark, tmp_path / "in", [
        {"id": n, "node": "x", "t": t, "c": {"a": value}} for n, (t, value, _) in enumerate(rows)
    ])
    drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    want = [want for _, _, want in rows]
    assert [doc["c"]["a"] for doc in docs_of(spark, tmp_path / "out")] == want
    batch = run(stored_batch(spark, str(tmp_path / "in")), app()).orderBy("offset").collect()
    assert [json.loads(row.value)["c"]["a"] for row in batch] == want  # the default order of a batch is that of the stream


@pytest.mark.parametrize("kind,rows", [
    ("u64", [(0, 9, None), (100, 8, None), (200, 20, 12)]),
    ("u32", [(0, 2**32 - 3, None), (1, 7, 9), (2, 17, 10)]),
    ("u64", [(0, 2**63 - 2, None), (9, 10, 11), (10, 2**64 - 1, -11), (11, 3, 3)]),
    ("u32", [(0, 4, None), (-1, 9, None), (10_001, 5, None), (10_002, 6, 1), (10_002 + 1_900_000, 7, None), (10_003, 8, None), (10_004, 9, None), (10_005, 11, 2)]),
])
def test_step_on_known_sequences(kind, rows):
    state = None
    for ts, value, want in rows:
        state, got = step(state, value, 1_500_000_000_000 + ts, kind, CONFIG)
        assert got == want


def test_two_entities_in_one_stream(spark, tmp_path):
    """Counters with different keys need one stateful step after another."""
    both = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant="a")), "u64", "$.a"),
        CounterSpec((KeyPart(path="$.node"), KeyPart(path="$.port"), KeyPart(constant="b")), "u64", "$.b"),
    ))
    spec = App([Pipeline("p", "out", {}, None, both)], normalize=CONFIG)
    docs = [{"id": n, "node": "x", "port": n % 2, "t": n, "a": n * 3, "b": n * 5} for n in range(6)]
    write(spark, tmp_path / "in", docs)
    output = run_stream(stored_stream(spark, str(tmp_path / "in")), spec)
    assert output._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1
    query = stream_files(output, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
    if not query.awaitTermination(120):
        query.stop()
    got = [(doc["a"], doc["b"]) for doc in docs_of(spark, tmp_path / "out")]
    assert got == [(None, None), (3, None), (3, 10), (3, 10), (3, 10), (3, 10)]


def test_rows_without_a_key_and_several_micro_batches(spark, tmp_path):
    """A missing key part gives one entity named null; every file is a micro-batch of its own."""
    docs = [{"id": n, "node": None if n % 3 else "x", "t": n, "c": {"a": n * n}} for n in range(12)]
    spec = App([Pipeline("p", "out", {}, None, counters())], normalize=CONFIG)
    for part in range(4):
        write(spark, tmp_path / "in", docs[part * 3:part * 3 + 3], part * 3)
    query = stream_files(run_stream(stored_stream(spark, str(tmp_path / "in"), max_files=1), spec), str(tmp_path / "out"),
                         str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(120) and query.exception() is None
    states, want = {}, []
    for doc in docs:
        states[doc["node"]], delta = step(states.get(doc["node"]), doc["c"]["a"], doc["t"], "u64", CONFIG)
        want.append(delta)
    assert [doc["c"]["a"] for doc in docs_of(spark, tmp_path / "out")] == want


def named(names, config=CONFIG, *extra):
    """An app with the counters ``$.<name>`` in the order given."""
    declared = tuple(CounterSpec((KeyPart(path="$.node"), KeyPart(constant=name)), "u64", f"$.{name}") for name in names)
    return App([Pipeline("p", "out", {"jsonpath": "$.node"}, None, CounterSet(TimeRule("$.t", "EpochMilli"), declared + extra))], normalize=config)


def held_by(spark, checkpoint):
    return {(r.layer, r.entity, json.loads(r.name)[-1]): (int(r.value), r.time) for r in state.readings(spark, str(checkpoint)).collect()}


def test_counters_may_change_over_a_restart(spark, tmp_path):
    """Readings are found by name: reordered, removed, added and returning counters go on from their own."""
    parts = ["ab", "ba", "a", "ac", "cb"]
    states, number = {}, 0
    for names in parts:
        docs = [{"id": number + k, "node": "xy"[k % 2], "t": number + k, **{n: (number + k) ** 2 * (ord(n) - 90) for n in "abc"}} for k in range(4)]
        write(spark, tmp_path / "in", docs, number)
        drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp", named(names))
        got = {doc["id"]: doc for doc in docs_of(spark, tmp_path / "out")}
        for doc in docs:
            for name in names:
                key = (0, f",{doc['node']},", name)
                states[key], want = step(states.get(key), doc[name], doc["t"], "u64", CONFIG)
                assert got[doc["id"]][name] == want, (names, doc)
        number += 4
        assert held_by(spark, tmp_path / "cp") == states


def test_old_readings_leave_by_the_time_of_the_stream(spark, tmp_path):
    """A key whose readings the record time has left behind is forgotten, a younger one stays; a late row is not dropped."""
    # write() gives record times of 1700000000000 and on; own times follow them. One partition, so one time for all keys.
    base, config = 1_700_000_000_000, NormalizeConfig(cache_age_ms=1_000, cutoff_ms=100_000, clean_every_ms=0)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        write(spark, tmp_path / "in", [{"id": 0, "node": "old", "t": base, "a": 1}, {"id": 1, "node": "young", "t": base + 4_500, "a": 1}])
        drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp", named("a", config))
        assert set(held_by(spark, tmp_path / "cp")) == {(0, ",old,", "a"), (0, ",young,", "a")}
        write(spark, tmp_path / "in", [{"id": 2, "other": 1}, {"id": 3, "node": "new", "t": base + 5_200, "a": 7}], 5_200)
        drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp", named("a", config))
        assert set(held_by(spark, tmp_path / "cp")) == {(0, ",young,", "a"), (0, ",new,", "a")}
        write(spark, tmp_path / "in", [{"id": 4, "node": "young", "t": base + 4_600, "a": 5}, {"id": 5, "node": "old", "t": base + 10, "a": 3}], 4_600)
        drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp", named("a", config))
        got = {doc["id"]: doc.get("a") for doc in docs_of(spark, tmp_path / "out") if "node" in doc}
        assert got == {0: None, 1: None, 3: None, 4: 4, 5: None}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_stream_may_start_from_a_batch(spark, tmp_path):
    """A batch up to an offset and a stream from there on equal one stream; with two entities, and readings read back."""
    rng = random.Random(3)
    port = CounterSpec((KeyPart(path="$.node"), KeyPart(path="$.port"), KeyPart(constant="b")), "u64", "$.b")
    spec = named("a", NormalizeConfig(cache_age_ms=500, cutoff_ms=40), port)
    docs = [{"id": n, "node": rng.choice("xy"), "port": n % 2, "t": n * 10 + rng.choice([0, 0, -25, -90, 200]), "a": n * n, "b": n * 7} for n in range(60)]
    docs += [{"id": 60 + k, "node": "xy"[k // 2], "port": k % 2, "t": 900 + k, "a": 4_000 + k, "b": 500 + k} for k in range(4)]
    write(spark, tmp_path / "all", docs)
    drain(spark, tmp_path / "all", tmp_path / "one", tmp_path / "cp1", spec)
    write(spark, tmp_path / "first", docs[:35])
    write(spark, tmp_path / "rest", docs[35:], 35)
    batch = stored_batch(spark, str(tmp_path / "first"))
    initial = last_readings(C.read_counters(flatten(batch, spec), spec), spec, run_length=10)
    drain(spark, tmp_path / "rest", tmp_path / "two", tmp_path / "cp2", spec, initial)
    assert docs_of(spark, tmp_path / "two") == docs_of(spark, tmp_path / "one")[35:]
    assert held_by(spark, tmp_path / "cp1") == held_by(spark, tmp_path / "cp2")
    assert {layer for layer, _, _ in held_by(spark, tmp_path / "cp1")} == {0, 1}
    # What the old checkpoint knows may start a stream whose counters have another entity.
    write(spark, tmp_path / "more", [{"id": 64, "node": "x", "port": 0, "t": 950, "a": 10_000, "b": 10_000}], 64)
    drain(spark, tmp_path / "more", tmp_path / "three", tmp_path / "cp3", spec, state.readings(spark, str(tmp_path / "cp2")))
    old = held_by(spark, tmp_path / "cp2")
    want = {name: step(old.get(key), 10_000, 950, "u64", spec.normalize)[1] for name, key in (("a", (0, ",x,", "a")), ("b", (1, ",x,0,", "b")))}
    assert {name: doc[name] for doc in docs_of(spark, tmp_path / "three") for name in "ab"} == want == {"a": 5_999, "b": 9_500}


def test_python_gets_few_columns_and_gives_them_back(spark, tmp_path):
    from pulsegrain.streaming.counters import normalize_stream
    rows = C.read_counters(flatten(stored_stream(spark, str(tmp_path)), app()), app())
    done = normalize_stream(rows, app())
    assert done.dtypes == [*rows.dtypes, ("d0", "array<bigint>")]
    analyzed = done._jdf.queryExecution().analyzed().toString()
    step_line = next(line for line in analyzed.splitlines() if "TransformWithStateInPySpark " in line)
    assert "timestamp" not in step_line and "origin" not in step_line and "_packed" in step_line


def test_brief_keeps_what_python_reads(spark):
    from pulsegrain.streaming.counters import _brief, _brief_column
    rows = spark.sql(f"""
        SELECT * FROM VALUES ('a|b', 1, 7L, 2, CAST(NULL AS BIGINT), 5L, array('{'9' * 60}', NULL, '-3')), ('', 0, 0L, 0, -4L, NULL, NULL)
        AS t(origin, partition, offset, pos, ts, seen, texts)""")
    found = [_brief(row[0]) for row in rows.select(_brief_column(V.F.col("ts"), V.F.col("seen"), V.F.col("texts"))).collect()]
    assert found == [(("a|b", 1, 7, 2), None, 5, ["9" * 60, "", "-3"]), (("", 0, 0, 0), -4, None, [""])]
