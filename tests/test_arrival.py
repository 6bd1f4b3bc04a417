"""Order of arrival over bounded data: equal to a plain fold, whatever the length of runs."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from pulsegrain import App, CounterSet, CounterSpec, KeyPart, NormalizeConfig, Pipeline, TimeRule
from pulsegrain.operators import arrival as A
from pulsegrain.operators import counters as C
from pulsegrain.operators.fold import step
from pulsegrain.plans.pipeline import emit, flatten

CONFIG = NormalizeConfig(cache_age_ms=400, cutoff_ms=60, wrap_time_ms=200, u32_limit=5000)


def played(times, held, cutoff):
    """Index of the reading held after ``times``, -1 for the one before them, None for none."""
    state = None if held is None else (-1, held)
    for index, time in enumerate(times):
        if state is None or time >= state[1]:
            state = (index, time)
        elif state[1] - time > cutoff:
            state = None
    return None if state is None else state[0]


@pytest.mark.parametrize("cutoff", [0, 2, 7, 30])
def test_effect_of_a_run_equals_playing_it(spark, cutoff):
    """Step functions of runs, of two runs one after the other, and the closed form of rising times."""
    rng = random.Random(cutoff)
    rows = []
    for number in range(150):
        times = [rng.randrange(40) for _ in range(rng.randrange(1, 9))]
        times = sorted(times) if number % 3 == 0 else times
        rows += [(number, times, rng.randrange(len(times) + 1), held) for held in [None, *range(-1, 75, 3)]]
    df = spark.createDataFrame(rows, "id int, times array<bigint>, cut int, held bigint")
    readings = F.transform("times", lambda t, i: F.struct(t.alias("ts"), i.cast("string").alias("v")))
    whole = A.run_effect(readings, cutoff)
    halves = A.then(A.run_effect(F.slice(readings, 1, F.col("cut")), cutoff), A.run_effect(F.slice(readings, F.col("cut") + 1, 99), cutoff))
    before = F.when(F.col("held").isNotNull(), F.struct(F.col("held").alias("ts"), F.lit("-1").alias("v"))).cast(A.HELD)
    effects = df.select("times", "held", before.alias("before"), whole.alias("whole"), halves.alias("halves"))
    got = effects.select("times", "held", *[A.after(F.col(e), F.col("before"))["v"].alias(name) for e, name in (("whole", "one"), ("halves", "two"))]).collect()
    for row in got:
        want = played(row.times, row.held, cutoff)
        want = None if want is None else str(want)
        assert row.one == row.two == want


def late_docs(seed, n=150):
    rng = random.Random(seed)
    docs = []
    for number in range(n):
        clock = number * 10 + rng.choice([0, 0, 0, -30, -90, 300 if rng.random() < 0.3 else 0])
        doc = {"node": rng.choice("aaab"), "t": clock, "x": (number * 977 + 2**32 - 40000) % 2**32}
        for name, often in (("y", 0.6), ("z", 0.4)):
            if rng.random() < often:
                doc[name] = rng.randrange(100)
        docs.append(doc)
    return docs


def late_app():
    """Counters x and y, and z under the key of y."""
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), tuple(
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant=key)), "u32", f"$.{name}") for key, name in ("xx", "yy", "yz")))
    return App([Pipeline("p", "out", {}, None, counters)], normalize=CONFIG)


@pytest.mark.parametrize("run_length, fan", [(3, 2), (17, 500), (1000, 500)])
def test_arrival_equals_fold(spark, messages, run_length, fan):
    docs, app = late_docs(run_length), late_app()
    rows = C.read_counters(flatten(messages(docs), app), app)
    output = emit(C.write_counters(A.normalize_arrival(rows, app, run_length, fan), app), app)
    got = [json.loads(row.value) for row in output.orderBy("offset").collect()]
    states, resets = {}, 0
    for doc, mine in zip(docs, got):
        for key, name in ("xx", "yy", "yz"):
            if name in doc:
                before = states.get((doc["node"], key))
                states[doc["node"], key], want = step(before, doc[name], doc["t"], "u32", CONFIG)
                resets += before is not None and states[doc["node"], key] is None
                assert mine[name] == want
            else:
                assert name not in mine
    assert resets > 5
    held = {(r.entity, r.name): (int(r.value), r.time) for r in A.last_readings(rows, app, run_length, fan).collect()}
    assert held == {(f",{node},", json.dumps([None, key])): state for (node, key), state in states.items() if state is not None}


def test_arrival_has_no_python(spark, messages):
    app = late_app()
    rows = C.read_counters(flatten(messages(late_docs(1, 5)), app), app)
    text = A.normalize_arrival(rows, app)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|InPandas|ArrowEval|CartesianProduct", text)


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_time_order_equals_fold(spark, messages, ranges):
    """A third of all rows under one key and one time, cut into several ranges; two entities, and a key written twice."""
    rng = random.Random(ranges)
    docs = []
    for number in range(120):
        doc = {"t": 5 if number % 3 == 0 else rng.randrange(2000), "x": rng.randrange(2**32), "port": number % 2}
        if number % 3:
            doc["node"] = rng.choice("ab")
        for name, often in (("y", 0.2), ("z", 0.5)):
            if rng.random() < often:
                doc[name] = rng.randrange(100)
        docs.append(doc)
    node, port = KeyPart(path="$.node"), KeyPart(path="$.port")
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec((node, KeyPart(constant="x")), "u32", "$.x"), CounterSpec((node, KeyPart(constant="y")), "u32", "$.y"),
        CounterSpec((node, KeyPart(constant="y")), "u32", "$.z"), CounterSpec((node, port, KeyPart(constant="p")), "u32", "$.z")))
    separate = CounterSet(counters.time, counters.counters[:3])
    for spec in (separate, counters):
        app = App([Pipeline("p", "out", {}, None, spec)], normalize=CONFIG)
        rows = C.read_counters(flatten(messages(docs), app), app)
        got = {r.offset: json.loads(r.value) for r in emit(C.write_counters(C.normalize_time(rows, app, ranges), app), app).collect()}
        states = {}
        for offset, doc in sorted(enumerate(docs), key=lambda pair: (pair[1]["t"], pair[0])):
            entity, want = doc.get("node"), {}
            for key, name in ((entity, "x"), "x"), ((entity, "y"), "y"), ((entity, "y"), "z"), ((entity, doc["port"], "p"), "z"):
                if name in doc and (len(key) == 2 or spec is counters):
                    states[key], want[name, len(key)] = step(states.get(key), doc[name], doc["t"], "u32", CONFIG)
            mine = got[offset]
            assert all(mine[name] == want[name, 3 if (name, 3) in want else 2] for name in "xyz" if name in doc)
            assert all(name not in mine for name in "yz" if name not in doc)


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_topics_may_share_offsets(spark, messages, order):
    """Two topics with the same partitions and offsets: every row once, with its own difference."""
    from pulsegrain import run
    counters = CounterSet(TimeRule("$.t", "EpochMilli"), (
        CounterSpec((KeyPart(path="$.node"), KeyPart(constant="x")), "u32", "$.x"),))
    app = App([Pipeline("p", "out", {}, None, counters)], normalize=CONFIG)
    tables = [
        messages([{"node": name, "t": n, "x": n * n * factor} for n in range(5)]).selectExpr("*", f"'{name}' as topic")
        for name, factor in (("a", 1), ("b", 10))
    ]
    rows = run(tables[0].unionByName(tables[1]), app, order=order).collect()
    got = sorted((doc["node"], doc["t"], doc["x"]) for doc in (json.loads(row.value) for row in rows))
    want = [(name, n, None if n == 0 else (2 * n - 1) * factor) for name, factor in (("a", 1), ("b", 10)) for n in range(5)]
    assert got == want
