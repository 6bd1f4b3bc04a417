"""Counter rules in the order of time: known sequences, errors, keys, and agreement with a plain fold."""

import json
import random

import pytest

from pulsegrain import App, CounterSet, CounterSpec, KeyPart, NormalizeConfig, Pipeline, TimeRule, run
from pulsegrain.operators.fold import step
from pulsegrain.specs import BadSpec

BASE = 1_500_000_000_000
CONFIG = NormalizeConfig(cache_age_ms=10_000, u64_limit=1_000_000)


def app(*counters, config=CONFIG, time=TimeRule("$.t", "EpochMilli")):
    return App([Pipeline("p", "out", {"jsonpath": "$.node"}, None, CounterSet(time, counters))], normalize=config)


def counter(kind, value="$.v", constant="v", match=None):
    return CounterSpec((KeyPart(path="$.node"), KeyPart(path="$.name"), KeyPart(constant=constant)), kind, value, match or {})


U32, S63, U64 = 2**32, 2**63, 2**64

# (time, value, difference); limits are CONFIG's: age 10 s, wrap within 5 min, u32 below 10,000, u64 below 1,000,000.
SEQUENCES = [
    ("u64", [(0, "40", None), (700, "42", 2), (1400, 42, 0), (9000, 50, 8)]),
    ("u32", [(0, 12, None), (10_000, 15, 3), (20_001, 99, None), (20_500, 100, 1)]),  # the third came too late to count
    ("u32", [(0, U32 - 10, None), (50, 4, 13), (60, 3, None), (70, 8, 5)]),  # 2^32 - 1 - old + new, then a reset
    ("u32", [(0, U32 - 1, None), (1, 9_999, 9_999), (2, U32 - 1, U32 - 10_000), (3, 10_000, None)]),
    ("u64", [(0, S63 - 8, None), (10, 5, 12), (20, S63 + 90, -(2**63) + 85), (30, U64 - 5, S63 - 95)]),
    ("u64", [(0, str(U64 - 3), None), (1, 6, 8), (2, 1_000_000, 999_994), (3, 999_999, None)]),
    ("u64", [(0, -9, None), (5, -2, 7), (6, 0, 2), (7, -1, None), (8, 4, 5)]),
    ("u64", [(0, 1, None), (1, None, "absent"), (2, 8, 7), (3, None, "absent"), (4, 9, 1)]),
    ("u64", [(0, "1" + "0" * 37, None), (1, "1" + "0" * 36 + "7", 7), (2, "3" * 60, (int("3" * 60) - 10**37 - 7) % U64), (3, "3" * 59 + "5", 2)]),
    ("u64", [(0, "-" + "5" * 60, None), (1, "-" + "5" * 59 + "1", 4), (2, 0, int("5" * 59 + "1") % U64)]),
]


@pytest.mark.parametrize("order", ["time", "arrival"])
@pytest.mark.parametrize("kind,rows", SEQUENCES)
def test_known_sequences(messages, emitted, kind, rows, order):
    docs = []
    for t, value, _ in rows:
        doc = {"node": "n", "name": "i", "t": BASE + t}
        docs.append(doc if value is None else {**doc, "v": value})
    out = emitted(run(messages(docs), app(counter(kind)), order=order))
    signed = [want if not isinstance(want, int) or want < S63 else want - U64 for _, _, want in rows]
    assert [row.get("v", "absent") for _, _, row in out] == signed


def test_random_sequences_equal_fold(messages, emitted):
    rng = random.Random(3)
    docs, clock = [], BASE
    for _ in range(200):
        clock += rng.choice([0, 10, 900, 4000, 11_000])
        doc = {"node": rng.choice("ab"), "name": rng.choice("xy"), "t": clock}
        doc["v"] = rng.choice([rng.randrange(2**64), 2**64 - rng.randrange(500), rng.randrange(500), 2**63 - rng.randrange(90)])
        if rng.random() < 0.5:
            doc["w"] = rng.choice([rng.randrange(2**32), 2**32 - rng.randrange(500), rng.randrange(500)])
        docs.append(doc)
    config = NormalizeConfig(cache_age_ms=10_000, u64_limit=2**62, u32_limit=20_000)
    out = emitted(run(messages(docs), app(counter("u64"), counter("u32", "$.w", "w"), config=config), order="time"))
    states = {}
    for doc, (_, _, row) in zip(docs, out):
        for name, kind in (("v", "u64"), ("w", "u32")):
            if name in doc:
                key = doc["node"], doc["name"], name
                states[key], want = step(states.get(key), doc[name], doc["t"], kind, config)
                assert row[name] == want
            else:
                assert name not in row


def test_bad_rows_touch_no_state(messages, emitted):
    good = {"node": "n", "name": "i"}
    docs = [
        {**good, "t": BASE, "v": 1, "w": 1}, {**good, "t": BASE + 1, "v": 2, "w": "oops"},
        {**good, "t": "never", "w": 3}, {**good, "v": 3}, {**good, "t": "never"}, {**good, "t": BASE + 2, "v": 5, "w": None},
    ]
    spec = app(counter("u64"), counter("u32", "$.w", "w", {"jsonpath": "$.w"}))
    out = emitted(run(messages(docs), spec))
    assert [topic for topic, _, _ in out] == ["out", "dlq", "dlq", "dlq", "dlq", "out"]
    letter = out[1][2]
    assert set(letter) == {"timestamp", "applicationId", "taskId", "partition", "offset", "processingStep", "key",
                           "errorMessage", "failedValue"}
    assert letter["offset"] == 1 and letter["timestamp"] == 1700000000001 and letter["taskId"] is None
    assert json.loads(letter["failedValue"]) == docs[1]
    assert out[5][2] == {**docs[5], "v": 4}


def test_time_far_out_does_not_stop_the_job(messages, emitted):
    docs = [{"node": "n", "name": "i", "t": t, "v": 1} for t in (2**63 - 1, -(2**63), 0)]
    for order in ("time", "arrival"):
        out = emitted(run(messages(docs), app(counter("u64")), order=order))
        assert [row["v"] for _, _, row in out] == [None, None, None]


def test_declarations_are_checked():
    with pytest.raises(BadSpec):
        CounterSpec((KeyPart(constant="x"),), "u16", "$.v")
    with pytest.raises(BadSpec):
        TimeRule("$.t", "RFC822")
    with pytest.raises(BadSpec):
        CounterSpec((KeyPart(constant="x"),), "u32", "$.list[*]")
    with pytest.raises(BadSpec):
        App([Pipeline("a", "t"), Pipeline("a", "t")])
    config = {
        "timestamp-extractor": {"jsonpath": "$.t", "timestamp-type": "EpochMilli"},
        "counters": [{"match": {}, "key": [{"jsonpath": "$.node"}, {"constant": "v"}], "type": "u32",
                      "value": {"jsonpath": "$.v"}}],
    }
    assert CounterSet.from_dict(config).counters[0] == CounterSpec(
        (KeyPart(path="$.node"), KeyPart(constant="v")), "u32", "$.v")
