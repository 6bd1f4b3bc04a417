"""Match declarations: each predicate true and false, and what cannot be built."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrain.functions.variants import BadPath, steps
from pulsegrain.operators.predicates import predicate
from pulsegrain.specs import BadSpec

DOC = {
    "kind": "log", "n": 5, "big": 18446744073709551615, "half": 1.5, "yes": True, "none": None, "text5": "5",
    "obj": {"ns:name": {"a/b": "x"}, "dash-ed": 0}, "empty": [], "list": [{"p": 1}, {"q": None}, {}],
    "o": {}, "nums": [1, 2], "map": {"k1": {"p": 1}, "k2": {"r": 2}},
}

CASES = [
    ({}, True),
    ({"jsonpath": "$.kind", "value": "log"}, True), ({"jsonpath": "$.kind", "value": "Log"}, False),
    ({"jsonpath": "$.gone", "value": "log"}, False), ({"jsonpath": "$.obj['ns:name']['a/b']", "value": "x"}, True),
    ({"jsonpath": "$.n", "value": 5}, True), ({"jsonpath": "$.n", "value": "5"}, False),
    ({"jsonpath": "$.text5", "value": 5}, False), ({"jsonpath": "$.text5", "value": "5"}, True),
    ({"jsonpath": "$.big", "value": 18446744073709551615}, True), ({"jsonpath": "$.big", "value": 18446744073709551614}, False),
    ({"jsonpath": "$.half", "value": 1.5}, True), ({"jsonpath": "$.half", "value": 2}, False),
    ({"jsonpath": "$.yes", "value": True}, True), ({"jsonpath": "$.yes", "value": False}, False),
    ({"jsonpath": "$.n", "value": True}, False), ({"jsonpath": "$.none", "value": None}, False),
    ({"jsonpath": "$.nums", "value": [1, 2]}, True), ({"jsonpath": "$.nums", "value": [2, 1]}, False),
    ({"jsonpath": "$.nums[*]", "value": [1, 2]}, True), ({"jsonpath": "$.nums[*]", "value": 1}, False),
    ({"jsonpath": "$.obj.dash-ed"}, True), ({"jsonpath": "$.none"}, False), ({"jsonpath": "$.gone.deeper"}, False),
    ({"jsonpath": "$.empty"}, False), ({"jsonpath": "$.o"}, True), ({"jsonpath": "$.nums"}, True),
    ({"jsonpath": "$.nums[1]"}, True), ({"jsonpath": "$.nums[2]"}, False),
    ({"jsonpath": "$.list[*].p"}, True), ({"jsonpath": "$.list[*].q"}, True), ({"jsonpath": "$.list[*].z"}, False),
    ({"jsonpath": "$.map[*].r"}, True), ({"jsonpath": "$.empty[*]"}, False), ({"jsonpath": "$.kind[*]"}, False),
    ({"and": []}, True), ({"and": [{}, {"constant": False}]}, False), ({"and": [{}, {"jsonpath": "$.n"}]}, True),
    ({"or": []}, False), ({"or": [{"constant": False}, {"jsonpath": "$.kind"}]}, True),
    ({"not": {"jsonpath": "$.gone", "value": "x"}}, True), ({"not": {"not": {}}}, True),
    ({"constant": True}, True), ({"constant": False}, False),
    # the first known option decides
    ({"jsonpath": "$.kind", "or": []}, True), ({"and": [], "or": []}, True),
]


def test_all_cases(spark):
    doc = F.parse_json(F.lit(json.dumps(DOC)))
    row = spark.range(1).select(doc.alias("d")).select(
        *[predicate(match, F.col("d")).alias(str(n)) for n, (match, _) in enumerate(CASES)]).first()
    assert [(CASES[n][0], got) for n, got in enumerate(row)] == [(match, want) for match, want in CASES]


def test_never_null_without_document(spark):
    row = spark.range(1).select(F.lit(None).cast("variant").alias("d")).select(
        *[predicate(match, F.col("d")).alias(str(n)) for n, (match, _) in enumerate(CASES)]).first()
    assert all(value is not None for value in row)


@pytest.mark.parametrize("bad", ["a.b", "$..a", "$.a[?(@.x)]", "$.a[1:2]", "$.", "$.a[-1]"])
def test_paths_outside_the_language(bad):
    with pytest.raises(BadPath):
        steps(bad)


def test_unknown_match_option():
    with pytest.raises(BadSpec):
        predicate({"regex": "x"}, None)
