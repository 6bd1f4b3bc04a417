"""Transforms that raise: one message fails, the job goes on."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrain import App, Pipeline, run
from pulsegrain.functions import variants as V
from pulsegrain.functions.guard import BadExpression
from pulsegrain.operators import reshape as R
from pulsegrain.operators.routing import RAISED


def _number(doc, path="$.n"):
    return V.text(doc, path).cast("int")


def test_one_message_fails_and_the_others_go_on(messages, emitted):
    app = App([
        Pipeline("cast", "t1", {}, lambda doc: F.array(V.row_of({"n": _number(doc) + _number(doc), "m": _number(doc) * _number(doc)}))),
        Pipeline("parse", "t2", {}, lambda doc: F.array(F.parse_json(V.text(doc, "$.j")))),
        Pipeline("list", "t3", {}, lambda doc: R.fan_out(doc, "$.l", lambda item: V.row_of({"q": F.lit(6) / _number(item, "$")}))),
        Pipeline("plain", "t4", {}),
    ])
    good, bad = {"n": 2, "j": "[1]", "l": [1, 2]}, {"n": "x", "j": "{", "l": [1, 0]}
    out = emitted(run(messages([good, bad, good]), app))
    whole = [("t1", "cast", {"n": 4, "m": 4}), ("t3", "list", {"q": 6.0}), ("t3", "list", {"q": 3.0}), ("t2", "parse", [1]), ("t4", "plain", good)]
    assert out[:5] == whole and out[-5:] == whole
    failed = out[5:-5]
    assert [(topic, tag) for topic, tag, _ in failed] == [("dlq", "cast"), ("dlq", "list"), ("dlq", "parse"), ("t4", "plain")]
    for _, _, letter in failed[:3]:
        assert letter["processingStep"] == "transform" and letter["errorMessage"] == RAISED and json.loads(letter["failedValue"]) == bad


def test_steps_before_the_fan_out(messages, emitted):
    app = App(
        [Pipeline("p", "t", {}, check=lambda doc: F.when(_number(doc, "$.c") > 5, F.lit("above five")))],
        pre_check=lambda doc: F.when(_number(doc, "$.a") == 0, F.lit("zero")),
        pre_transform=lambda doc: F.when(_number(doc, "$.b").isNotNull(), doc),
    )
    documents = [{"a": 1, "b": 1, "c": 1}, {"a": "x", "b": 1}, {"a": 1, "b": "x"}, {"a": 1}, {"a": 1, "b": 1, "c": "x"}, {"a": 0, "b": "x"}, {"a": 1, "b": 1, "c": 9}]
    out = emitted(run(messages(documents), app))
    assert out[0] == ("t", "p", documents[0])
    assert [(topic, letter["processingStep"], letter["errorMessage"], letter["offset"]) for topic, _, letter in out[1:]] == [
        ("dlq", "pre-transform", RAISED, 1), ("dlq", "pre-transform", RAISED, 2), ("dlq", "transform", RAISED, 4),
        ("dlq", "pre-transform", "zero", 5), ("dlq", "transform", "above five", 6)]
    assert [json.loads(letter["failedValue"]) for _, _, letter in out[1:]] == [documents[at] for at in (1, 2, 4, 5, 6)]


def test_layouts_fail_row_by_row(messages, emitted):
    transform = R.Layouts(
        shared=lambda doc: {"n": _number(doc)},
        pick=lambda doc: F.transform(V.elements(doc, "$.l"), lambda item: R.element(0, item)),
        builds=[lambda shared, parent, item: V.row_of({"n": shared["n"], "v": _number(item, "$.v")})],
    )
    out = emitted(run(messages([{"n": 1, "l": [{"v": 1}, {"v": "x"}, {}]}, {"n": "x", "l": [{"v": 1}]}, {"n": 2}]), App([Pipeline("p", "t", {}, transform)])))
    assert out[0] == ("t", "p", {"n": 1, "v": 1}) and out[2] == ("t", "p", {"n": 1})
    assert [json.loads(letter["failedValue"]) for topic, _, letter in out if topic == "dlq"] == [{"v": "x"}, {"n": "x", "l": [{"v": 1}]}]
    assert len(out) == 4


def test_a_row_that_raises_leaves_nothing_to_the_next(messages, emitted):
    app = App([
        Pipeline("row", "t1", {}, lambda doc: F.array(V.row_of({"a": V.get(doc, "$.a"), "n": _number(doc)}))),
        Pipeline("put", "t2", {}, lambda doc: F.array(V.put(doc, {"a": F.lit(0), "n": _number(doc)}))),
        Pipeline("name", "t3", {}, lambda doc: F.array(V.rename(V.put(doc, {"n": _number(doc)}), {"a": "b"}))),
    ])
    frame = messages([{"a": at, "n": "x" if at % 2 else at} for at in range(12)]).coalesce(1)
    out = emitted(run(frame, app))
    assert [tag for topic, tag, _ in out if topic == "dlq"] == ["name", "put", "row"] * 6
    assert [row for topic, _, row in out if topic == "t1"] == [{"a": at, "n": at} for at in range(0, 12, 2)]
    assert [row for topic, _, row in out if topic == "t2"] == [{"a": 0, "n": at} for at in range(0, 12, 2)]
    assert [row for topic, _, row in out if topic == "t3"] == [{"b": at, "n": at} for at in range(0, 12, 2)]


def test_map_builders_are_refused(messages):
    app = App([Pipeline("p", "t", {}, lambda doc: F.array(F.to_variant_object(F.create_map(F.lit("n"), _number(doc)))))])
    with pytest.raises(BadExpression):
        run(messages([{"n": 1}]), app)
