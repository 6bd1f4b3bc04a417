"""Integers of more than 38 digits: passing through, matching, counting."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrain import App, CounterSet, Pipeline, run
from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.operators import counters as C

L = "9" * 38 + "7"          # 39 digits
H = "1" + "0" * 400 + "3"   # beyond a double


def _values(messages, texts, app=None):
    rows = run(messages(texts), app or App([])).orderBy("offset", "pos").collect()
    return [(row.topic, row.value) for row in rows]


def test_documents_leave_as_they_came(messages):
    texts = [
        f'{{"a":{L}}}', f'{{"a":-{L},"b":[{H},{{"c":{L}}}],"d":1}}', f'{{"a":"{L}","b":"\\"{L}","c":{L}}}',
        f'{{"{L}":{L}}}', f'{{"a":"x, {L}, y","b":"\\\\","c":{L}}}', f'{{"a":{"8" * 38},"b":18446744073709551615}}',
    ]
    assert _values(messages, texts) == [("discard", text) for text in texts]


def test_comments_white_space_and_floats(messages):
    texts = [
        f'/* "{L} */ {{ "a" : {L} , // {L}" \n "b":[ {L}\n]}}', f'{{"a":0.{L},"b":{L}e2,"c":{L}.5,"d":1e5}}', f'{{"a":{L}/* {L} */}}',
    ]
    first, second, third = [json.loads(value) for _, value in _values(messages, texts)]
    assert first == {"a": int(L), "b": [int(L)]} and third == {"a": int(L)}
    assert second == {"a": float(f"0.{L}"), "b": float(f"{L}e2"), "c": float(f"{L}.5"), "d": 1e5}


def test_what_is_no_json_stays_none(messages):
    texts = [f"{{{L}: 1}}", f'{{"a":0{L}}}', f'{{"a":+{L}}}', f'{{"a":{L} {L}}}', f'{{"a":x{L}}}', f'{{"a":{L}', f'{{"a":"{L}']
    for (topic, value), text in zip(_values(messages, texts), texts, strict=True):
        assert topic == "dlq" and json.loads(json.loads(value)["failedValue"]) == text


def test_long_texts_of_many_tokens(messages):
    text = json.dumps({"l": [{"k": f"v\\{at}", "n": at, "f": at + 0.5} for at in range(40_000)], "n": int(L)}, separators=(",", ":"))
    assert json.loads(_values(messages, [text])[0][1]) == json.loads(text)


@pytest.mark.parametrize("literal, hits", [
    (int(L), [0]), (-int(L), [1]), (L, [2]), (int(H), [3]), (float(L), [0]), (int("9" * 38 + "8"), []), ([int(L)], [4]),
])
def test_matching(messages, literal, hits):
    frame = messages([f'{{"a":{L}}}', f'{{"a":-{L}}}', f'{{"a":"{L}"}}', f'{{"a":{H}}}', f'{{"a":[{L}]}}'])
    out = run(frame, App([Pipeline("p", "t", {"jsonpath": "$.a", "value": literal})])).where("topic = 't'")
    assert [row.offset for row in out.orderBy("offset").collect()] == hits


def test_functions_read_the_digits(messages):
    app = App([Pipeline("p", "t", {}, lambda doc: F.array(V.row_of({
        "moved": V.get(doc, "$.a"), "text": S.to_text(V.get(doc, "$.a")), "double": S.to_double(V.get(doc, "$.a")), "long": S.to_long(V.get(doc, "$.a")),
        "decoded": S.decode_json(V.get(doc, "$.j")), "again": S.decode_json(V.get(doc, "$.a")),
    })))])
    out = _values(messages, [f'{{"a":{L},"j":"{{\\"x\\":{L}}}"}}'], app)
    assert json.loads(out[0][1]) == {
        "moved": int(L), "text": L, "double": float(L), "decoded": {"x": int(L)}, "again": int(L)}


@pytest.mark.parametrize("order", ["arrival", "time"])
def test_counting(messages, order):
    counters = CounterSet.from_dict({
        "timestamp-extractor": {"jsonpath": "$.t", "timestamp-type": "EpochMilli"},
        "counters": [{"match": {}, "type": "u64", "value": {"jsonpath": "$.c"}, "key": [{"jsonpath": "$.k"}]}],
    })
    texts = [f'{{"t":{1000 + at},"k":{L},"c":{int(H) + 5 * at}}}' for at in range(3)]
    out = _values(messages, texts, App([Pipeline("p", "t", {}, counters=counters)]), ) if order == "arrival" else [
        (row.topic, row.value) for row in run(messages(texts), App([Pipeline("p", "t", {}, counters=counters)]), order="time").orderBy("offset").collect()]
    assert [json.loads(value) for _, value in out] == [
        {"t": 1000, "k": int(L), "c": None}, {"t": 1001, "k": int(L), "c": 5}, {"t": 1002, "k": int(L), "c": 5}]


def test_long_texts_are_subtracted_by_their_last_digits(spark):
    """Neither text is folded where only the last digits differ; all other pairs give the same as the fold."""
    pairs = [
        (int("1" + "0" * 41 + "7"), int("1" + "0" * 41 + "3")), (int("1" + "0" * 41 + "3"), int("1" + "0" * 41 + "7")), (10**60, 10**60 - 1),
        (10**60, 7), (-(10**60) + 5, -(10**60)), (int("12" + "9" * 18), int("12" + "0" * 18)), (int("9" * 19), int("8" * 19)), (10**18, 10**18 - 1)]
    frame = spark.createDataFrame([(n, str(a), str(b)) for n, (a, b) in enumerate(pairs)], "n int, a string, b string")
    found = C.low_difference(F.col("a"), F.col("b"))
    rows = frame.orderBy("n").select(F.pmod(found, C._big(2**64)).cast("string")).collect()
    assert [int(row[0]) for row in rows] == [(a - b) % 2**64 for a, b in pairs]
    text = found._jc.toString()
    assert text.index("substr") < text.index("regexp_extract_all")
