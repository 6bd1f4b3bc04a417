"""Parsing, routing, dead letters, sinks and sources."""

import json

import pytest
from pyspark.sql import functions as F

from pulsegrain import App, Pipeline, run, to_sink
from pulsegrain.functions import variants as V
from pulsegrain.operators import metrics
from pulsegrain.plans import notifications
from pulsegrain.plans.pipeline import flatten
from pulsegrain.sources import readers, writers


def test_texts_that_are_no_documents(messages, emitted):
    texts = ["aa", "{NotValidJson}", None, "", "[1]", "5", '"x"', "null", '/* c */ [1]', '{"a": "\\u00e9\\n"', "  "]
    out = emitted(run(messages(texts), App([])))
    assert [topic for topic, _, _ in out] == ["dlq"] * len(texts)
    letters = [letter for _, _, letter in out]
    assert [letter["failedValue"] and json.loads(letter["failedValue"]) for letter in letters] == texts
    assert {letter["processingStep"] for letter in letters} == {"parse"}
    assert letters[0]["key"] == "k" and letters[3]["offset"] == 3


def test_texts_that_are_documents(messages, emitted):
    texts = ['{"a":1}', ' \n\t{"a":1} trailing', '/* why */ {"a":1}', '{"a":0,"a":1}', '{"a": /* b */ 1}']
    out = emitted(run(messages(texts), App([])))
    assert out == [("discard", None, {"a": 1})] * len(texts)


def test_a_value_before_other_text_is_no_json(messages, emitted):
    texts = ["45 Anth", "45", '"x" y', '"x"', "[1] x", "[1] // x", "[1]] x", "true, false", "'x'"]
    letters = [letter["errorMessage"] for _, _, letter in emitted(run(messages(texts), App([])))]
    json_, other = "not a JSON object", "not valid JSON"
    assert letters == [other, json_, other, json_, other, json_, other, other, other]


def test_numbers_and_nulls_survive(messages):
    text = '{"big":18446744073709551615,"none":null,"x":{"y":null},"z":-9223372036854775809}'
    assert run(messages([text]), App([])).first().value == text


def test_round_doubles_of_typed_sources_keep_their_point(spark, tmp_path):
    rows = [("x:1.0,[2.0]", 1430.0, 0.5, [-2.0, 1e8, 0.0], 7)]
    spark.createDataFrame(rows, "a string, b double, c double, d array<double>, e int").write.parquet(str(tmp_path / "typed"))
    out = run(readers.typed_batch(spark, str(tmp_path / "typed")), App([])).first().value
    assert out == '{"a":"x:1.0,[2.0]","b":1430.0,"c":0.5,"d":[-2.0,1.0E8,0.0],"e":7}'


def test_every_matching_branch_and_isolated_failures(messages, emitted):
    app = App([
        Pipeline("a", "ta", {"jsonpath": "$.x"}),
        Pipeline("b", "tb", {"jsonpath": "$.x", "value": 1}, lambda doc: F.array(doc, V.json_null(), V.drop(doc, "x"))),
        Pipeline("c", "tc", {"jsonpath": "$.y"}, lambda doc: F.lit(None).cast("array<variant>")),
        Pipeline("d", "td", {"jsonpath": "$.bad"}, check=lambda doc: F.lit("refused")),
    ])
    out = emitted(run(messages([{"x": 1}, {"x": 2, "bad": 1}, {"y": 1}, {"q": 1}]), app))
    assert [(topic, tag) for topic, tag, _ in out] == [
        ("ta", "a"), ("tb", "b"), ("tb", "b"), ("ta", "a"), ("dlq", "d"), ("discard", None)]
    assert [row for _, _, row in out][:3] == [{"x": 1}, {"x": 1}, {}]
    assert out[4][2]["errorMessage"] == "refused" and out[4][2]["processingStep"] == "transform"


def test_counts_and_observation(spark, messages):
    app = App([Pipeline("a", "ta", {"jsonpath": "$.x"})])
    out = run(messages([{"x": 1}, {"x": 1}, {"y": 1}, "bad"]), app)
    counts = {(row.tag, row.outcome): row.n for row in metrics.counts(out, app).collect()}
    assert counts == {("a", "emitted"): 2, (None, "discarded"): 1, (None, "error"): 1}
    from pyspark.sql import Observation
    seen = Observation("flow")
    metrics.observe(out, app, seen).count()
    assert seen.get == {"rows": 4, "emitted": 2, "discarded": 1, "error": 1, "tag:a": 2}


def test_files_by_topic(spark, messages, tmp_path):
    app = App([Pipeline("a", "ta", {"jsonpath": "$.x"})])
    writers.write_files(run(messages([{"x": 1}, {"y": 1}, "bad"]), app), str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"topic=ta", "topic=discard", "topic=dlq"}
    assert to_sink(run(messages([{"x": 1}]), app)).columns == ["topic", "key", "value"]


def test_sources(spark, messages, tmp_path):
    frame = messages([{"x": 1}, {"x": 2}]).selectExpr("*", "'in' as topic")
    frame.write.parquet(str(tmp_path / "stored"))
    assert readers.stored_batch(spark, str(tmp_path / "stored")).count() == 2
    (tmp_path / "lines.json").write_text('{"x": 1}\n{"x": 2}\nbad\n')
    out = run(readers.json_lines(spark, str(tmp_path / "lines.json")), App([])).groupBy("topic").count().collect()
    assert {row.topic: row["count"] for row in out} == {"discard": 2, "dlq": 1}
    spark.createDataFrame([("up", None)], "event string, more string").write.orc(str(tmp_path / "typed"))
    tagged = run(readers.typed_batch(spark, str(tmp_path / "typed"), "orc", unions=["event", "more"]), App([])).first()
    assert json.loads(tagged.value) == {"event": {"string": "up"}, "more": None}
    typed = run(readers.typed_batch(spark, str(tmp_path / "typed"), "orc", key="event"), App([])).first()
    assert (typed.key, json.loads(typed.value)) == ("up", {"event": "up", "more": None})


def test_notifications(messages, emitted):
    def message(encoding):
        return {"ietf-telemetry-message:message": {"payload": 1, "telemetry-message-metadata": {
            "ietf-yang-push-telemetry-message:yang-push-subscription": {"encoding": encoding}}}, "other": 2}

    name = "ietf-subscribed-notifications:encode-json"
    app = App([notifications.pipeline()], pre_transform=notifications.door)
    out = emitted(run(messages([message(name), message({name: None}), message("encode-cbor"), {}]), app))
    assert [(topic, tag) for topic, tag, _ in out] == [("notifications", "ietf-notifications")] * 2
    assert set(out[0][2]) == {"ietf-telemetry-message:message"}


def test_kafka_options():
    options = readers.kafka_options("h:1", topic="t", pattern="dev-.*", max_offsets=10)
    assert options["subscribePattern"] == "dev-.*" and "subscribe" not in options
    assert readers.kafka_options("h:1", topic="t")["subscribe"] == "t"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(ValueError):
        readers.kafka_options("h:1")
    wire = writers.kafka_writer_options("h:1", acks="1", idempotent=False, compression="zstd")
    assert wire["kafka.acks"] == "1" and wire["kafka.enable.idempotence"] == "false"
    assert wire["kafka.compression.type"] == "zstd"


def test_flatten_keeps_order_of_rows(messages):
    app = App([Pipeline("a", "ta", {}, lambda doc: V.elements(doc, "$.l"))])
    rows = flatten(messages([{"l": [3, 1, 2]}]), app).orderBy("pos").select(F.to_json("row").alias("r")).collect()
    assert [row.r for row in rows] == ["3", "1", "2"]
