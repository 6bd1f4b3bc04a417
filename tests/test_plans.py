"""What the plans must look like: one parse, one shuffle, narrow scans, no Python on the batch path."""

import re

import pytest

from pulsegrain import App, CounterSpec, KeyPart, Pipeline, run
from pulsegrain.plans import catalog_counters as catalog
from pulsegrain.plans import interfaces, pipeline
from pulsegrain.plans.pipeline import flatten
from pulsegrain.sources.readers import stored_batch
from pulsegrain.sources.staging import staged

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, messages, tmp_path):
    path = str(tmp_path / "in")
    messages(['{"node": 1, "t": 1, "a": 1}']).selectExpr("*", "'in' as topic").write.parquet(path)
    return stored_batch(spark, path)


def wide_app(depth):
    """Four pipelines; counters of ``depth`` different entities."""
    extra = [CounterSpec((KeyPart(path="$.node"), KeyPart(path=f"$.k{n}")), "u64", "$.a") for n in range(depth - 1)]
    return App([
        Pipeline(f"p{n}", "t", {"jsonpath": "$.node"}, None, catalog._set("a", "b", kind="u64", extra=extra)) for n in range(4)
    ])


def parses(df):
    # Long integers in the text are marked before it is parsed.
    return len(re.findall(r"from_json\(VariantType, [^#]*, (?:value#|CASE WHEN RLIKE\(value#)", plan(df)))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_time_order_has_one_plan_without_python(stored, depth):
    """Staged rows are read twice, narrow and whole: a range exchange, two windows and a join, however many entities there are."""
    text = plan(run(stored, wide_app(depth), order="time"))
    assert "from_json" not in text and len(re.findall(r"FileScan", text)) == 2
    assert len(re.findall(r"rangepartitioning\(layer", text)) == 1
    assert len(re.findall(r"hashpartitioning\(_range", text)) == len(re.findall(r"hashpartitioning\(layer", text)) == 1
    assert not re.search(r"Python|InPandas|ArrowEval|CartesianProduct", text)
    assert "ReadSchema: struct<origin:string,partition:int,offset:bigint,pos:int,tag:string,ts_ms:bigint,entity0:string" in text


@pytest.mark.parametrize("depth", [1, 3])
def test_arrival_order_has_no_python(stored, depth):
    text = plan(run(stored, wide_app(depth)))
    assert "from_json" not in text and not re.search(r"Python|InPandas|ArrowEval|CartesianProduct", text)


@pytest.mark.parametrize("order", ["time", "arrival"])
def test_the_source_is_parsed_once(stored, order, monkeypatch):
    """What is staged holds the only parse, and nothing is shuffled for it."""
    written = []
    monkeypatch.setattr(pipeline, "staged", lambda df, name: written.append(df) or staged(df, name))
    output = run(stored, App([interfaces.pipeline()], pre_transform=interfaces.door), order=order)
    assert [parses(df) for df in written] == [1] and "Exchange" not in plan(written[0])
    assert "from_json" not in plan(output)


def test_no_counters_no_shuffle(stored):
    app = App([interfaces.pipeline()], pre_transform=interfaces.door)
    assert "Exchange" not in plan(flatten(stored, app))
    assert "Exchange" not in plan(run(stored, App([Pipeline("p", "t", {"jsonpath": "$.node"})])))


def test_layout_rows_are_built_after_the_fan_out(stored):
    """Elements go through the generate, rows are built by a projection: every path of a layout is read once."""
    text = plan(flatten(stored, App([interfaces.pipeline()], pre_transform=interfaces.door)))
    assert text.count("to_variant_object(map_filter(map_from_arrays(") == 4 and len(re.findall("Generate", text)) == 1
    assert text.index("to_variant_object(map_filter(map_from_arrays(") < text.index("Generate")
    assert text.count("try_variant_get") < 200
    assert plan(run(stored, App([interfaces.pipeline()], pre_transform=interfaces.door))).count("try_variant_get") < 120


@pytest.mark.parametrize("name", ["dataflow_end_to_end", "interface_layouts"])
def test_output_values_are_parsed_once(spark, name):
    """All fields of an emitted value come from one pass over its text."""
    text = plan(catalog.QUERIES[name](spark, SF))
    assert text.count("json_tuple(") == 1 and "GetJsonObject" not in text and "get_json_object" not in text
