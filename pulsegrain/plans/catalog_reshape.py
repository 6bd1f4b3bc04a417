"""Registered queries over reshaping: fan-out, merging, layouts, defaults, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.functions.variants import Place
from pulsegrain.operators import reshape as R
from pulsegrain.plans.catalog_documents import as_messages, dealt, table
from pulsegrain.plans.pipeline import flatten, run
from pulsegrain.specs import App, Pipeline


def _rows(messages: DataFrame, transform) -> DataFrame:
    """Offset, place and row of a transform applied to every message."""
    found = flatten(messages, App([Pipeline("rows", "rows", {}, transform)]))
    return found.where(F.col("tag").isNotNull()).select("offset", "pos", "row")


def _read(rows: DataFrame, **fields: str) -> DataFrame:
    row = F.col("row")
    return rows.select(*[V.read(row, f"$['{name}']", kind).alias(name) for name, kind in fields.items()])


def _table_messages(spark, sf_dir, name: str, key: str, document: Column) -> DataFrame:
    rows = dealt(table(spark, sf_dir, name), key)
    return as_messages(rows, F.col(key), F.to_json(document), F.lit(0).cast("timestamp"), F.col(key))


def order_fanout(spark, sf_dir):
    """Each line item as a message with a list of amounts; the header fields go to every amount."""
    lines = dealt(table(spark, sf_dir, "lineitem"), "l_orderkey")
    amounts = F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(f"l_{name}").alias("value"))
        for name in ("quantity", "extendedprice", "discount", "tax")
    ])
    document = F.to_json(F.struct(
        F.struct(F.col("l_orderkey").alias("order"), F.col("l_linenumber").alias("line")).alias("header"),
        amounts.alias("amounts"), F.col("l_returnflag").alias("flag"),
    ))
    messages = as_messages(lines, F.col("l_orderkey"), document, F.col("l_shipdate"), F.col("l_orderkey"))

    def transform(doc: Column) -> Column:
        header = {("header", "order"): "variant", ("header", "line"): "variant", ("flag",): "variant"}
        return V.together(doc, header, lambda at: R.fan_out(doc, "$.amounts", lambda item: V.row_of({
            "order": at("header", "order"), "line": at("header", "line"), "flag": at("flag"),
            "name": V.get(item, "$.name"), "value": V.get(item, "$.value"),
        })))

    found = _read(_rows(messages, transform), order="bigint", line="bigint", flag="string", name="string", value="double")
    return found.withColumn("line", F.col("line").try_cast("int"))


def nested_grid(spark, sf_dir):
    """Lists inside lists, cells numbered by both places, all in one list."""
    cell = F.struct(F.col("c_custkey").alias("a"), F.col("c_nationkey").alias("b"))
    other = F.struct(F.col("c_nationkey").alias("a"), F.lit(None).cast("int").alias("b"))
    document = F.struct(F.col("c_name").alias("name"), F.array(
        F.struct(F.array(cell, other).alias("cells")), F.struct(F.array().cast("array<struct<a:bigint,b:int>>").alias("cells")),
        F.struct(F.array(other, cell, cell).alias("cells")),
    ).alias("grid"))
    messages = _table_messages(spark, sf_dir, "customer", "c_custkey", document)

    def transform(doc: Column) -> Column:
        def line(part: Column, i: Column) -> Column:
            return R.fan_out(part, "$.cells", lambda item, j: V.row_of({
                "name": V.get(doc, "$.name"), "i": i, "j": j, "a": V.get(item, "$.a"), "b": V.get(item, "$.b"),
            }))
        return R.fan_out_nested(doc, "$.grid", line)

    return _read(_rows(messages, transform), name="string", i="int", j="int", a="bigint", b="int")


def parent_and_child_rows(spark, sf_dir):
    """A row for the element and one for its child where it has one."""
    child = F.when(F.col("o_orderstatus") != "O", F.struct(F.col("o_orderpriority").alias("index")))
    document = F.struct("o_orderkey", "o_orderstatus", child.alias("child"))
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", document)

    def transform(doc: Column) -> Column:
        name = V.text(doc, "$.o_orderkey")
        return R.rows(
            V.row_of({"name": name, "status": V.get(doc, "$.o_orderstatus")}),
            F.when(V.is_object(doc, "$.child"), V.row_of({
                "name": F.concat(name, F.lit("."), V.text(doc, "$.child.index"))})),
        )

    return _read(_rows(messages, transform), name="string", status="string")


def layout_union(spark, sf_dir):
    """Three layouts of one message kind to one row shape."""
    flat = F.col("o_orderstatus") == "O"
    deep = F.col("o_orderstatus") == "F"
    document = F.struct(
        F.col("o_orderkey").alias("id"),
        F.when(flat, F.col("o_totalprice")).alias("price/total"), F.when(flat, F.col("o_custkey")).alias("cust-key"),
        F.when(deep, F.struct(F.struct(F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust")).alias("state"))).alias("order"),
        F.when(~flat & ~deep, F.array(F.to_json(F.struct("o_totalprice", "o_custkey")))).alias("decoded"),
    )
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", document)

    def row(doc: Column, layout: str, cust: Column, price: Column) -> Column:
        return V.row_of({"id": V.get(doc, "$.id"), "layout": F.lit(layout), "cust": cust, "price": price})

    def transform(doc: Column) -> Column:
        place = Place(doc)
        state = place.at("order", "state")
        return R.first_layout(
            F.when(V.has_value(place.at("price/total").value), F.array(
                row(doc, "flat", place.at("cust-key").value, place.at("price/total").value))),
            F.when(state.is_object, F.array(row(doc, "deep", state.at("cust").value, state.at("price").value))),
            F.transform(V.elements(S.decode_json(place.at("decoded").value)), lambda item: row(
                doc, "text", V.get(item, "$.o_custkey"), V.get(item, "$.o_totalprice"))),
        )

    return _read(_rows(messages, transform), id="bigint", layout="string", cust="bigint", price="double")


def object_keys_explode(spark, sf_dir):
    document = F.struct("p_partkey", F.struct("p_brand", "p_type", "p_size").alias("keys"))
    messages = _table_messages(spark, sf_dir, "part", "p_partkey", document)
    return _read(
        _rows(messages, lambda doc: R.fan_out_keys(doc, "$.keys", lambda name, value: V.row_of({
            "part": V.get(doc, "$.p_partkey"), "name": name, "value": V.text(value)}))),
        part="bigint", name="string", value="string",
    )


def merge_key_list(spark, sf_dir):
    """A list of single-key objects becomes one object; a repeated key holds a list."""
    one = "to_json(named_struct('name', p_brand))"
    keys = F.expr(f"array({one}, to_json(named_struct('size', p_size)), to_json(named_struct('name', p_type)))")
    part = table(spark, sf_dir, "part")
    text = F.concat(F.lit('{"keys": ['), F.array_join(keys, ","), F.lit("]}"))
    messages = as_messages(part, F.col("p_partkey"), text, F.lit(0).cast("timestamp"), F.col("p_partkey"))
    rows = _rows(messages, lambda doc: F.array(V.merge_objects(V.elements(doc, "$.keys"))))
    row = F.col("row")
    return rows.select(
        F.col("offset").alias("p_partkey"), V.text(row, "$.name[0]").alias("name0"), V.text(row, "$.name[1]").alias("name1"),
        V.read(row, "$.size", "int").alias("size"), S.size(row).alias("n"),
    )


def enum_map(spark, sf_dir):
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", F.struct("o_orderkey", "o_orderstatus"))
    rows = _rows(messages, lambda doc: F.array(V.row_of({
        "id": V.get(doc, "$.o_orderkey"),
        "status": S.rename_values(V.get(doc, "$.o_orderstatus"), {"O": "OPEN", "F": "FINISHED"}),
    })))
    return _read(rows, id="bigint", status="string")


def multi_source_list(spark, sf_dir):
    """Several sources to one target: a list in order, a lone value as it is, nothing if none."""
    document = F.struct(
        "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("b"),
    )
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", document)
    rows = _rows(messages, lambda doc: F.array(V.row_of({
        "id": V.get(doc, "$.o_orderkey"), "target": S.gather(V.get(doc, "$.a"), V.get(doc, "$.b")),
        "copy": V.get(doc, "$.a"),
    })))
    row = F.col("row")
    return rows.select(
        V.read(row, "$.id", "bigint").alias("id"), V.is_list(row, "$.target").alias("is_list"),
        S.join("+", V.get(row, "$.target")).alias("target"), V.text(row, "$.copy").alias("copy"),
    )


def typed_rows(spark, sf_dir):
    """The same reshaping outside the dataflow: a document column to table rows."""
    document = F.parse_json(F.to_json(F.struct("c_custkey", F.split("c_name", "#").alias("parts"))))
    docs = table(spark, sf_dir, "customer").select(document.alias("doc"))
    rows = R.explode_rows(docs, R.fan_out(F.col("doc"), "$.parts", lambda part, place: F.when(place > 0, V.row_of({
        "digits": part, "number": S.to_long(part), "half": S.divide_and_round(
            1, part, F.parse_json(F.lit("2"))), "float": S.to_double(part), "flag": S.to_boolean(V.variant(F.lit("true"))),
    }))), V.read(F.col("doc"), "$.c_custkey", "bigint").alias("id"))
    row = F.col("row")
    return rows.select("id", V.text(row, "$.digits").alias("digits"), *[
        V.read(row, f"$.{name}", kind).alias(name)
        for name, kind in (("number", "bigint"), ("half", "double"), ("float", "double"), ("flag", "boolean"))
    ])


def cardinality_one(spark, sf_dir):
    """A list gives its first item, a scalar stays; and the last item of a list."""
    document = F.struct("c_custkey", F.array("c_name", "c_mktsegment").alias("list"), F.col("c_mktsegment").alias("scalar"))
    messages = _table_messages(spark, sf_dir, "customer", "c_custkey", document)
    rows = _rows(messages, lambda doc: F.array(V.row_of({
        "id": V.get(doc, "$.c_custkey"), "first": S.one(V.get(doc, "$.list")), "same": S.one(V.get(doc, "$.scalar")),
        "last": S.last_element(V.get(doc, "$.list")),
        "kept": F.coalesce(S.last_element(V.get(doc, "$.scalar")), V.get(doc, "$.scalar")),
    })))
    return _read(rows, id="bigint", first="string", same="string", last="string", kept="string")


def split_tokens(spark, sf_dir):
    """Parts of a text as rows, empty ones dropped, survivors numbered from zero."""
    part = table(spark, sf_dir, "part")
    document = F.struct("p_partkey", F.concat(F.lit(" "), "p_name", F.lit("   "), "p_brand").alias("words"))
    messages = as_messages(part, F.col("p_partkey"), F.to_json(document), F.lit(0).cast("timestamp"), F.col("p_partkey"))
    rows = _rows(messages, lambda doc: F.transform(R.tokens(V.get(doc, "$.words")), lambda word, place: V.row_of({
        "id": V.get(doc, "$.p_partkey"), "place": place, "word": word})))
    return _read(rows, id="bigint", place="int", word="string")


def null_holes(spark, sf_dir):
    """Null items of a list vanish and the others are numbered anew."""
    status = F.col("o_orderstatus")
    items = F.array(F.when(status == "O", F.lit("first")), F.col("o_orderpriority"), F.lit(None), status)
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", F.struct("o_orderkey", items.alias("items")))
    rows = _rows(messages, lambda doc: R.numbered(V.elements(doc, "$.items"), lambda item, place: V.row_of({
        "id": V.get(doc, "$.o_orderkey"), "place": place, "item": item})))
    return _read(rows, id="bigint", place="int", item="string")


def defaults_overwrite_remove(spark, sf_dir):
    """Defaults for absent and for null fields, overwriting, removing at the top and inside."""
    priority = F.col("o_orderpriority")
    # to_json leaves NULL fields out; a JSON null is written as text
    text = F.concat(
        F.lit('{"id": '), "o_orderkey", F.lit(', "status": "'), "o_orderstatus", F.lit('", "sub": {"x": 1, "y": 2}'),
        F.when(F.col("o_orderstatus") == "O", F.lit(', "note": null')).when(
            F.col("o_orderstatus") == "F", F.concat(F.lit(', "note": "'), priority, F.lit('"'))).otherwise(F.lit("")),
        F.lit("}"),
    )
    orders = table(spark, sf_dir, "orders")
    messages = as_messages(orders, F.col("o_orderkey"), text, F.col("o_orderdate"), F.col("o_orderkey"))

    def transform(doc: Column) -> Column:
        hard = V.put_default(doc, {"note": F.lit("absent")})
        soft = V.put_default(doc, {"note": F.lit("none")}, over_null=True)
        return F.array(V.row_of({
            "id": V.get(doc, "$.id"), "hard": F.coalesce(V.text(hard, "$.note"), F.lit("null")),
            "soft": V.get(soft, "$.note"),
            "over": V.text(V.put(doc, {"status": F.when(V.text(doc, "$.status") == "P", F.lit("new"))}), "$.status"),
            "left": S.size(V.drop(doc, "status", "sub")),
            "inner": S.size(V.drop(V.get(doc, "$.sub"), "x")),
            "both": S.size(V.put_paths(doc, {("sub", "z"): F.lit(3), ("gone", "z"): F.lit(3)})),
            "deep": V.read(V.put_paths(doc, {("sub", "x"): V.get(doc, "$.id")}), "$.sub.x", "bigint"),
        }))

    return _read(_rows(messages, transform), id="bigint", hard="string", soft="string", over="string", left="int",
                 inner="int", both="int", deep="bigint")


def rename_keep_rest(spark, sf_dir):
    """Rename some fields, keep whatever else is there."""
    messages = _table_messages(spark, sf_dir, "supplier", "s_suppkey", F.struct("s_suppkey", "s_name", "s_nationkey"))
    app = App([Pipeline("all", "t", {}, lambda doc: F.array(V.rename(doc, {"s_name": "name", "s_nationkey": "nation:key"})))])
    return run(messages, app).select(F.col("offset").alias("s_suppkey"), "value")


def value_dispatch(spark, sf_dir):
    """The text of a leaf chooses the branch; other texts have no rows and are not discarded."""
    messages = _table_messages(spark, sf_dir, "orders", "o_orderkey", F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))
    app = App([Pipeline("d", "t", {}, lambda doc: R.rows(R.dispatch(V.text(doc, "$.o_orderstatus"), {
        "O": V.row_of({"open": V.get(doc, "$.o_orderpriority")}),
        "F": V.row_of({"done": V.get(doc, "$.o_orderkey")}),
    })))])
    return run(messages, app).select("topic", F.col("offset").alias("o_orderkey"), "value")


def path_filters(spark, sf_dir):
    """A list of path segments with filters gives main name and index; several names join by dots."""
    segments = F.array(
        F.struct(F.lit("interfaces").alias("name"), F.lit(None).cast("struct<name:string,index:string>").alias("filters")),
        F.struct(F.lit("interface").alias("name"), F.struct(F.col("p_brand").alias("name"), F.lit(None).cast("string").alias("index")).alias("filters")),
        F.struct(F.lit("subinterface").alias("name"), F.struct(
            F.lit(None).cast("string").alias("name"),
            F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).alias("index")).alias("filters")),
    )
    messages = _table_messages(spark, sf_dir, "part", "p_partkey", F.struct("p_partkey", segments.alias("sensor_path")))

    def transform(doc: Column) -> Column:
        place = Place(doc)
        names = R.filter_values(place, "sensor_path", "name")
        index = S.last_element(V.variant(R.filter_values(place, "sensor_path", "index")))
        parts = F.concat(names, F.array(index))
        return F.array(V.row_of({
            "id": place.at("p_partkey").value, "index": S.to_long(index), "name": S.join(".", V.variant(F.array_compact(parts))),
        }))

    return _read(_rows(messages, transform), id="bigint", index="bigint", name="string")


def matched_but_empty(spark, sf_dir):
    """A branch without rows for a message emits nothing for it, not even a discard."""
    messages = _table_messages(spark, sf_dir, "customer", "c_custkey", F.struct(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.array("c_name")).alias("names")))
    app = App([Pipeline("names", "t-names", {"jsonpath": "$.c_custkey"}, lambda doc: R.fan_out(
        doc, "$.names", lambda name: V.row_of({"name": name})))])
    return run(messages, app).select("topic", F.col("offset").alias("c_custkey"), "value")


QUERIES = {
    f.__name__: f for f in (
        order_fanout, nested_grid, parent_and_child_rows, layout_union, object_keys_explode, merge_key_list, enum_map,
        multi_source_list, typed_rows, cardinality_one, split_tokens, null_holes, defaults_overwrite_remove, rename_keep_rest,
        value_dispatch, path_filters, matched_but_empty,
    )
}

SQL = {
    "order_fanout": " UNION ALL ".join(
        f"SELECT l_orderkey AS \"order\", l_linenumber AS line, l_returnflag AS flag, '{name}' AS name, "
        f"l_{name} AS value FROM lineitem"
        for name in ("quantity", "extendedprice", "discount", "tax")
    ),
    "nested_grid": " UNION ALL ".join(
        f"SELECT c_name AS name, {i} AS i, {j} AS j, {a} AS a, {b} AS b FROM customer"
        for i, j, a, b in (
            (0, 0, "c_custkey", "c_nationkey"), (0, 1, "c_nationkey", "NULL"), (2, 0, "c_nationkey", "NULL"),
            (2, 1, "c_custkey", "c_nationkey"), (2, 2, "c_custkey", "c_nationkey"),
        )
    ),
    "parent_and_child_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS name, o_orderstatus AS status FROM orders
        UNION ALL SELECT o_orderkey || '.' || o_orderpriority, NULL FROM orders WHERE o_orderstatus <> 'O'""",
    "layout_union": """
        SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'flat' WHEN 'F' THEN 'deep' ELSE 'text' END AS layout,
               o_custkey AS cust, o_totalprice AS price FROM orders""",
    "object_keys_explode": """
        SELECT p_partkey AS part, 'p_brand' AS name, p_brand AS value FROM part
        UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
        UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""",
    "merge_key_list": """
        SELECT p_partkey, p_brand AS name0, p_type AS name1, p_size AS size, 2 AS n FROM part""",
    "enum_map": """
        SELECT o_orderkey AS id,
               CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FINISHED' ELSE o_orderstatus END AS status
        FROM orders""",
    "multi_source_list": """
        SELECT o_orderkey AS id, o_orderstatus NOT IN ('O', 'P') AS is_list,
               CASE o_orderstatus WHEN 'O' THEN o_orderpriority WHEN 'P' THEN o_orderstatus
                    ELSE o_orderstatus || '+' || o_orderpriority END AS target,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS copy
        FROM orders""",
    "typed_rows": """
        SELECT c_custkey AS id, split_part(c_name, '#', 2) AS digits, CAST(split_part(c_name, '#', 2) AS BIGINT) AS number,
               CAST(split_part(c_name, '#', 2) AS DOUBLE) / 2 AS half, CAST(split_part(c_name, '#', 2) AS DOUBLE) AS "float",
               TRUE AS flag FROM customer""",
    "cardinality_one": """
        SELECT c_custkey AS id, c_name AS first, c_mktsegment AS same, c_mktsegment AS last, c_mktsegment AS kept
        FROM customer""",
    "split_tokens": """
        SELECT id, CAST(place - 1 AS INTEGER) AS place, word FROM (
            SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM (
                SELECT p_partkey AS id,
                       list_filter(string_split(' ' || p_name || '   ' || p_brand, ' '), lambda w: w <> '') AS words
                FROM part))""",
    "null_holes": """
        SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS INTEGER) AS place, item FROM (
            SELECT o_orderkey AS id, 0 AS n, 'first' AS item FROM orders WHERE o_orderstatus = 'O'
            UNION ALL SELECT o_orderkey, 1, o_orderpriority FROM orders
            UNION ALL SELECT o_orderkey, 3, o_orderstatus FROM orders)""",
    "defaults_overwrite_remove": """
        SELECT o_orderkey AS id,
               CASE o_orderstatus WHEN 'O' THEN 'null' WHEN 'F' THEN o_orderpriority ELSE 'absent' END AS hard,
               CASE o_orderstatus WHEN 'F' THEN o_orderpriority ELSE 'none' END AS soft,
               CASE o_orderstatus WHEN 'P' THEN 'new' ELSE o_orderstatus END AS "over",
               CASE WHEN o_orderstatus IN ('O', 'F') THEN 2 ELSE 1 END AS "left", 1 AS "inner",
               CASE WHEN o_orderstatus IN ('O', 'F') THEN 4 ELSE 3 END AS "both", o_orderkey AS deep
        FROM orders""",
    "rename_keep_rest": """
        SELECT s_suppkey, '{"name":"' || s_name || '","nation:key":' || s_nationkey || ',"s_suppkey":' || s_suppkey || '}'
               AS value FROM supplier""",
    "value_dispatch": """
        SELECT 't' AS topic, o_orderkey, CASE o_orderstatus WHEN 'O' THEN '{"open":"' || o_orderpriority || '"}'
               ELSE '{"done":' || o_orderkey || '}' END AS value FROM orders WHERE o_orderstatus IN ('O', 'F')""",
    "path_filters": """
        SELECT p_partkey AS id, CASE WHEN p_size > 10 THEN CAST(p_size AS BIGINT) END AS "index",
               p_brand || CASE WHEN p_size > 10 THEN '.' || p_size ELSE '' END AS name FROM part""",
    "matched_but_empty": """
        SELECT 't-names' AS topic, c_custkey, '{"name":"' || c_name || '"}' AS value FROM customer WHERE c_acctbal > 0""",
}
