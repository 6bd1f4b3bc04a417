"""Every payload layout of interface messages to the common row shape."""

import json

from pulsegrain import App, run
from pulsegrain.plans import interfaces
from pulsegrain.plans.pipeline import flatten


def envelope(data, **extra):
    return {
        "event_type": "log", "seq": 7, "timestamp": "1700000000.250000", "telemetry_node": "10.1.1.1",
        "telemetry_port": 50001, "label": {"nkey": "node-a", "pkey": "plat"}, "serialization": "json",
        "writer_id": "w1", "unwanted": 1, "telemetry_data": data, **extra,
    }


def app():
    return App([interfaces.pipeline(topic="ifs")], pre_transform=interfaces.door)


def objects(millis, *interfaces_):
    return {
        "node_id_str": "a", "subscription_id_str": "sub", "encoding_path": "openconfig-interfaces:interfaces",
        "msg_timestamp": str(millis),
        "data_json": [{"timestamp": str(millis), "content": {"interface": item}} for item in interfaces_],
    }


def main(name, octets):
    return {"name": name, "state": {"type": "eth", "counters": {"in-octets": str(octets), "out-errors": octets}}}


def sub(name, index, octets):
    return {"name": name, "subinterfaces": {"subinterface": {
        "index": index, "state": {"index": index, "counters": {"in-octets": str(octets)}}}}}


SHARED = {
    "telemetry_node": "10.1.1.1", "platform_id": "plat", "node_id": "node-a", "timestamp": "1700000000.250000",
    "writer_id": "w1",
}


def test_object_layout_counts_between_messages(messages, emitted):
    texts = [
        envelope(objects(1_700_000_000_000, main("Gi0", 100), sub("Gi0", 30, 5))),
        envelope(json.dumps(objects(1_700_000_010_000, main("Gi0", 175), sub("Gi0", 30, 9))), serialization="json_string"),
    ]
    out = emitted(run(messages(texts), app()))
    base = {**SHARED, "node_id_str": "a", "subscription_id_str": "sub"}
    assert out == [
        ("ifs", "oc-interface", {**base, "msg_timestamp": "1700000000000", "type": "eth", "name": "Gi0",
                                 "in_octets": None, "out_errors": None}),
        ("ifs", "oc-interface", {**base, "msg_timestamp": "1700000000000", "name": "Gi0.30", "index": 30,
                                 "in_octets": None}),
        ("ifs", "oc-interface", {**base, "msg_timestamp": "1700000010000", "type": "eth", "name": "Gi0",
                                 "in_octets": 75, "out_errors": 75}),
        ("ifs", "oc-interface", {**base, "msg_timestamp": "1700000010000", "name": "Gi0.30", "index": 30,
                                 "in_octets": 4}),
    ]


def slashes(nanos, octets):
    return {
        "/init-time": "5", "/state/counters/in-octets": str(octets), "/state/oper-status": '"UP"',
        "/state/admin-status": '"DOWN"', "/state/description": '""', "/state/last-change": "9",
        "extension": json.dumps({"systemId": "sys", "componentId": 4, "subscribedPath": "/interfaces/interface/"}),
        "notification_timestamp": nanos, "sensor_path": [
            {"name": "interfaces"}, {"name": "interface", "filters": {"name": "xe-7/1"}},
            {"name": "subinterfaces"}, {"name": "subinterface", "filters": {"index": "0"}}],
    }


def test_slash_layout(messages, emitted):
    out = emitted(run(messages([
        envelope(slashes(1500000000123456789, 1000)), envelope(slashes(1500000010123456789, 4000)),
    ]), app()))
    want = {
        **SHARED, "event_type": "log", "seq": 7, "telemetry_port": 50001, "serialization": "json",
        "node_id_str": "sys", "componentId": 4, "subscribedPath": "/interfaces/interface/", "init_time": "5",
        "in_octets": None, "oper_status": "UP", "admin_status": "DOWN", "description": '""', "last_change": "9",
        "name": "xe-7/1.0", "index": 0, "msg_timestamp": "1500000000123",
    }
    assert [row for _, _, row in out] == [want, {**want, "in_octets": 3000, "msg_timestamp": "1500000010123"}]


def decoded(*parts, path="openconfig-interfaces:interfaces/interface/state/counters", as_text=False):
    items = [{"interface": part} for part in parts]
    return {
        "msg_timestamp": 1500000000777, "node_id_str": "n", "subscription_id_str": "s", "sensor_path": path,
        "decoded": [json.dumps(item) for item in items] if as_text else items,
    }


def test_decoded_counters_keep_an_interface_with_empty_counters(messages, emitted):
    data = decoded(
        [{"name": "A", "state": {"counters": {"inOctets": "5", "inErrors": 1}}}],
        [{"name": "B", "state": {"counters": {}}}, {"name": "C", "state": {"name": "C"}}],
    )
    out = emitted(run(messages([envelope(data)]), app()))
    assert [(row["name"], row.get("in_octets", "absent")) for _, _, row in out] == [("A", None), ("B", "absent")]
    assert out[0][2]["encoding_path"].endswith("state/counters")
    assert out[0][2]["msg_timestamp"] == 1500000000777


def test_decoded_states_from_texts(messages, emitted):
    data = decoded([{"name": "T2", "subinterfaces": {"subinterface": [
        {"state": {"adminStatus": "AdminStatus_UP", "enabled": True, "ifindex": 1, "name": "T2",
                   "operStatus": "OperStatus_DOWN"}},
        {"index": 25, "state": {"index": 25, "name": "T2.25", "operStatus": "Unknown"}},
    ]}}], path="openconfig-interfaces:interfaces/interface/subinterfaces/subinterface/state", as_text=True)
    rows = [row for _, _, row in emitted(run(messages([envelope(data)]), app()))]
    assert [(r["name"], r.get("oper_status"), r.get("admin_status"), r.get("index")) for r in rows] == [
        ("T2", "DOWN", "UP", None), ("T2.25", "Unknown", None, None)]


def test_no_rows_discard_and_silent_drop(messages, emitted):
    no_rows = envelope(objects(1_700_000_000_000, {"name": "Gi0", "aggregation": {"state": {}}}))
    states_only = envelope(decoded([{"name": "A", "state": {"name": "A"}}]))
    other = envelope({"encoding_path": "something-else"})
    gated = envelope({}, serialization="gpb")
    out = emitted(run(messages([no_rows, states_only, other, gated]), app()))
    assert [(topic, tag) for topic, tag, _ in out] == [("discard", None)]
    assert "unwanted" not in out[0][2] and out[0][2]["telemetry_data"] == {"encoding_path": "something-else"}


def test_elements_are_read_in_one_pass(spark, messages):
    """Rows and what they share take no path of a layout one by one; names that are missing would cost the most."""
    most = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        text = flatten(messages([]), app())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", most)
    assert text.count("try_variant_get") < 160
