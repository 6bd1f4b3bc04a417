"""Interface counters and states: several device layouts of one message kind to one row shape, with counters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V
from pulsegrain.functions.variants import Place
from pulsegrain.operators import reshape as R
from pulsegrain.operators.routing import gate
from pulsegrain.specs import CounterSet, CounterSpec, KeyPart, Pipeline, TimeRule

# Names that devices use in messages, and that rows carry.
ENVELOPE_FIELDS = (
    "event_type", "seq", "timestamp", "telemetry_node", "telemetry_port", "label", "telemetry_data",
    "serialization", "writer_id",
)
SERIALIZATIONS = ("json_string", "json")
SUBSCRIBED_PATHS = ("/interfaces/interface/", "/interfaces/")
SENSOR_PATHS = (
    "openconfig-interfaces:interfaces/interface/state",
    "openconfig-interfaces:interfaces/interface/state/counters",
    "openconfig-interfaces:interfaces/interface/subinterfaces/subinterface/state",
    "openconfig-interfaces:interfaces/interface/subinterfaces/subinterface/state/counters",
)
ENCODING_PATH = "openconfig-interfaces:interfaces"
EXTENSION_FIELDS = (
    "componentId", "sensorName", "subscribedPath", "streamedPath", "component", "sequenceNumber",
    "payloadGetTimestamp", "streamCreationTimestamp", "exportTimestamp", "subSequenceNumber",
)
SLASH_COUNTERS = (
    "carrier-transitions", "in-broadcast-pkts", "in-multicast-pkts", "in-octets", "in-pkts", "in-unicast-pkts",
    "out-broadcast-pkts", "out-multicast-pkts", "out-octets", "out-pkts", "out-unicast-pkts",
)
SLASH_STATES = (
    "high-speed", "parent-ae-name", "admin-status", "description", "enabled", "ifindex", "last-change", "logical",
    "loopback-mode", "mtu", "oper-status", "type",
)
OBJECT_COUNTERS = (
    "last-clear", "in-broadcast-pkts", "in-discards", "in-errors", "in-multicast-pkts", "in-octets",
    "in-unicast-pkts", "in-unknown-protos", "out-broadcast-pkts", "out-discards", "out-errors",
    "out-multicast-pkts", "out-octets", "out-unicast-pkts",
)
CAMEL_COUNTERS = {
    "inBroadcastPkts": "in_broadcast_pkts", "inErrors": "in_errors", "inFcsErrors": "in_fcs_errors",
    "inMulticastPkts": "in_multicast_pkts", "inOctets": "in_octets", "inUnicastPkts": "in_unicast_pkts",
    "outBroadcastPkts": "out_broadcast_pkts", "outMulticastPkts": "out_multicast_pkts",
    "outOctets": "out_octets", "outUnicastPkts": "out_unicast_pkts",
}
CAMEL_SUB_COUNTERS = (
    "inOctets", "inUnicastPkts", "outBroadcastPkts", "outMulticastPkts", "outOctets", "outUnicastPkts",
)
CAMEL_STATES = {
    "adminStatus": "admin_status", "description": "description", "enabled": "enabled", "ifindex": "ifindex",
    "lastChange": "lastChange", "operStatus": "oper_status",
}
OPER_STATUS = {"OperStatus_UP": "UP", "OperStatus_DOWN": "DOWN", '"UP"': "UP", '"DOWN"': "DOWN"}
ADMIN_STATUS = {"AdminStatus_UP": "UP", "AdminStatus_DOWN": "DOWN", '"UP"': "UP", '"DOWN"': "DOWN"}
COUNTED = (
    "in_broadcast_pkts", "in_discards", "in_errors", "in_fcs_errors", "in_multicast_pkts", "in_octets",
    "in_unicast_pkts", "in_unknown_protos", "out_broadcast_pkts", "out_discards", "out_errors",
    "out_multicast_pkts", "out_octets", "out_unicast_pkts", "in_pkts", "out_pkts",
)

MATCH = {
    "or": [
        {"jsonpath": "$.telemetry_data.encoding_path", "value": ENCODING_PATH},
        *[{"jsonpath": "$.telemetry_data.extension.subscribedPath", "value": p} for p in SUBSCRIBED_PATHS],
        *[{"jsonpath": "$.telemetry_data.sensor_path", "value": p} for p in SENSOR_PATHS],
    ]
}


def door(doc: Column) -> Column:
    """Let only JSON messages in, keep the envelope fields and decode the payload parts that come as text."""
    accepted = F.coalesce(V.text(doc, "$.serialization").isin(*SERIALIZATIONS), F.lit(False))
    payload = V.let(
        S.decode_json(V.get(doc, "$.telemetry_data")),
        lambda data: F.when(V.is_object(data), R.decode_fields(data, "extension", "decoded")).otherwise(data),
    )
    return gate(V.put(doc, {"telemetry_data": payload}, keep=ENVELOPE_FIELDS), accepted)


def _snake(names) -> dict[str, str]:
    return {name: name.replace("-", "_") for name in names}


def _joined_name(main: Column, index: Column) -> Column:
    """Name of a row: the parts of the main name and the index, joined by dots; NULL without any part."""
    return F.nullif(F.array_join(F.concat(main, F.array(index)), "."), F.lit(""))


def _index(value: Column) -> Column:
    """An index as a number where it reads as one."""
    return F.coalesce(V.variant(S.as_long(value)), value)


def _shared(doc: Column) -> Column:
    """What rows of all layouts take from the message: its envelope and a few fields of the payload."""
    sources = {
        **{name: (name,) for name in ENVELOPE_FIELDS if name not in ("label", "telemetry_data")},
        "platform_id": ("label", "pkey"), "node_id": ("label", "nkey"),
        **{name: ("telemetry_data", name) for name in ("msg_timestamp", "node_id_str", "subscription_id_str")},
        "encoding_path": ("telemetry_data", "sensor_path"),
    }
    return V.together(doc, _variants(sources.values()), lambda at: F.struct(*[at(*parts).alias(name) for name, parts in sources.items()]))


_ORIGIN = (*[name for name in ENVELOPE_FIELDS if name not in ("label", "telemetry_data")], "platform_id", "node_id")
_OF_OBJECTS = ("telemetry_node", "platform_id", "node_id", "timestamp", "writer_id", "node_id_str", "subscription_id_str", "msg_timestamp")
_OF_DECODED = (*_ORIGIN, "msg_timestamp", "node_id_str", "subscription_id_str", "encoding_path")


def _variants(paths) -> dict[tuple[str, ...], str]:
    return {parts: "variant" for parts in paths}


def _taken(shared: Column, names) -> dict[str, Column]:
    return {name: shared[name] for name in names}


def _extension_row(shared: Column, _: Column, element: Column) -> Column:
    """Flat keys with slashes next to an ``extension`` object; the element is the payload."""
    data = Place(element)
    main = F.transform(R.filter_values(data, "sensor_path", "name"), lambda name: V.text(name))
    index = F.try_element_at(R.filter_values(data, "sensor_path", "index"), F.lit(-1))
    states = {name: target for name, target in _snake(SLASH_STATES).items() if target not in ("admin_status", "oper_status")}
    sources = {
        "node_id_str": ("extension", "systemId"), **{name: ("extension", name) for name in EXTENSION_FIELDS},
        "init_time": ("/init-time",),
        **{target: (f"/state/counters/{name}",) for name, target in _snake(SLASH_COUNTERS).items()},
        **{target: (f"/state/{name}",) for name, target in states.items()},
    }
    admin, oper, nanos = ("/state/admin-status",), ("/state/oper-status",), ("notification_timestamp",)

    def row(at, index: Column) -> Column:
        millis = S.divide(at(*nanos), F.parse_json(F.lit("1000000"))).try_cast("bigint").cast("string")
        return V.row_of({
            **{target: at(*parts) for target, parts in sources.items()},
            "admin_status": S.rename_values(at(*admin), ADMIN_STATUS),
            "oper_status": S.rename_values(at(*oper), OPER_STATUS),
            **_taken(shared, _ORIGIN),
            "index": _index(index),
            "name": _joined_name(main, V.text(index)),
            "msg_timestamp": F.coalesce(V.variant(millis), shared["msg_timestamp"]),
        })

    # The index is found once, however often the row uses it.
    return V.together(element, _variants([*sources.values(), admin, oper, nanos]), lambda at: V.let(index, lambda found: row(at, found)))


def _object_row(shared: Column, parent: Column, element: Column) -> Column:
    """An interface or subinterface of ``data_json``. The parent tells whether it is both; then values are gathered."""
    sub = ("subinterfaces", "subinterface")
    sub_state, twofold = (*sub, "state"), parent.cast("boolean")
    twin = [("description",), ("admin-status",), ("oper-status",), *[("counters", name) for name in OBJECT_COUNTERS]]
    paths = _variants([
        ("name",), (*sub, "index"), ("state", "type"), ("state", "ifindex"), *[("state", *name) for name in twin],
        *[(*sub_state, name) for name in ("enabled", "ifindex", "index", "name")], *[(*sub_state, *name) for name in twin],
    ])

    def row(at) -> Column:
        def both(*name: str) -> Column:
            a, b = at("state", *name), at(*sub_state, *name)
            return F.when(twofold, S.gather(a, b)).otherwise(F.coalesce(a, b))

        index = F.when(at(*sub_state).isNotNull(), F.coalesce(at(*sub_state, "index"), at(*sub, "index")))
        return V.row_of({
            **_taken(shared, _OF_OBJECTS),
            "type": at("state", "type"),
            "enabled": at(*sub_state, "enabled"),
            "ifindex": F.coalesce(at(*sub_state, "ifindex"), at("state", "ifindex")),
            "description": both("description"),
            "admin_status": S.rename_values(both("admin-status"), ADMIN_STATUS),
            "oper_status": S.rename_values(both("oper-status"), OPER_STATUS),
            **{target: both("counters", name) for name, target in _snake(OBJECT_COUNTERS).items()},
            "index": _index(index),
            "name": F.coalesce(V.text(at(*sub_state, "name")), _joined_name(F.array(V.text(at("name"))), V.text(index))),
        })

    return V.together(element, paths, row)


def _interface_row(shared: Column, name: Column, counters: Column) -> Column:
    """An interface of ``decoded`` with counters of its own."""
    return V.together(counters, _variants((source,) for source in CAMEL_COUNTERS), lambda at: V.row_of({
        **_taken(shared, _OF_DECODED), "name": name, **{target: at(source) for source, target in CAMEL_COUNTERS.items()}}))


def _sub_row(shared: Column, name: Column, element: Column) -> Column:
    """A subinterface of ``decoded``; the parent is its interface's name."""
    states = {source: target for source, target in CAMEL_STATES.items() if target not in ("admin_status", "oper_status")}
    paths = _variants([
        ("index",), ("state", "name"), *[("state", source) for source in CAMEL_STATES], *[("state", "counters", source) for source in CAMEL_SUB_COUNTERS]])

    def row(at) -> Column:
        index = F.when(at("state", "counters").isNotNull(), at("index"))
        return V.row_of({
            **_taken(shared, _OF_DECODED),
            **{target: at("state", source) for source, target in states.items()},
            "admin_status": S.rename_values(at("state", "adminStatus"), ADMIN_STATUS),
            "oper_status": S.rename_values(at("state", "operStatus"), OPER_STATUS),
            **{CAMEL_COUNTERS[source]: at("state", "counters", source) for source in CAMEL_SUB_COUNTERS},
            "index": _index(index),
            "name": F.coalesce(V.text(at("state", "name")), _joined_name(F.array(V.text(name)), V.text(index))),
        })

    return V.together(element, paths, row)


def _pick(doc: Column) -> Column:
    """The elements of every layout that a message holds."""
    data = Place(doc).at("telemetry_data")

    def objects(item: Column) -> Column:
        interface = Place(item).at("content", "interface")
        main, sub = interface.at("state").is_object, interface.at("subinterfaces", "subinterface", "state").is_object
        return F.when(main | sub, R.element(1, interface.value, main & sub))

    def decoded(item: Column) -> Column:
        interface = Place(item)
        name, counters = interface.at("name").value, interface.at("state", "counters")
        subs = F.filter(interface.at("subinterfaces", "subinterface").items, lambda sub: Place(sub).at("state").is_object)
        return R.elements_of(
            F.when(counters.is_object, F.array(R.element(2, counters.value, name))),
            F.transform(subs, lambda sub: R.element(3, sub, name)))

    extension, listed, parts = (("telemetry_data", name) for name in ("extension", "data_json", "decoded"))
    return V.together(doc, {extension: "struct<>", listed: "array<variant>", parts: "array<variant>"}, lambda at: R.elements_of(
        F.when(at(*extension).isNotNull(), F.array(R.element(0, data.value))),
        F.array_compact(F.transform(at(*listed), objects)),
        F.flatten(F.transform(at(*parts), lambda part: F.flatten(F.transform(Place(part).at("interface").items, decoded))))))


#: Rows of every layout a message holds.
LAYOUTS = R.Layouts(_shared, _pick, (_extension_row, _object_row, _interface_row, _sub_row))


def counter_set(names=COUNTED, kind: str = "u64") -> CounterSet:
    shared = tuple(KeyPart(path=path) for path in ("$.telemetry_node", "$.name", "$.index"))
    return CounterSet(
        TimeRule("$.msg_timestamp", "EpochMilli"),
        tuple(CounterSpec(shared + (KeyPart(constant=name),), kind, f"$.{name}") for name in names),
    )


def pipeline(tag: str = "oc-interface", topic: str = "interfaces") -> Pipeline:
    return Pipeline(tag=tag, topic=topic, match=MATCH, transform=LAYOUTS, counters=counter_set())
