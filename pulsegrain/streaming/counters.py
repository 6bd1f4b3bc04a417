"""Counter normalisation over an unbounded stream, in order of arrival.

State is keyed by (tag, entity) and holds one reading per counter beside the counter's own name, so a row is handled as a
whole and a declaration may change over a restart: readings are found by name, whatever the order and number of counters.
All rows go through one stateful step per layer, so the source is read once: rows without counters share a few keys, spread
by position, and touch no state. Python takes a row in few columns, as each costs time: what it reads is one text, what it
hands on is one value per row beside the document, as they are.

Clean-up follows the stream's own time. A task knows the greatest record time of its rows; an entity's timer goes off now and
then and forgets the readings that this time has left behind by more than the cache age. No watermark is set, so no row is
dropped for being late.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulsegrain.functions import variants as V
from pulsegrain.operators import counters as C
from pulsegrain.operators.documents import POSITION
from pulsegrain.operators.fold import step
from pulsegrain.specs import App, NormalizeConfig

#: Name and schema of the state: names, values and times of the readings, the greatest stream time known, and when the timer is due.
READINGS = "readings_by_name"
STATE = "names array<string>, held array<string>, times array<bigint>, seen bigint, due bigint"
#: Keys that rows without counters share.
SPREAD = 256

#: Types that go through Python packed into one value, and what they are there. Documents and raw texts, which have no bound, do not.
_PACKED = {kind: kind for kind in ("string", "int", "bigint", "boolean", "array<string>", "array<bigint>")} | {"timestamp": "bigint"}

Reading = tuple[int, int]


def _brief(text: str) -> tuple[tuple, int | None, int | None, list[str]]:
    """Position, own time, record time and integer texts (empty: none) of a row; the twin of ``_brief_column``."""
    ts, seen, partition, offset, pos, texts, origin = text.split("|", 6)
    return (origin, int(partition), int(offset), int(pos)), int(ts) if ts else None, int(seen) if seen else None, texts.split(",")


def _brief_column(ts: Column, seen: Column, texts: Column) -> Column:
    """What Python reads of a row, as one text. Numbers hold no bar; the origin, which may, comes last."""
    none = F.lit("")
    parts = [ts, seen, F.col("partition"), F.col("offset"), F.col("pos"), F.array_join(texts, ",", ""), F.col("origin")]
    return F.concat_ws("|", *[F.coalesce(part.cast("string"), none) for part in parts])


class CounterProcessor(StatefulProcessor):
    """Differences for all rows of one entity, oldest arrival first.

    The readings of an entity are one state row, so a key costs one read and one write per micro-batch, whatever the
    number of its rows and counters.
    """

    def __init__(self, kinds: dict[str, list[str]], names: dict[str, list[str]], columns: list[str], config: NormalizeConfig):
        self.kinds, self.names, self.columns, self.config = kinds, names, columns, config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.readings = handle.getValueState(READINGS, STATE)
        # Greatest record time of the task's rows; timers go off after them.
        self.seen: int | None = None

    def _load(self) -> tuple[dict[str, Reading], int | None, int | None]:
        saved = self.readings.get()
        if saved is None:
            return {}, None, None
        names, held, times, seen, due = saved
        return {name: (int(value), time) for name, value, time in zip(names, held, times)}, seen, due

    def _save(self, states: dict[str, Reading], due: int) -> None:
        self.readings.update((list(states), [str(value) for value, _ in states.values()], [time for _, time in states.values()], self.seen, due))

    def _see(self, time: int | None) -> None:
        if time is not None and (self.seen is None or time > self.seen):
            self.seen = time

    def _due(self, now: int) -> int:
        # Later than a timer that is going off, which Spark deletes by its time afterwards.
        due = now + max(1, self.config.clean_every_ms)
        self.handle.registerTimer(due)
        return due

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        sys.set_int_max_str_digits(0)  # counters have any number of digits
        tag, shape = key[0], Row(*self.columns, "deltas")
        if tag is None:
            # No counters: nothing to order and nothing to keep.
            for row in rows:
                self._see(_brief(row["_brief"])[1])
                yield shape(*[row[name] for name in self.columns], None)
            return
        kinds, names = self.kinds[tag], self.names[tag]
        states, seen, due = self._load()
        self._see(seen)
        # A micro-batch is bounded by the source's rate limit, and so is one entity's part of it.
        for (_, ts, time, texts), row in sorted(((_brief(row["_brief"]), row) for row in rows), key=lambda one: one[0][0]):
            self._see(time)
            deltas = [""] * len(names)
            for place, (name, text) in enumerate(zip(names, texts)):
                if text:
                    state, delta = step(states.get(name), int(text), ts, kinds[place], self.config)
                    if delta is not None:
                        deltas[place] = str(delta)
                    if state is None:
                        states.pop(name, None)
                    else:
                        states[name] = state
            yield shape(*[row[name] for name in self.columns], ",".join(deltas))
        self._save(states, self._due(timerValues.getCurrentProcessingTimeInMs()) if due is None else due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        sys.set_int_max_str_digits(0)
        states, seen, _ = self._load()
        self._see(seen)
        young = {name: state for name, state in states.items() if self.seen is None or state[1] >= self.seen - self.config.cache_age_ms}
        if young:
            self._save(young, self._due(timerValues.getCurrentProcessingTimeInMs()))
        else:
            self.readings.clear()
        return iter(())

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        if key[0] is not None:
            self.readings.update((
                initialState["names"], initialState["held"], initialState["times"], initialState["seen"],
                self._due(timerValues.getCurrentProcessingTimeInMs())))

    def close(self) -> None:
        pass


def normalize_stream(rows: DataFrame, app: App, initial: DataFrame | None = None) -> DataFrame:
    """Streaming twin of ``operators.arrival.normalize_arrival``: adds ``d<n>`` per layer.

    With several layers one stateful step follows another; the source is read once all the same. ``initial`` holds readings
    (layer, tag, entity, name, value, time) to start a new stream with; see ``streaming.state``.
    """
    layers = C.layers(app)
    for number, layer in enumerate(layers):
        rows = _one_layer(rows, number, layer, app.normalize, initial)
    return rows


def _one_layer(rows: DataFrame, number: int, layer, config: NormalizeConfig, initial: DataFrame | None) -> DataFrame:
    entity, values, deltas = f"entity{number}", f"v{number}", f"d{number}"
    counted = F.coalesce(
        F.col(entity).isNotNull() & F.exists(F.col(values), lambda value: value.isNotNull()), F.lit(False)
    )
    kinds = {p.tag: [c.kind for c in counters] for p, counters in layer.members}
    names = {p.tag: [c.slot_name for c in counters] for p, counters in layer.members}
    types = dict(rows.dtypes)
    packed = [name for name in rows.columns if types[name] in _PACKED and name != "raw"]
    apart = [name for name in rows.columns if name not in packed]
    seen = F.unix_millis(F.col("timestamp").cast("timestamp"))
    envelope = F.to_variant_object(F.struct(*[
        (F.unix_micros(name) if types[name] == "timestamp" else F.col(name)).alias(name) for name in packed]))
    stateful = rows.select(
        envelope.alias("_packed"), *apart,
        _brief_column(F.col("ts_ms"), seen, F.when(counted, F.col(values))).alias("_brief"),
        F.when(counted, F.col("tag")).alias("_tag"),
        F.when(counted, F.col(entity)).otherwise(F.pmod(F.xxhash64(*POSITION), F.lit(SPREAD)).cast("string")).alias("_entity"),
    )
    columns = ["_packed", *apart]
    schema = ", ".join(f"`{name}` {stateful.schema[name].dataType.simpleString()}" for name in columns) + ", deltas string"
    start = None if initial is None else _grouped(initial.where(F.col("layer") == number)).groupBy("_tag", "_entity")
    done = stateful.groupBy("_tag", "_entity").transformWithState(
        statefulProcessor=CounterProcessor(kinds, names, columns, config),
        outputStructType=schema, outputMode="Append", timeMode="ProcessingTime", initialState=start,
    )
    fields = ",".join(f"`{name}`:{_PACKED[types[name]]}" for name in packed)
    opened = done.withColumn("_packed", V.read(F.col("_packed"), "$", f"struct<{fields}>"))

    def homeward(name: str) -> Column:
        if name in apart:
            return F.col(name)
        held = F.col("_packed").getField(name)
        return (F.timestamp_micros(held) if types[name] == "timestamp" else held).alias(name)

    differences = F.transform(F.split("deltas", ","), lambda text: F.nullif(text, F.lit("")).cast("bigint"))
    return opened.select(*[homeward(name) for name in rows.columns], differences.alias(deltas))


def _grouped(readings: DataFrame) -> DataFrame:
    """One row per entity, no wider than its counters are many."""
    held = F.array_sort(F.collect_list(F.struct("name", "value", "time")))
    return readings.groupBy(F.col("tag").alias("_tag"), F.col("entity").alias("_entity")).agg(held.alias("all")).select(
        "_tag", "_entity", F.col("all.name").alias("names"), F.col("all.value").alias("held"), F.col("all.time").alias("times"),
        F.lit(None).cast("bigint").alias("seen"))
