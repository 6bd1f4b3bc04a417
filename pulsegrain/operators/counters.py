"""Counter normalisation: cumulative values of a row become differences to the value seen before.

The rules are columns over one reading and the reading before it. Values are integer texts of any length. In order of the
rows' own time the reading before is found by windows over positions, times and texts only; documents are joined to the
differences by position.

Skew. The order (entity, time, position) itself is cut into even ranges, wherever the cuts fall, so a range is no larger if one
entity has a third of all rows, if a clock stands still or if a key part is missing. Inside a range a window finds the reading before.
What it cannot find there, for the first readings of the entity that a cut runs through, comes from the last rows of the
ranges before: only those few rows meet in a second window over the whole entity, all others are spread by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.functions.scalars import whole_text
from pulsegrain.functions.times import epoch_millis
from pulsegrain.operators.documents import COUNTERS, POSITION
from pulsegrain.operators.predicates import predicate
from pulsegrain.specs import App, CounterSpec, NormalizeConfig, Pipeline

READING = "struct<v:string,ts:bigint>"


def _big(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(38,0)")


# The ranges counters run through.
MAX_U32 = 2**32 - 1
MAX_S64 = 2**63 - 1
MAX_U64 = 2**64 - 1


def signed64(low: Column) -> Column:
    """BIGINT with the low 64 bits of an integer, in two's complement."""
    low = F.pmod(low, _big(2**64))
    return F.when(low > _big(MAX_S64), low - _big(2**64)).otherwise(low).cast("bigint")


def low64(digits: Column) -> Column:
    """The low 64 bits of integer text of any length, as DECIMAL(38,0) from 0 up; long texts nine digits at a time."""
    bare = F.ltrim(digits, F.lit("-"))
    width = F.ceil(F.length(bare) / F.lit(9)).cast("int") * 9
    chunks = F.regexp_extract_all(F.lpad(bare, width, F.lit("0")), F.lit("[0-9]{9}"), F.lit(0))
    folded = F.aggregate(
        chunks, _big(0), lambda sum_, chunk: F.pmod(sum_ * F.lit(10**9).cast("decimal(10,0)") + chunk.cast("decimal(9,0)"), _big(2**64)).cast("decimal(38,0)"))
    signed = F.when(digits.startswith("-"), -folded).otherwise(folded)
    return F.pmod(F.when(F.length(digits) <= 37, digits.try_cast("decimal(38,0)")).otherwise(signed.cast("decimal(38,0)")), _big(2**64))


def low_difference(value: Column, old: Column) -> Column:
    """DECIMAL(38,0) that equals ``value - old`` modulo 2^64. Long texts mostly differ in their last 18 digits alone, which BIGINT subtracts."""
    size = F.length(value)
    alike = ~value.startswith("-") & (size > 18) & (size == F.length(old)) & (value.substr(F.lit(1), size - 18) == old.substr(F.lit(1), size - 18))
    last = value.substr(size - 17, F.lit(18)).try_cast("bigint") - old.substr(size - 17, F.lit(18)).try_cast("bigint")
    return F.when(alike, last.cast("decimal(38,0)")).otherwise((low64(value) - low64(old)).cast("decimal(38,0)"))


def at_least(a: Column, b: Column) -> Column:
    """Whether integer text ``a`` is no smaller than ``b``, by sign, length and digits."""
    below, under = a.startswith("-"), b.startswith("-")
    long_a, long_b = F.length(a), F.length(b)
    above = (long_a > long_b) | ((long_a == long_b) & (a >= b))
    deeper = (long_a < long_b) | ((long_a == long_b) & (a <= b))
    return F.when(below != under, under).when(below, deeper).otherwise(above)


def delta(kind: str | Column, value: Column, ts: Column, before: Column, config: NormalizeConfig) -> Column:
    """Difference to the reading ``before`` (STRUCT v, ts; not later than ``ts``) or NULL; values are integer texts.

    NULL: first sight, stale reading before, or reset. A smaller value counts as wrapped around if the difference over
    the end of the range is small and recent.
    """
    if isinstance(kind, str):
        kind = F.lit(kind)
    old, seen = before["v"], before["ts"]
    age = F.try_subtract(ts, seen)
    fresh = before.isNotNull() & (age <= config.cache_age_ms)

    def rest(low: Column) -> Column:
        over32 = F.pmod(_big(MAX_U32) + low["diff"], _big(2**64))
        over64 = F.pmod(F.when(at_least(F.lit(str(MAX_S64)), old), _big(MAX_S64)).otherwise(_big(MAX_U64)) + low["diff"], _big(2**64))
        # The limit is compared with the low bits read as a signed number, which for a limit below half the range
        # is the same as comparing the low bits themselves.
        wrapped = (
            F.when((kind == "u32") & (F.pmod(over32, _big(2**32)) < _big(config.u32_limit)), over32)
            .when((kind == "u64") & (over64 < _big(config.u64_limit)), over64)
        )
        return F.when(at_least(value, old), signed64(low["diff"])).when(age <= config.wrap_time_ms, signed64(wrapped))

    def within(pair: Column) -> Column:
        """Both readings within 63 bits, which is the rule: BIGINT does, and nothing can overflow."""
        now, then = pair["now"], pair["then"]
        span32, span64 = F.lit(MAX_U32).cast("bigint") - then + now, F.lit(MAX_S64).cast("bigint") - then + now
        wrapped = (
            F.when((kind == "u32") & (F.pmod(span32, F.lit(2**32).cast("bigint")) < config.u32_limit), span32)
            .when((kind == "u64") & (span64 < config.u64_limit), span64)
        )
        return F.when(
            (now >= 0) & (then >= 0), F.when(now >= then, now - then).when(age <= config.wrap_time_ms, wrapped)
        ).otherwise(V.let(F.struct(low_difference(value, old).alias("diff")), rest))

    shorts = F.struct(value.try_cast("bigint").alias("now"), old.try_cast("bigint").alias("then"))
    return F.when(fresh & value.isNotNull(), V.let(shorts, within))


@dataclass(frozen=True)
class _Layer:
    """The counters of every pipeline that share one entity; one per pipeline and layer."""

    members: tuple[tuple[Pipeline, tuple[CounterSpec, ...]], ...]

    @property
    def width(self) -> int:
        return max(len(counters) for _, counters in self.members)


def layers(app: App) -> list[_Layer]:
    """One layer, hence one shuffle, unless some pipeline has counters with different entities."""
    grouped = [(p, p.counters.groups()) for p in app.pipelines if p.counters and p.counters.counters]
    depth = max((len(groups) for _, groups in grouped), default=0)
    return [
        _Layer(tuple((p, tuple(groups[level])) for p, groups in grouped if level < len(groups)))
        for level in range(depth)
    ]


def _by_tag(layer: _Layer, choose, otherwise: Column) -> Column:
    result: Column | None = None
    for pipeline, counters in layer.members:
        value = choose(pipeline, counters)
        condition = F.col("tag") == F.lit(pipeline.tag)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return otherwise if result is None else result.otherwise(otherwise)


def entity_key(row: Column, counter: CounterSpec) -> Column:
    """Key text without its constants: every part led by a comma, absent values as ``null``."""
    return F.concat(*[
        F.concat(F.lit(","), F.coalesce(V.text(row, part.path), F.lit("null"))) if part.path is not None
        else F.lit(",")
        for part in counter.key
    ])


def counter_key(row: Column, counter: CounterSpec) -> Column:
    """The whole key text of one counter."""
    return F.concat(*[
        F.concat(
            F.lit(","),
            F.lit(part.constant) if part.path is None else F.coalesce(V.text(row, part.path), F.lit("null")),
        )
        for part in counter.key
    ])


def read_counters(rows: DataFrame, app: App) -> DataFrame:
    """Check all counters of a row before any of them touches state.

    Adds ``ts_ms`` and, per layer, ``entity<n>`` and ``v<n>`` (ARRAY of integer texts, NULL where a counter is absent
    or does not match). A row with a bad value or time gets its ``error`` set and no readings.
    """
    row = F.col("row")
    found = layers(app)
    if not found:
        return rows
    live = F.col("error").isNull() & F.col("tag").isNotNull()
    with_sets = [p for p in app.pipelines if p.counters and p.counters.counters]
    ts = F.lit(None).cast("bigint")
    for pipeline in reversed(with_sets):
        time = pipeline.counters.time
        ts = F.when(F.col("tag") == F.lit(pipeline.tag), epoch_millis(row, time.path, time.kind, time.zone)).otherwise(ts)

    def hits(counters: Sequence[CounterSpec]) -> Column:
        return F.array(*[predicate(counter.match, row) for counter in counters])

    def raw(counters: Sequence[CounterSpec]) -> Column:
        paths = {tuple(V.steps(c.value)): "string" for c in counters}
        return V.together(row, paths, lambda at: F.array(*[
            F.when(predicate(c.match, row), F.ltrim(at(*V.steps(c.value)), F.lit(V.MARK))) for c in counters]))

    none = F.lit(None)
    staged = rows.select(
        "*",
        F.when(live, ts).alias("ts_ms"),
        *[
            F.when(live, _by_tag(layer, lambda _, c: hits(c), none.cast("array<boolean>"))).alias(f"_hit{n}")
            for n, layer in enumerate(found)
        ],
        *[
            F.when(live, _by_tag(layer, lambda _, c: raw(c), none.cast("array<string>"))).alias(f"_raw{n}")
            for n, layer in enumerate(found)
        ],
        *[
            F.when(live, _by_tag(layer, lambda _, c: entity_key(row, c[0]), none.cast("string"))).alias(f"_e{n}")
            for n, layer in enumerate(found)
        ],
    )
    # One expression over the texts of all counters: the plan does not grow with their number.
    staged = staged.select(
        "*", *[F.transform(f"_raw{n}", whole_text).alias(f"_v{n}") for n in range(len(found))]
    )
    wanted = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.exists(F.col(f"_hit{n}"), lambda hit: hit), F.lit(False)) for n in range(len(found))],
    )
    broken = reduce(
        lambda a, b: a | b,
        [
            F.coalesce(F.size(F.array_compact(F.col(f"_raw{n}"))) != F.size(F.array_compact(F.col(f"_v{n}"))), F.lit(False))
            for n in range(len(found))
        ],
    )
    message = F.when(wanted & F.col("ts_ms").isNull(), "the row has no readable timestamp").when(
        broken, "a counter is not an integer"
    )
    checked = staged.withColumn("_fault", message)
    fine = F.col("_fault").isNull()
    plain = [name for name in rows.columns if name not in ("error", "step")]
    return checked.select(
        *plain,
        F.coalesce("error", "_fault").alias("error"),
        F.when(F.col("_fault").isNotNull(), F.lit(COUNTERS)).otherwise(F.col("step")).alias("step"),
        "ts_ms",
        *[F.when(fine, F.col(f"_e{n}")).alias(f"entity{n}") for n in range(len(found))],
        *[F.when(fine, F.col(f"_v{n}")).alias(f"v{n}") for n in range(len(found))],
    )


def slot_heads(counters: Sequence[CounterSpec]) -> list[int]:
    """For every counter the first place that has the same key."""
    first: dict[tuple, int] = {}
    return [first.setdefault(counter.slot, place) for place, counter in enumerate(counters)]


def narrow(rows: DataFrame, app: App) -> DataFrame:
    """What normalisation needs, for all layers in one pass: tag, layer, entity, position, ts_ms and texts."""
    sides = [
        F.struct(F.lit(number).alias("layer"), F.col(f"entity{number}").alias("entity"), F.col(f"v{number}").alias("texts"))
        for number in range(len(layers(app)))
    ]
    counted = F.filter(F.array(*sides), lambda side: side["entity"].isNotNull() & F.exists(side["texts"], lambda text: text.isNotNull()))
    # The outer form, or the optimiser would evaluate the whole array once more as a filter.
    return rows.select("tag", *POSITION, "ts_ms", F.explode_outer(counted).alias("side")).where(F.col("side").isNotNull()).select(
        "tag", *POSITION, "ts_ms", "side.layer", "side.entity", "side.texts")


def widened(rows: DataFrame, deltas: DataFrame, app: App) -> DataFrame:
    """Join differences (position, tag, layer, deltas) to their rows as ``d<n>`` per layer."""
    keys, depth = [*POSITION, "tag"], len(layers(app))
    if depth == 1:
        wide = deltas.select(*keys, F.col("deltas").alias("d0"))
    else:
        wide = deltas.groupBy(*keys).agg(*[
            F.first(F.when(F.col("layer") == number, F.col("deltas")), ignorenulls=True).alias(f"d{number}") for number in range(depth)])
    return rows.join(wide, keys, "left")


def _reading(place: int) -> Column:
    value = F.get(F.col("texts"), F.lit(place))
    return F.when(value.isNotNull(), F.struct(value.alias("v"), F.col("ts_ms").alias("ts")))


def _choose(app: App, build, otherwise: Column) -> Column:
    """A column by layer and tag out of ``build(counters)``."""
    result = otherwise
    for number, layer in enumerate(layers(app)):
        for pipeline, counters in layer.members:
            mine = (F.col("layer") == number) & (F.col("tag") == F.lit(pipeline.tag))
            result = F.when(mine, build(counters)).otherwise(result)
    return result


def _shared(app: App) -> bool:
    """Some key is written by more than one counter of a pipeline."""
    return any(slot_heads(c) != list(range(len(c))) for layer in layers(app) for _, c in layer.members)


def normalize_time(rows: DataFrame, app: App, ranges: int | None = None) -> DataFrame:
    """Add ``d<n>`` (ARRAY<BIGINT>) per layer, in order of the rows' own time, position breaking ties.

    The same plan at every size: one sort into ranges and two windows over the narrow rows of all layers, then one join. ``ranges``
    is the number of cuts (default: the session's shuffle partitions).
    """
    found = layers(app)
    if not found:
        return rows
    config, places, none = app.normalize, range(max(layer.width for layer in found)), F.lit(None).cast(READING)
    shared = _shared(app)

    def left(place: int) -> Column:
        """The reading a row leaves behind for the key whose first counter is at ``place``."""
        def last(counters: Sequence[CounterSpec]) -> Column:
            mine = [p for p, head in enumerate(slot_heads(counters)) if head == place]
            return F.coalesce(*[_reading(p) for p in reversed(mine)]) if mine else none
        return _choose(app, last, none) if shared else _reading(place)

    def before(place: int) -> Column:
        """The reading that counter ``place`` compares with: an earlier counter of the row itself, or the windows'."""
        def one(counters: Sequence[CounterSpec]) -> Column:
            if place >= len(counters):
                return none
            heads = slot_heads(counters)
            inside = [p for p in range(place) if heads[p] == heads[place]]
            return F.coalesce(*[_reading(p) for p in reversed(inside)], F.col(f"_prev{heads[place]}"))
        return _choose(app, one, none) if shared else F.col(f"_prev{place}")

    entity, order = ["layer", "tag", "entity"], ["ts_ms", *POSITION]
    plain = narrow(rows, app)
    cut = (plain.repartitionByRange(ranges, *entity, *order) if ranges else plain.repartitionByRange(*entity, *order)).withColumn(
        "_range", F.spark_partition_id())
    near = Window.partitionBy("_range", *entity).orderBy(*order)
    past = near.rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumns({f"_left{p}": left(p) for p in places}).withColumns(
        {f"_prev{p}": F.last(f"_left{p}", ignorenulls=True).over(past) for p in places} | {"_end": F.lead(F.lit(1)).over(near).isNull()})
    waits = reduce(lambda a, b: a | b, [F.col(f"_left{p}").isNotNull() & F.col(f"_prev{p}").isNull() for p in places])
    # Rows that wait for an earlier range, and the last rows of an entity in its ranges, meet by entity.
    spread = inside.withColumn("_meet", F.when(waits | F.col("_end"), F.lit(0).cast("bigint")).otherwise(F.xxhash64(*POSITION)))
    far = Window.partitionBy(*entity, "_meet").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    settled = spread.withColumns({
        f"_carry{p}": F.last(F.when(F.col("_end"), F.coalesce(f"_left{p}", f"_prev{p}")), ignorenulls=True).over(far) for p in places
    }).withColumns({f"_prev{p}": F.coalesce(f"_prev{p}", f"_carry{p}") for p in places})
    kinds = _choose(app, lambda counters: F.array(*[F.lit(c.kind) for c in counters]), F.lit(None).cast("array<string>"))
    zipped = F.arrays_zip(
        F.col("texts").alias("v"), F.array(*[before(p) for p in places]).alias("before"), kinds.alias("kind"))
    deltas = F.transform(
        F.slice(zipped, 1, F.size("texts")), lambda item: delta(item["kind"], item["v"], F.col("ts_ms"), item["before"], config))
    return widened(rows, settled.select(*POSITION, "tag", "layer", deltas.alias("deltas")), app)


def write_counters(rows: DataFrame, app: App) -> DataFrame:
    """Put the differences into the documents: a NULL difference shows as JSON null, an absent counter stays absent."""
    found = layers(app)
    if not found:
        return rows
    row = F.col("row")
    updated = row
    for number, layer in enumerate(found):
        def choose(_, counters, number=number, updated=updated):
            paths: dict[tuple, Column] = {}
            for place, counter in enumerate(counters):
                parts = tuple(V.steps(counter.value))
                now = F.when(
                    F.get(F.col(f"v{number}"), F.lit(place)).isNotNull(),
                    F.coalesce(V.variant(F.get(F.col(f"d{number}"), F.lit(place))), V.json_null()),
                )
                paths[parts] = F.coalesce(now, paths[parts]) if parts in paths else now
            return V.put_paths(updated, paths)

        updated = _by_tag(layer, choose, updated)
    extra = {f"{kind}{n}" for kind in ("entity", "v", "d") for n in range(len(found))}
    changed = F.when(F.col("error").isNull() & F.col("tag").isNotNull(), updated).otherwise(row)
    return rows.select(*[changed.alias("row") if c == "row" else F.col(c) for c in rows.columns if c not in extra])
