"""Counter normalisation of bounded data in order of arrival, late readings included; all of it in DataFrame functions.

What a reading compares with depends on all arrivals before it, so history cannot be cut by time. It is cut by position
instead. A reading does one thing to the reading held: it takes its place, leaves it alone, or, if it is older by more than the
cutoff, makes it be forgotten. Which of these depends on the time held alone, so any stretch of history is a step function from the
time held before to the reading held after, and step functions compose. Runs of positions are reduced to theirs, those to
the functions of longer stretches, level by level, until few are left; on the way back every stretch learns what is held
when it begins. Then all runs are independent. In a run only the readings that make the held one be forgotten are looked
for, one pass over its times; they cut it into pieces in each of which the reading held is the greatest time so far, a
window. No step sees more than one run or ``FAN`` stretches of one counter, however many of all rows belong to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.operators import counters as C
from pulsegrain.operators.documents import POSITION
from pulsegrain.sources.staging import staged
from pulsegrain.specs import App

COUNTER = ["layer", "tag", "entity", "slot"]
HELD = "struct<ts:bigint,v:string>"
#: What a stretch does to the time held before it: pieces by upper end (NULL: none), either the same reading or another (NULL: none held).
PIECES = f"array<struct<upto:bigint,same:boolean,to:{HELD}>>"
EFFECT = f"struct<pieces:{PIECES},empty:{HELD}>"
#: Offsets of a run, and stretches that are composed at once.
RUN_LENGTH, FAN = 100_000, 500


# ---- step functions ---------------------------------------------------------------------------------------------------

def _piece(upto: Column, same: Column, to: Column) -> Column:
    return F.struct(upto.alias("upto"), same.alias("same"), to.cast(HELD).alias("to"))


def effect_of(reading: Column, cutoff_ms: int) -> Column:
    """Effect of one reading (struct ts, v): it takes over from any time up to its own, empties beyond the cutoff."""
    none = F.lit(None)
    # Beyond the last time there is none that the reading could empty.
    end = F.try_add(reading["ts"], F.lit(cutoff_ms).cast("bigint"))
    own = _piece(reading["ts"], F.lit(False), reading)
    rest = F.array(_piece(end, F.lit(True), none), _piece(none.cast("bigint"), F.lit(False), none))
    return F.struct(F.concat(F.array(own), rest).cast(PIECES).alias("pieces"), reading.cast(HELD).alias("empty"))


def after(effect: Column, held: Column) -> Column:
    """What is held after a stretch, by what is held before it."""
    def of(hit: Column) -> Column:
        return F.when(held.isNull(), effect["empty"]).when(hit["same"], held).otherwise(hit["to"])

    return V.let(F.get(F.filter(effect["pieces"], lambda p: p["upto"].isNull() | (held["ts"] <= p["upto"])), F.lit(0)), of)


def _tidy(pieces: Column) -> Column:
    """Leave out pieces that hold no time and join neighbours with one outcome."""
    def add(out: Column, p: Column) -> Column:
        def onto(last: Column) -> Column:
            alike = last["same"].eqNullSafe(p["same"]) & last["to"].eqNullSafe(p["to"])
            return F.when(F.size(out) == 0, F.array(p)).when(last["upto"].isNull() | (p["upto"] <= last["upto"]), out).when(
                alike, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(p))).otherwise(F.concat(out, F.array(p)))
        return V.let(F.try_element_at(out, F.lit(-1)), onto)

    return F.aggregate(pieces, F.array().cast(PIECES), lambda out, p: add(out, p).cast(PIECES))


def then(first: Column, second: Column) -> Column:
    """The effect of one stretch and the one after it."""
    def composed(both: Column) -> Column:
        one, two = both["one"], both["two"]

        def moved(p: Column) -> Column:
            inside = F.transform(two["pieces"], lambda q: _piece(F.least(q["upto"], p["upto"]), q["same"], q["to"]))
            return F.when(p["same"], inside).otherwise(F.array(_piece(p["upto"], F.lit(False), after(two, p["to"]))))

        return F.struct(
            _tidy(F.flatten(F.transform(one["pieces"], moved))).alias("pieces"), after(two, one["empty"]).cast(HELD).alias("empty"))

    return V.let(F.struct(first.alias("one"), second.alias("two")), composed)


def nothing() -> Column:
    """The effect of no reading at all."""
    null = F.lit(None)
    return F.struct(F.array(_piece(null.cast("bigint"), F.lit(True), null)).cast(PIECES).alias("pieces"), null.cast(HELD).alias("empty")).cast(EFFECT)


def run_effect(readings: Column, cutoff_ms: int) -> Column:
    """Effect of readings (structs with ts and v) in order. Times that never fall need no composing."""
    fold = F.aggregate(readings, nothing(), lambda e, r: then(e, effect_of(F.struct(r["ts"].alias("ts"), r["v"].alias("v")), cutoff_ms)).cast(EFFECT))
    times = F.transform(readings, lambda r: r["ts"])
    last = F.try_element_at(readings, F.lit(-1))
    held = F.struct(last["ts"].alias("ts"), last["v"].alias("v")).cast(HELD)
    null, end = F.lit(None), F.try_add(F.get(times, F.lit(0)), F.lit(cutoff_ms).cast("bigint"))
    # The first of them empties what is beyond its cutoff; the next one, if any, is taken then.
    rising = F.struct(_tidy(F.array(
        _piece(last["ts"], F.lit(False), held), _piece(end, F.lit(True), null),
        _piece(null.cast("bigint"), F.lit(False), F.when(F.size(readings) > 1, held))).cast(PIECES)).alias("pieces"), held.alias("empty"))
    return F.when(F.size(readings) == 0, nothing()).when(times == F.array_sort(times), rising.cast(EFFECT)).otherwise(fold)


# ---- history ------------------------------------------------------------------------------------------------------------

def _readings(rows: DataFrame, app: App, run_length: int) -> DataFrame:
    """One row per reading: counter, run, ``at`` (its place in the run), ts and v, and what it takes to find its row again."""
    heads = C._choose(app, lambda counters: F.array(*[F.lit(h) for h in C.slot_heads(counters)]), F.lit(None).cast("array<int>"))
    narrow = C.narrow(rows, app).withColumn("partition", F.col("partition").cast("int"))
    each = narrow.withColumn("heads", heads).select(
        "layer", "tag", "entity", *POSITION, "heads", F.col("ts_ms").alias("ts"), F.posexplode("texts").alias("place", "v")).where(F.col("v").isNotNull())
    return each.select(
        "layer", "tag", "entity", F.get("heads", F.col("place")).alias("slot"), "origin", "partition",
        F.floor(F.col("offset") / F.lit(run_length)).alias("run"), F.struct("offset", "pos", "place").alias("at"), "ts", "v")


_RUN = [*COUNTER, "origin", "partition", "run"]


def _runs(rows: DataFrame, app: App, run_length: int) -> DataFrame:
    """One row per counter and run, staged: its readings in order and its effect."""
    grouped = _readings(rows, app, run_length).groupBy(*_RUN).agg(F.array_sort(F.collect_list(F.struct("at", "ts", "v"))).alias("readings"))
    return staged(grouped.withColumn("effect", run_effect(F.col("readings"), app.normalize.cutoff_ms)), "arrival-runs")


def _scanned(parts: DataFrame, by: list[str], order: list[str], start: Column) -> DataFrame:
    """Stretches of a group in order, each with what is held when it begins, and ``last`` with what is held after all."""
    def go(state: Column, item: Column) -> Column:
        one = F.struct(*[item[name].alias(name) for name in order], state["held"].alias("start"))
        return F.struct(after(item["effect"], state["held"]).cast(HELD).alias("held"), F.concat(state["out"], F.array(one)).alias("out"))

    types = dict(parts.dtypes)
    out = "array<struct<" + ",".join(f"{name}:{types[name]}" for name in order) + f",start:{HELD}>>"
    state = f"struct<held:{HELD},out:{out}>"
    # Sorted by place: no two stretches of a group share it, so effects are never compared.
    items = parts.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*order, "effect"))).alias("items"), F.first("start", ignorenulls=True).alias("start"))
    walked = F.aggregate("items", F.struct(start.cast(HELD).alias("held"), F.array().cast(out).alias("out")).cast(state), lambda s, i: go(s, i).cast(state))
    return items.select(*by, walked.alias("walked"))


def _starts(runs: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """What is held when each run begins (``_RUN``, start), and after all history (``COUNTER``, held)."""
    none = F.lit(None).cast(HELD)
    part = [*COUNTER, "origin", "partition"]
    low, high = runs.agg(F.min("run"), F.max("run")).first()
    levels = [runs.select(*_RUN, "effect")]
    while low is not None and high - low >= fan:
        # Stretches of stretches, side by side in the numbering of runs.
        grouped = levels[-1].groupBy(*part, F.floor(F.col("run") / F.lit(fan)).alias("run")).agg(F.sort_array(F.collect_list(F.struct("run", "effect"))).alias("items"))
        levels.append(staged(grouped.select(*_RUN, F.aggregate("items", nothing(), lambda e, i: then(e, i["effect"]).cast(EFFECT)).alias("effect")), "arrival-stretches"))
        low, high = low // fan, high // fan
    top = _scanned(levels[-1].withColumn("start", none), COUNTER, ["origin", "partition", "run"], F.col("start"))
    starts = top.select(*COUNTER, F.explode("walked.out").alias("one")).select(*COUNTER, "one.*")
    for level in reversed(levels[:-1]):
        above = starts.withColumnRenamed("run", "stretch")
        inside = level.withColumn("stretch", F.floor(F.col("run") / F.lit(fan))).join(above, [*part, "stretch"])
        starts = _scanned(inside, [*part, "stretch"], ["run"], F.col("start")).select(*part, F.explode("walked.out").alias("one")).select(*part, "one.*")
    return starts, top.select(*COUNTER, F.col("walked.held").alias("held"))


def _beyond(late: Column, early: Column, cutoff_ms: int) -> Column:
    """Whether two times, in order, are more than the cutoff apart; a distance that no BIGINT holds is."""
    return F.coalesce(F.try_subtract(late, early) > cutoff_ms, F.lit(True))


def _cuts(cutoff_ms: int) -> Column:
    """Places (from 0) of the readings of a run that make the held one be forgotten."""
    readings, start = F.col("readings"), F.col("start")
    state = "struct<held:bigint,at:int,cuts:array<int>>"

    def go(s: Column, r: Column) -> Column:
        late = s["held"] > r["ts"]
        cut = late & _beyond(s["held"], r["ts"], cutoff_ms)
        held = F.when(F.coalesce(cut, F.lit(False)), F.lit(None)).when(F.coalesce(late, F.lit(False)), s["held"]).otherwise(r["ts"])
        return F.struct(
            held.cast("bigint").alias("held"), (s["at"] + 1).alias("at"),
            F.when(F.coalesce(cut, F.lit(False)), F.concat(s["cuts"], F.array(s["at"]))).otherwise(s["cuts"]).alias("cuts")).cast(state)

    none = F.array().cast("array<int>")
    times = F.transform(readings, lambda r: r["ts"])
    # Most runs have none, as no reading of theirs is that far behind another.
    spread = _beyond(F.greatest(F.array_max(times), start["ts"]), F.array_min(times), cutoff_ms)
    walked = F.aggregate(readings, F.struct(start["ts"].alias("held"), F.lit(0).alias("at"), none.alias("cuts")).cast(state), go, lambda s: s["cuts"])
    return F.when(spread, walked).otherwise(none)


def _pieces(runs: DataFrame, starts: DataFrame, cutoff_ms: int) -> DataFrame:
    """Readings with ``piece``, the number of cuts before them in their run, and ``start`` in the first piece."""
    met = runs.drop("effect").join(starts, _RUN).withColumn("cuts", _cuts(cutoff_ms))
    ends = F.concat(F.transform("cuts", lambda c: c + 1), F.array(F.size("readings")))
    begins = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c + 1))
    pieces = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda cut: F.slice(F.col("readings"), cut["a"] + 1, cut["b"] - cut["a"]))
    split = met.select(*_RUN, "start", F.posexplode(pieces).alias("piece", "own"))
    return split.select(*_RUN, "piece", F.when(F.col("piece") == 0, F.col("start")).alias("start"), F.explode("own").alias("r")).select(
        *_RUN, "piece", "start", "r.*")


def normalize_arrival(rows: DataFrame, app: App, run_length: int = RUN_LENGTH, fan: int = FAN) -> DataFrame:
    """Add ``d<n>`` (ARRAY<BIGINT>) per layer in order of position. A run spans ``run_length`` offsets; a task holds the readings
    of one counter in one run at most, times and texts."""
    if not C.layers(app):
        return rows
    runs = _runs(rows, app, run_length)
    starts, _ = _starts(runs, fan)
    each = _pieces(runs, starts, app.normalize.cutoff_ms)
    past = Window.partitionBy(*_RUN, "piece").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # Of equal times the later one is held.
    inside = F.max(F.struct("ts", "at", "v")).over(past)
    known = each.withColumn("inside", inside).withColumn("before", F.when(
        F.col("inside").isNull() | (F.col("start.ts") > F.col("inside.ts")), F.col("start")).otherwise(F.struct("inside.ts", "inside.v").cast(HELD)))
    kinds = C._choose(app, lambda counters: F.array(*[F.lit(c.kind) for c in counters]), F.lit(None).cast("array<string>"))
    late = F.col("before.ts") > F.col("ts")
    value = F.when(~F.coalesce(late, F.lit(False)), C.delta(F.get(kinds, F.col("at.place")), F.col("v"), F.col("ts"), F.col("before"), app.normalize))
    found = known.select("origin", "partition", "at.offset", "at.pos", "tag", "layer", "at.place", value.alias("delta"))
    places = range(max(layer.width for layer in C.layers(app)))
    deltas = found.groupBy(*POSITION, "tag", "layer").agg(
        F.array(*[F.max(F.when(F.col("place") == p, F.col("delta"))) for p in places]).alias("deltas"))
    return C.widened(rows, deltas, app)


def last_readings(rows: DataFrame, app: App, run_length: int = RUN_LENGTH, fan: int = FAN) -> DataFrame:
    """What is held after all of ``rows`` (flat rows with their counters read): layer, tag, entity, name (constants of the key),
    value and time, one row per counter that holds something. A stream may start with them."""
    _, held = _starts(_runs(rows, app, run_length), fan)
    names = C._choose(app, lambda counters: F.array(*[F.lit(c.slot_name) for c in counters]), F.lit(None).cast("array<string>"))
    return held.where(F.col("held").isNotNull()).select(
        "layer", "tag", "entity", F.get(names, F.col("slot")).alias("name"), F.col("held.v").alias("value"), F.col("held.ts").alias("time"))
