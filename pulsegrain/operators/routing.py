"""Gate, whitelist, and the fan-out of one document to every pipeline that matches it.

All pipelines are evaluated in one projection and one generate, so the source is read and parsed once
however many pipelines there are, in batches and in streams.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.functions.guard import attempt
from pulsegrain.operators import documents as D
from pulsegrain.operators.predicates import predicate
from pulsegrain.operators.reshape import Layouts
from pulsegrain.specs import App, Pipeline

_ROUTE = "array<struct<tag:string,step:string,error:string,row:variant,layout:int,parent:variant,element:variant>>"


def gate(doc: Column, condition: Column) -> Column:
    """The document if it passes, else NULL, which drops it without trace."""
    return F.when(condition, doc)


def whitelist(doc: Column, names: Sequence[str]) -> Column:
    return V.pick(doc, names)


def _entry(tag: Column | None = None, *, step=None, error=None, row=None, element: Column | None = None) -> Column:
    """One row to come: a finished row, an element to build one from, or an error."""
    layout, parent, value = (None,) * 3 if element is None else (element["layout"], element["parent"], element["element"])
    fields = {
        "tag": (tag, "string"), "step": (step, "string"), "error": (error, "string"), "row": (row, "variant"),
        "layout": (layout, "int"), "parent": (parent, "variant"), "element": (value, "variant"),
    }
    return F.struct(*[(F.lit(None) if part is None else part).cast(kind).alias(name) for name, (part, kind) in fields.items()])


RAISED = "an expression raised an error"


def _entries(pipeline: Pipeline, doc: Column, elements: Column | None) -> Column:
    """The rows of a document that matches; its message instead, if the check or the transform refuses it."""
    tag = F.lit(pipeline.tag)
    if pipeline.transform is None:
        return F.array(_entry(tag, row=doc))
    if isinstance(pipeline.transform, Layouts):
        return F.transform(elements, lambda element: _entry(tag, element=element))
    return F.transform(F.filter(pipeline.transform(doc), V.has_value), lambda row: _entry(tag, row=row))


def _rows(pipeline: Pipeline, doc: Column, half: Column | None) -> Column:
    """As ``_entries``; a transform or check that raises sends the document to the dead letters as well."""
    tag, empty = F.lit(pipeline.tag), F.array().cast(_ROUTE)

    def refused(message: Column) -> Column:
        return F.array(_entry(tag, step=F.lit(D.TRANSFORM), error=message, row=doc)).cast(_ROUTE)

    rows = F.coalesce(_entries(pipeline, doc, None if half is None else half["elements"]), empty)
    if pipeline.check is not None:
        message = pipeline.check(doc).cast("string")
        rows = F.when(message.isNotNull(), refused(message)).otherwise(rows)
    if pipeline.transform is None and pipeline.check is None:
        return rows
    found = F.coalesce(attempt(rows, doc.isNotNull()), refused(F.lit(RAISED)))
    return found if half is None else F.when(half.isNull(), refused(F.lit(RAISED))).otherwise(found)


def pre_transform(parsed: DataFrame, app: App) -> DataFrame:
    """Check and change documents; ``dropped`` marks those that the change made vanish, ``failed_at`` the step of an error.

    A check or change that raises is an error of its document."""
    doc, good = F.col("doc"), F.col("error").isNull()
    if app.pre_check is None and app.pre_transform is None:
        return parsed.withColumn("failed_at", F.when(~good, D.PARSE)).withColumn("dropped", F.lit(False))
    message = F.lit(None).cast("string") if app.pre_check is None else app.pre_check(doc).cast("string")
    changed = doc if app.pre_transform is None else F.when(message.isNull(), app.pre_transform(doc))
    tried = parsed.withColumn("_tried", attempt(F.struct(message.alias("message"), changed.cast("variant").alias("doc")), good))
    failed = F.when(~good, F.col("error")).when(F.col("_tried").isNull(), RAISED).otherwise(F.col("_tried.message"))
    kept = F.when(good & failed.isNull(), F.col("_tried.doc")).otherwise(doc)
    return tried.select(
        *[name for name in parsed.columns if name not in ("doc", "error")], kept.alias("doc"), failed.alias("error"),
        F.when(~good, D.PARSE).when(failed.isNotNull(), D.PRE_TRANSFORM).alias("failed_at"), (failed.isNull() & kept.isNull()).alias("dropped"))


def _as_struct(shared: dict[str, Column] | Column) -> Column:
    return shared if isinstance(shared, Column) else F.struct(*[value.alias(name) for name, value in shared.items()])


def route(parsed: DataFrame, app: App) -> DataFrame:
    """One output row per message, matching pipeline and transformed row.

    Columns: the envelope, ``pos`` (place of the row within its message), ``tag`` (NULL if nothing matched), ``row``
    (VARIANT), and ``step``/``error`` for dead letters. A document whose transform raises has one row, its dead letter; of
    a ``Layouts`` transform, whose rows are built one by one, a row that raises leaves its element as the dead letter.
    """
    doc = F.col("doc")
    flags = [f"_match{number}" for number in range(len(app.pipelines))]
    ready = F.col("error").isNull() & ~F.col("dropped")
    staged = parsed.select(
        *D.ENVELOPE, "value", "doc", "error", "failed_at", "dropped",
        *[
            (ready & predicate(pipeline.match, doc)).alias(flag)
            for flag, pipeline in zip(flags, app.pipelines)
        ],
    )
    empty = F.array().cast(_ROUTE)
    # Pipelines in two halves: what their rows share goes with the fan-out, and rows are built after it.
    late = [(number, pipeline) for number, pipeline in enumerate(app.pipelines) if isinstance(pipeline.transform, Layouts)]
    staged = staged.select("*", *[
        attempt(F.struct(
            _as_struct(pipeline.transform.shared(doc)).alias("shared"),
            pipeline.transform.pick(doc).alias("elements"),
        ), F.col(flags[number])).alias(f"_half{number}")
        for number, pipeline in late
    ])
    halves = {number: F.col(f"_half{number}") for number, _ in late}
    branches = [
        F.when(F.col(flag), _rows(pipeline, doc, halves.get(number)))
        for number, (flag, pipeline) in enumerate(zip(flags, app.pipelines))
    ]
    matched = F.lit(False)
    for flag in flags:
        matched = matched | F.col(flag)
    rest = (
        F.when(F.col("error").isNotNull(), F.array(_entry(step=F.col("failed_at"), error=F.col("error"), row=doc)))
        .when(ready & ~matched, F.array(_entry(row=doc)))
    )
    routes = F.flatten(F.array(*[F.coalesce(branch, empty) for branch in [*branches, rest]]))
    row = F.struct(F.col("route.row").alias("row"))
    for number, pipeline in late:
        for layout, build in enumerate(pipeline.transform.builds):
            mine = (F.col("route.tag") == F.lit(pipeline.tag)) & (F.col("route.layout") == F.lit(layout))
            built = F.struct(build(F.col(f"_shared{number}"), F.col("route.parent"), F.col("route.element")).cast("variant").alias("row"))
            row = F.when(mine, attempt(built, mine)).otherwise(row)
    # The outer form: a plain explode would make the optimiser evaluate the whole array a second time as a
    # "size > 0" filter. Empty arrays leave one row without route, dropped right after.
    fanned = (
        staged.select(
            *D.ENVELOPE,
            F.when(F.col("error").isNotNull(), F.col("value")).alias("raw"),
            *[halves[number]["shared"].alias(f"_shared{number}") for number, _ in late],
            F.posexplode_outer(routes).alias("pos", "route"),
        )
        .where(F.col("route").isNotNull())
    )
    if not late:
        return fanned.select(*D.ENVELOPE, "raw", "pos", "route.tag", "route.step", "route.error", "route.row")
    raised = F.col("built").isNull()
    return fanned.select(*D.ENVELOPE, "raw", "pos", "route", row.alias("built")).select(
        *D.ENVELOPE, "raw", "pos", "route.tag",
        F.when(raised, D.TRANSFORM).otherwise(F.col("route.step")).alias("step"),
        F.when(raised, RAISED).otherwise(F.col("route.error")).alias("error"),
        F.when(raised, F.col("route.element")).otherwise(F.col("built.row")).alias("row"),
    )


def topic_of(tag: Column, app: App) -> Column:
    """Output topic of a tag; no tag means discard, an unknown one the dead letters."""
    found = F.when(tag.isNull(), F.lit(app.discard_topic))
    for name, topic in app.topics.items():
        found = found.when(tag == F.lit(name), F.lit(topic))
    return found.otherwise(F.lit(app.dlq_topic))
