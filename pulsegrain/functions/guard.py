"""Expressions that may raise, kept from ending the job."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Functions that fill one map builder for all rows of a task. If an entry raises, those before it stay in the builder and
# spoil the rows that follow. ``map_from_arrays`` takes entries that are computed already; a map of texts (options) cannot raise.
_BUILDERS = re.compile(r"\b(map|map_concat|map_from_entries|transform_keys|str_to_map)\((?!'[^']*'(?:, '[^']*')*\))")


class BadExpression(ValueError):
    """An expression that cannot be kept from spoiling other rows when it raises."""


def attempt(value: Column, needed: Column) -> Column:
    """``value`` where ``needed`` is true; NULL elsewhere and for a row where evaluating it raises.

    Spark's own ``try_`` functions are built on the same expression, which SQL has no name for. Give it something that is never
    NULL by itself, and NULL tells that it raised. The condition is more than a filter: what stands in a branch is not computed
    ahead of it, so a part that occurs twice cannot raise outside. ``needed`` must depend on the row, or it is folded away.
    Python functions run in their own operator and are not covered. Map builders (``create_map`` and its like) are refused;
    use ``variants.row_of`` or ``map_from_arrays`` with names that differ.
    """
    builder = _BUILDERS.search(value._jc.toString())
    if builder is not None:
        raise BadExpression(f"{builder.group(1)}() keeps entries of a row that raises; use variants.row_of or map_from_arrays")
    jvm = SparkSession.active()._jvm
    expressions = jvm.org.apache.spark.sql.classic.ExpressionUtils
    guarded = jvm.org.apache.spark.sql.catalyst.expressions.TryEval(expressions.expression(value._jc))
    return F.when(needed, Column(expressions.column(guarded)))
