"""Match declarations as boolean columns. A predicate is never NULL, so ``not`` is two-valued."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V
from pulsegrain.functions.scalars import parse_text
from pulsegrain.specs import BadSpec

_NUMBER_KIND = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"


def exists(doc: Column, path: str) -> Column:
    """A value is there and it is not an empty list; through ``[*]`` any hit counts."""
    parts = V.steps(path)
    if V.ANY in parts:
        return F.size(V.spread(doc, parts)) > 0
    value = V.get(doc, path)
    first = F.try_variant_get(doc, V.render(parts + (0,)), "variant")
    return V.has_value(value) & (first.isNotNull() | ~V.is_list(value))


def equals(doc: Column, path: str, literal: Any) -> Column:
    """The value at ``path`` equals the literal, kind included; numbers compare by value."""
    parts = V.steps(path)
    if isinstance(literal, (list, dict)):
        wanted = F.to_json(parse_text(F.lit(json.dumps(literal))))
        if V.ANY in parts:
            found = V.variant(V.spread(doc, parts))
        else:
            found = V.get(doc, path)
        return F.coalesce(F.to_json(found) == wanted, F.lit(False))
    if literal is None or V.ANY in parts:
        # JSON null counts as no value, and a list is never equal to a scalar.
        return F.lit(False)
    kind = F.schema_of_variant(V.get(doc, path))
    held = V.read(doc, path, "string")
    if isinstance(literal, bool):
        same = (V.read(doc, path, "boolean") == F.lit(literal)) & (kind == "BOOLEAN")
    elif isinstance(literal, str):
        same = (held == F.lit(literal)) & (kind == "STRING")
    elif isinstance(literal, int):
        if abs(literal) >= 10**38:
            return F.coalesce(held == F.lit(f"{V.MARK}{literal}"), F.lit(False))
        exact = F.lit(str(literal)).cast("decimal(38,0)")
        same = (
            (V.read(doc, path, "decimal(38,0)") == exact)
            & (V.read(doc, path, "double") == F.lit(float(literal)))
            & kind.rlike(_NUMBER_KIND)
        )
    else:
        same = (V.read(doc, path, "double") == F.lit(float(literal))) & kind.rlike(_NUMBER_KIND)
        if abs(literal) >= 1e38:
            same = F.when(held.startswith(V.MARK), V.text(doc, path).try_cast("double") == F.lit(float(literal))).otherwise(same)
    return F.coalesce(same, F.lit(False))


def _one_of(doc: Column, path: str, texts: list[str]) -> Column:
    """The value at ``path`` is one of the texts. Its kind is looked up for a hit alone."""
    found = F.coalesce(V.read(doc, path, "string").isin(*texts), F.lit(False))
    return F.when(found, F.schema_of_variant(V.get(doc, path)) == "STRING").otherwise(F.lit(False))


def _texts_by_path(matches) -> tuple[dict[str, list[str]], list]:
    """Declarations that compare a definite path with a text, by path, and all others."""
    texts: dict[str, list[str]] = {}
    others = []
    for match in matches:
        if match and "jsonpath" in match and isinstance(match.get("value"), str) and V.ANY not in V.steps(match["jsonpath"]):
            texts.setdefault(match["jsonpath"], []).append(match["value"])
        else:
            others.append(match)
    return texts, others


def predicate(match: Mapping[str, Any], doc: Column) -> Column:
    """Column for a match declaration; the first of jsonpath, and, or, constant, not decides."""
    if not match:
        return F.lit(True)
    if "jsonpath" in match:
        if "value" in match:
            return equals(doc, match["jsonpath"], match["value"])
        return exists(doc, match["jsonpath"])
    if "and" in match:
        return reduce(lambda a, b: a & b, [predicate(inner, doc) for inner in match["and"]], F.lit(True))
    if "or" in match:
        texts, others = _texts_by_path(match["or"])
        return reduce(lambda a, b: a | b, [
            *[_one_of(doc, path, found) for path, found in texts.items()], *[predicate(inner, doc) for inner in others]], F.lit(False))
    if "constant" in match:
        return F.lit(bool(match["constant"]))
    if "not" in match:
        return ~predicate(match["not"], doc)
    raise BadSpec(f"no match option among {', '.join(match)}")
