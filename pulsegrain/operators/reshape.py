"""Reshaping documents into rows. Everything here is a column expression over the document, so a transform adds no
stage and no shuffle; a parent's fields are simply in scope while its children are built."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions import scalars as S
from pulsegrain.functions import variants as V

NO_ROWS = "array<variant>"


def _none() -> Column:
    return F.array().cast(NO_ROWS)


def fan_out(doc: Column, path: str, build: Callable[..., Column]) -> Column:
    """One row per item of the list at ``path``; rows that come out NULL are left out.

    A ``build`` with two parameters also gets the zero-based place of the item.
    """
    rows = F.transform(F.coalesce(V.elements(doc, path), _none()), build)
    return F.array_compact(rows)


def fan_out_keys(doc: Column, path: str, build: Callable[[Column, Column], Column]) -> Column:
    """One row per entry of the object at ``path``; ``build`` gets name (STRING) and value."""
    entries = F.map_entries(V.fields(doc, path))
    rows = F.transform(entries, lambda entry: build(entry["key"], entry["value"]))
    return F.coalesce(F.array_compact(rows), _none())


def fan_out_nested(doc: Column, path: str, rows_of: Callable[..., Column]) -> Column:
    """The rows of all items in one list, where each item gives a list of rows itself; with places as in ``fan_out``."""
    nested = F.transform(F.coalesce(V.elements(doc, path), _none()), rows_of)
    return F.flatten(F.array_compact(nested))


def rows(*candidates: Column) -> Column:
    """The candidates that are there, as rows: parent and child of one element, for example."""
    return F.array_compact(F.array(*candidates))


def either(*branches: Column) -> Column:
    """Rows of several layouts one after another; a NULL branch has none."""
    return F.flatten(F.array(*[F.coalesce(branch, _none()) for branch in branches]))


def first_layout(*branches: Column) -> Column:
    """Rows of the first layout that has any."""
    if not branches:
        return _none()
    rest = first_layout(*branches[1:])
    return V.let(branches[0], lambda found: F.when(F.size(found) > 0, found).otherwise(rest))


@dataclass(frozen=True)
class Layouts:
    """A transform in two halves, for documents of many elements or layouts.

    ``pick`` maps the document to its raw elements (``element``), one for each row to come, and runs before the fan-out;
    nothing but sub-documents is copied there. ``builds`` hold one function per layout, (shared, parent, element) → row, and
    run after it, once per row in an ordinary projection. ``shared`` names what rows take from the whole document, as columns or
    as one struct; it is read once per document and is in scope as a struct while rows are built.
    """

    shared: Callable[[Column], dict[str, Column] | Column]
    pick: Callable[[Column], Column]
    builds: Sequence[Callable[[Column, Column, Column], Column]]


def element(layout: int, value: Column, parent: Column | None = None) -> Column:
    """An element of ``Layouts.pick``: the layout that builds its row, its sub-document and something of its parent's."""
    return F.struct(
        F.lit(layout).alias("layout"), (F.lit(None) if parent is None else parent).cast("variant").alias("parent"), value.cast("variant").alias("element"))


ELEMENTS = "array<struct<layout:int,parent:variant,element:variant>>"


def elements_of(*lists: Column) -> Column:
    """Lists of elements one after another; a NULL list has none."""
    return F.flatten(F.array(*[F.coalesce(one, F.array().cast(ELEMENTS)) for one in lists]))


def dispatch(value: Column, branches: dict[str, Column]) -> Column:
    """The branch named by a text; NULL for any other text."""
    chosen = F.lit(None)
    for name, branch in branches.items():
        chosen = F.when(value == F.lit(name), branch).otherwise(chosen)
    return chosen


def numbered(items: Column, build: Callable[[Column, Column], Column]) -> Column:
    """Drop null items, then number the survivors from zero."""
    return F.transform(F.filter(items, V.has_value), build)


def tokens(value: Column, separator: str = " ") -> Column:
    """ARRAY<STRING> of the non-empty parts of a text."""
    return F.filter(S.split(separator, value), lambda part: part != "")


def filter_values(place: V.Place, list_name: str, name: str) -> Column:
    """Values of ``filters.<name>`` over a list of path segments, as ARRAY<VARIANT>."""
    return F.array_compact(
        F.transform(place.at(list_name).items, lambda part: V.Place(part).at("filters", name).value)
    )


def decode_fields(doc: Column, *names: str) -> Column:
    """Replace JSON texts in the named fields by the documents they spell."""
    wanted = {name: V.Place(doc).at(name).value for name in names}
    some = F.coalesce(*wanted.values()).isNotNull()
    return F.when(some, V.put(doc, {name: S.decode_json(value) for name, value in wanted.items()})).otherwise(doc)


def explode_rows(df: DataFrame, rows_column: Column, *keep: str | Column, name: str = "row") -> DataFrame:
    """Lists of rows to DataFrame rows, with ``pos``; a document without rows gives none."""
    return df.select(*keep, F.posexplode_outer(rows_column).alias("pos", name)).where(F.col(name).isNotNull())
