"""Reading and editing VARIANT documents through JSONPath-like text paths.

Only definite paths and ``[*]`` are accepted: ``$.a.b``, ``$['a:b'].c``, ``$.list[0]``, ``$.list[*].x``.

VARIANT holds integers of up to 38 digits. Longer ones are held as texts of their digits behind ``MARK``, wherever they stand in a
document, so they go through every transform like any other value. ``text`` reads the digits, ``plain_json`` writes the number.

VARIANT shows decimals without zeros at their end. Typed sources write doubles such as ``1234.0`` so that they are read as doubles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY = "[*]"

# A code point that Unicode keeps out of interchanged text.
MARK = "\ufdd0"

_LONG = r"-?+[1-9][0-9]{38,}+"
# Doubles are shown with all their digits, without an exponent, below ten million.
_ROUND = r"-?+[0-9]{1,7}+\.0++"


def _next(number: str) -> str:
    """The next value that is such a number, behind other tokens: words and signs, texts, comments, other numbers."""
    before = (
        r"""[^"0-9/-]++|"(?:[^"\\]++|\\.)*+"|//[^\n]*+|/\*(?:[^*]++|\*(?!/))*+\*/"""
        rf"""|(?!{number}(?![.0-9eE]))-?+[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"""
    )
    return rf"""(?s)\G((?:{before})*+)({number})(?=\s*+(?:[,\]}}/]|$))"""


def marked_json(value: Column) -> Column:
    """JSON text whose integers of more than 38 digits are marked texts; any other text as it is."""
    return F.when(value.rlike("[1-9][0-9]{38}"), F.regexp_replace(value, _next(_LONG), f'$1"{MARK}$2"')).otherwise(value)


def round_doubles(value: Column) -> Column:
    """JSON text whose numbers such as ``1234.0`` have an exponent, so that they are parsed as doubles and leave with their point."""
    held = value.rlike(r"[:\[,]-?[0-9]{1,7}\.0+[,\]}]")
    return F.when(held, F.regexp_replace(value, _next(_ROUND), "$1$2e0")).otherwise(value)


def plain_json(value: Column) -> Column:
    """JSON text whose marked integers are numbers again."""
    return F.when(value.contains(MARK), F.regexp_replace(value, f'"{MARK}({_LONG})"', "$1")).otherwise(value)

_STEP = re.compile(r"""\.([^.\[\]()?@*]+)|\['([^']*)'\]|\["([^"]*)"\]|\[(\d+)\]|\[(\*)\]""")


class BadPath(ValueError):
    """The path uses something other than names, indexes and ``[*]``."""


def steps(path: str) -> tuple[str | int, ...]:
    """Split a path into names (str), indexes (int) and ``ANY``."""
    if not path.startswith("$"):
        raise BadPath(f"path must start with '$': {path!r}")
    found: list[str | int] = []
    at = 1
    while at < len(path):
        hit = _STEP.match(path, at)
        if hit is None:
            raise BadPath(f"unsupported path {path!r} at position {at}")
        dotted, single, double, index, star = hit.groups()
        if star:
            found.append(ANY)
        elif index is not None:
            found.append(int(index))
        else:
            found.append(next(name for name in (dotted, single, double) if name is not None))
        at = hit.end()
    return tuple(found)


def render(parts: Sequence[str | int]) -> str:
    """Path text in the bracket form that VARIANT functions read, safe for ``:``, ``/`` and ``-``."""
    out = ["$"]
    for part in parts:
        if isinstance(part, int):
            out.append(f"[{part}]")
        elif "'" not in part:
            out.append(f"['{part}']")
        elif '"' not in part:
            out.append(f'["{part}"]')
        else:
            raise BadPath(f"a name with both kinds of quotes cannot be addressed: {part!r}")
    return "".join(out)


def _definite(path: str) -> str:
    parts = steps(path)
    if ANY in parts:
        raise BadPath(f"'[*]' is not allowed here: {path!r}")
    return render(parts)


def read(doc: Column, path: str, as_type: str) -> Column:
    """Value at ``path`` cast to ``as_type``; NULL if absent, JSON null or not castable."""
    return F.try_variant_get(doc, _definite(path), as_type)


def get(doc: Column, path: str) -> Column:
    """Sub-document at ``path``; SQL NULL if absent, a JSON null stays a JSON null."""
    return read(doc, path, "variant")


def text(doc: Column, path: str = "$") -> Column:
    return F.ltrim(read(doc, path, "string"), F.lit(MARK))


def elements(doc: Column, path: str = "$") -> Column:
    """The list at ``path`` as ARRAY<VARIANT>; NULL if it is not a list."""
    return read(doc, path, "array<variant>")


def fields(doc: Column, path: str = "$") -> Column:
    """The object at ``path`` as MAP<STRING, VARIANT>; NULL if it is not an object."""
    return read(doc, path, "map<string,variant>")


def is_object(doc: Column, path: str = "$") -> Column:
    # An empty struct type asks for the kind only; nothing of the object is copied.
    return read(doc, path, "struct<>").isNotNull()


def is_list(doc: Column, path: str = "$") -> Column:
    return read(doc, path, "array<struct<>>").isNotNull()


def scalar_kind(doc: Column, path: str = "$") -> Column:
    """Kind name of a scalar (STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID); NULL for the rest."""
    return F.when(~is_object(doc, path) & ~is_list(doc, path), F.schema_of_variant(get(doc, path)))


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build`` over a value that is computed once, however often ``build`` uses it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


@dataclass(frozen=True)
class Place:
    """A place inside a document. Going down costs nothing: only the value finally read is copied out."""

    base: Column
    parts: tuple[str | int, ...] = ()

    def at(self, *parts: str | int) -> Place:
        return Place(self.base, self.parts + parts)

    def read(self, as_type: str) -> Column:
        return F.try_variant_get(self.base, render(self.parts), as_type)

    @property
    def value(self) -> Column:
        return self.read("variant")

    @property
    def text(self) -> Column:
        return F.ltrim(self.read("string"), F.lit(MARK))

    @property
    def items(self) -> Column:
        return F.coalesce(self.read("array<variant>"), F.array().cast("array<variant>"))

    @property
    def is_object(self) -> Column:
        return self.read("struct<>").isNotNull()

    def copy(self, names: Mapping[str, str]) -> dict[str, Column]:
        """Columns for source name → target name."""
        return {target: self.at(source).value for source, target in names.items()}


def has_value(value: Column) -> Column:
    """Neither absent nor JSON null; never NULL itself."""
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))


def variant(value: Column) -> Column:
    return value.cast("variant")


def json_null() -> Column:
    return F.parse_json(F.lit("null"))


def spread(doc: Column, parts: Sequence[str | int]) -> Column:
    """All sub-documents under ``parts`` as ARRAY<VARIANT>, going through every ``[*]``."""
    if ANY not in parts:
        return F.array_compact(F.array(F.try_variant_get(doc, render(parts), "variant")))
    star = list(parts).index(ANY)
    head, tail = render(parts[:star]), parts[star + 1:]
    children = F.coalesce(
        F.try_variant_get(doc, head, "array<variant>"),
        F.map_values(F.try_variant_get(doc, head, "map<string,variant>")),
        F.array().cast("array<variant>"),
    )
    if not tail:
        return children
    return F.flatten(F.transform(children, lambda child: spread(child, tail)))


def named(values: Mapping[str, Column]) -> Column:
    """MAP<STRING, VARIANT>. All values are computed before the map is begun, so one that raises leaves nothing behind."""
    names = F.array(*[F.lit(name) for name in values]).cast("array<string>")
    return F.map_from_arrays(names, F.array(*[variant(value) for value in values.values()]).cast("array<variant>"))


def _apart(names: Sequence[str]) -> bool:
    """Whether names differ by more than case, so that they may be fields of one struct."""
    return len({name.lower() for name in names}) == len(names)


#: Rows of up to so many fields mostly have them all; wider ones have holes.
FEW = 8


def row_of(targets: Mapping[str, Column]) -> Column:
    """One object with the given fields; a field whose column is NULL is left out. A row of few fields needs no map if it has them all."""
    def present(fields: Mapping[str, Column]) -> Column:
        return F.to_variant_object(F.map_filter(named(fields), lambda _, value: value.isNotNull()))

    if not 0 < len(targets) <= FEW or not _apart(list(targets)):
        return present(targets)

    def built(held: Column) -> Column:
        full = reduce(lambda a, b: a & b, [held[name].isNotNull() for name in targets])
        return F.when(full, F.to_variant_object(held)).otherwise(present({name: held[name] for name in targets}))

    return let(F.struct(*[variant(value).alias(name) for name, value in targets.items()]), built)


def _struct(paths: Mapping[tuple[str, ...], str]) -> str | None:
    """Type of a struct with all paths of names; None where one ends inside another or names differ by case alone."""
    below: dict[str, dict[tuple[str, ...], str]] = {}
    for parts, kind in paths.items():
        below.setdefault(parts[0], {})[parts[1:]] = kind
    if not _apart(list(below)):
        return None
    fields = []
    for name, inner in below.items():
        if () in inner and len(inner) > 1:
            return None
        kind = inner[()] if () in inner else _struct(inner)
        if kind is None:
            return None
        fields.append("`" + name.replace("`", "``") + "`:" + kind)
    return f"struct<{','.join(fields)}>"


def together(doc: Column, paths: Mapping[tuple[str | int, ...], str], build: Callable[[Callable[..., Column]], Column]) -> Column:
    """``build`` over the values at ``paths`` (parts → type), read in one pass over the document instead of one per path.

    ``build`` gets a function from parts to the value there; the parts of an object on the way give NULL where there is none."""
    kind = _struct(paths) if paths and all(parts and all(isinstance(part, str) for part in parts) for parts in paths) else None
    if kind is None:
        return build(lambda *parts: F.try_variant_get(doc, render(parts), paths.get(parts, "struct<>")))
    return let(F.try_variant_get(doc, "$", kind), lambda held: build(lambda *parts: reduce(lambda part, name: part[name], parts, held)))


def pick(doc: Column, names: Sequence[str]) -> Column:
    """Keep only the named top-level fields; absent ones stay absent."""
    keep = [F.lit(name) for name in names]
    return F.to_variant_object(F.map_filter(fields(doc), lambda name, _: name.isin(*keep)))


def drop(doc: Column, *names: str) -> Column:
    """Remove top-level fields."""
    return F.to_variant_object(F.map_filter(fields(doc), lambda name, _: ~name.isin(*names)))


def rename(doc: Column, names: Mapping[str, str]) -> Column:
    """Rename top-level fields and keep all others as they are; values that meet under one name become a list."""
    table = F.map_from_arrays(F.array(*[F.lit(name) for name in names]), F.array(*[F.lit(name) for name in names.values()]))
    entries = F.transform(F.map_entries(fields(doc)), lambda entry: F.struct(
        F.coalesce(F.try_element_at(table, entry["key"]), entry["key"]).alias("key"), entry["value"].alias("value")))
    return let(entries, gathered)


def put(doc: Column, values: Mapping[str, Column], keep: Sequence[str] | None = None) -> Column:
    """Write top-level fields; where the new value is NULL the field stays as it was. With ``keep`` only the fields named there stay."""
    merged = F.map_zip_with(fields(doc), named(values), lambda _, old, new: F.coalesce(new, old))
    kept = [] if keep is None else [F.lit(name) for name in keep]
    return F.to_variant_object(F.map_filter(merged, lambda name, value: value.isNotNull() if keep is None else name.isin(*kept) & value.isNotNull()))


def put_paths(doc: Column, values: Mapping[Sequence[str], Column]) -> Column:
    """``put`` for name paths: nested objects are edited once per parent; missing parents stay missing."""
    here: dict[str, Column] = {}
    below: dict[str, dict[Sequence[str], Column]] = {}
    for parts, value in values.items():
        if len(parts) == 1:
            here[parts[0]] = value
        else:
            below.setdefault(parts[0], {})[tuple(parts[1:])] = value
    for name, inner in below.items():
        child = F.try_variant_get(doc, render([name]), "variant")
        here[name] = F.when(is_object(child), put_paths(child, inner))
    return put(doc, here)


def put_default(doc: Column, values: Mapping[str, Column], over_null: bool = False) -> Column:
    """Write fields only where absent, or also where JSON null if ``over_null``."""
    wanted = {}
    for name, value in values.items():
        now = F.try_variant_get(doc, render([name]), "variant")
        wanted[name] = F.when(~has_value(now) if over_null else now.isNull(), variant(value))
    return put(doc, wanted)


def gathered(entries: Column) -> Column:
    """Entries (key, value) to one object; a repeated name collects its values in a list."""
    def value_of(name: Column) -> Column:
        found = F.transform(F.filter(entries, lambda entry: entry["key"] == name), lambda entry: entry["value"])
        return let(found, lambda values: F.when(F.size(values) == 1, values[0]).otherwise(variant(values)))

    names = F.array_distinct(F.transform(entries, lambda entry: entry["key"]))
    return F.to_variant_object(F.map_from_arrays(names, F.transform(names, value_of)))


def merge_objects(items: Column) -> Column:
    """List of objects to one object; a repeated name collects its values in a list. Items that are no objects add nothing."""
    none = F.array().cast("array<struct<key:string,value:variant>>")
    entries = F.flatten(F.transform(items, lambda item: F.coalesce(F.map_entries(fields(item)), none)))
    return let(entries, gathered)
