"""Scalar functions of transforms. Inputs and outputs are VARIANT columns unless the name says otherwise.

Every function gives NULL where it has no result, so ``put`` leaves the old value in place.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pulsegrain.functions import variants as V

# Forms of time text. An instant needs seconds and a zone.
_INSTANT = r"^[+-]?\d{4,6}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?(Z|[+-]\d{2}:\d{2}(:\d{2})?)$"
_WHOLE = r"^[+-]?[0-9]+$"


def parse_text(value: Column) -> Column:
    """Any JSON text to VARIANT, comments allowed, integers of any length; NULL if it is no JSON."""
    return F.from_json(V.marked_json(value), "variant", {"allowComments": "true", "mode": "PERMISSIVE"})


def _decode_one(value: Column) -> Column:
    return F.when(
        V.scalar_kind(value) == "STRING",
        F.coalesce(parse_text(F.trim(V.text(value))), value),
    ).otherwise(value)


def decode_json(value: Column) -> Column:
    """JSON held as text becomes the document it spells; in a list each item does. Bad text stays text."""
    return V.let(
        value,
        lambda found: F.when(V.is_list(found), V.variant(F.transform(V.elements(found), _decode_one))).otherwise(
            _decode_one(found)
        ),
    )


def _each(value: Column, change) -> Column:
    """Apply to a scalar, or to each item of a list; an item without result stays as it was."""
    return F.when(
        V.is_list(value),
        V.variant(F.transform(V.elements(value), lambda item: F.coalesce(V.variant(change(item)), item))),
    ).otherwise(V.variant(change(value)))


def whole_text(digits: Column) -> Column:
    """Integer text of any length in one form, without plus and leading zeros; NULL for anything else."""
    bare = F.regexp_replace(digits, r"^([+-]?)0*([0-9]+)$", "$1$2")
    # Most texts have that form already and fit 64 bits, which takes no pattern to tell.
    return F.when(digits.try_cast("bigint").cast("string") == digits, digits).when(
        digits.rlike(_WHOLE), F.when(bare == "-0", "0").otherwise(F.ltrim(bare, F.lit("+"))))


def whole(value: Column) -> Column:
    """``whole_text`` of an integer or integer text in a VARIANT."""
    return whole_text(V.text(value))


def number(value: Column) -> Column:
    """DOUBLE of a number or of number text."""
    return V.text(value).try_cast("double")


def as_long(value: Column) -> Column:
    """BIGINT of a number or number text, cut toward zero; NULL if it does not fit."""
    return F.coalesce(
        V.text(value).try_cast("bigint"),
        F.when(V.scalar_kind(value) != "BOOLEAN", number(value).try_cast("bigint")),
    )


def to_long(value: Column) -> Column:
    return _each(value, as_long)


def to_integer(value: Column) -> Column:
    return _each(value, lambda item: as_long(item).try_cast("int"))


def to_double(value: Column) -> Column:
    return _each(value, number)


def to_boolean(value: Column) -> Column:
    return _each(value, lambda item: V.text(item).try_cast("boolean"))


def to_text(value: Column) -> Column:
    return V.variant(V.text(value))


def multiply(a: Column, b: Column) -> Column:
    """Product of two numbers cut to BIGINT; NULL if it does not fit 64 bits."""
    return F.try_multiply(as_long(a), as_long(b))


def divide(a: Column, b: Column) -> Column:
    """Floating quotient; NULL for a zero divisor."""
    return F.try_divide(number(a), number(b))


def divide_and_round(digits: int, a: Column, b: Column) -> Column:
    return F.round(divide(a, b), digits)


def subtract(a: Column, b: Column) -> Column:
    return F.try_subtract(number(a), number(b))


def long_subtract(a: Column, b: Column) -> Column:
    return F.try_subtract(as_long(a), as_long(b))


def _numbers(items: Column) -> Column:
    return F.array_compact(F.transform(V.elements(items), number))


def _longs(items: Column) -> Column:
    return F.array_compact(F.transform(V.elements(items), as_long))


def double_sum(items: Column) -> Column:
    return F.aggregate(_numbers(items), F.lit(0.0), lambda total, item: total + item)


def long_sum(items: Column) -> Column:
    """Sum of the integers of a list; NULL if it leaves 64 bits."""
    return F.aggregate(_longs(items), F.lit(0).cast("bigint"), F.try_add)


def average(items: Column) -> Column:
    return F.try_divide(double_sum(items), F.size(_numbers(items)))


def largest(items: Column) -> Column:
    return F.array_max(_numbers(items))


def smallest(items: Column) -> Column:
    return F.array_min(_numbers(items))


def absolute(value: Column) -> Column:
    """The smallest BIGINT has no positive twin of its kind; its absolute value is a DOUBLE."""
    def one_of(item: Column) -> Column:
        whole = as_long(item)
        positive = F.when(whole >= 0, whole).otherwise(F.try_subtract(F.lit(0).cast("bigint"), whole))
        return F.coalesce(V.variant(positive), V.variant(F.abs(number(item))))

    return _each(value, one_of)


def to_lower(value: Column) -> Column:
    return _each(value, lambda item: F.lower(V.text(item)))


def to_upper(value: Column) -> Column:
    return _each(value, lambda item: F.upper(V.text(item)))


def trim(value: Column) -> Column:
    return _each(value, lambda item: F.trim(V.text(item)))


def substring(value: Column, start: int, end: int) -> Column:
    """Characters from ``start`` up to, not with, ``end``; NULL where the range leaves the text."""
    whole_text = V.text(value)
    fits = (F.lit(0 <= start < end)) & (F.length(whole_text) >= end)
    return F.when(fits, F.substring(whole_text, start + 1, end - start))


def left_pad(value: Column, length: int, filler: str) -> Column:
    content = V.text(value)
    return F.when(F.length(content) < length, F.lpad(content, length, filler)).otherwise(content)


def right_pad(value: Column, length: int, filler: str) -> Column:
    content = V.text(value)
    return F.when(F.length(content) < length, F.rpad(content, length, filler)).otherwise(content)


def _texts(items: Column) -> Column:
    return F.transform(V.elements(items), lambda item: V.text(item))


def join(separator: str, items: Column) -> Column:
    """Texts of a list put together; nulls are skipped. A scalar stays alone."""
    return F.coalesce(F.array_join(_texts(items), separator), V.text(items))


def concat(*values: Column) -> Column:
    return F.concat_ws("", *[V.text(value) for value in values])


def split(pattern: str, value: Column) -> Column:
    """Parts of a text between matches of a pattern, as ARRAY<STRING>."""
    return F.split(V.text(value), pattern)


def size(items: Column) -> Column:
    return F.coalesce(F.size(V.elements(items)), F.size(V.fields(items)), F.length(V.text(items)))


def first_element(items: Column) -> Column:
    return F.try_element_at(V.elements(items), F.lit(1))


def last_element(items: Column) -> Column:
    return F.try_element_at(V.elements(items), F.lit(-1))


def element_at(items: Column, index: int) -> Column:
    """Item at a zero-based index."""
    return F.try_element_at(V.elements(items), F.lit(index + 1))


def to_list(value: Column) -> Column:
    """A list stays; anything else becomes a list of one."""
    return F.when(V.is_list(value), value).otherwise(V.variant(F.array(value)))


def one(value: Column) -> Column:
    """The first item of a list; a scalar stays."""
    return F.when(V.is_list(value), first_element(value)).otherwise(value)


def gather(*values: Column) -> Column:
    """Several sources to one target: the values present in order as a list, a lone one as it is."""
    return V.let(
        F.array_compact(F.array(*values)),
        lambda present: F.when(F.size(present) == 1, F.get(present, F.lit(0))).when(
            F.size(present) > 1, V.variant(present)
        ),
    )


def squash_nulls(items: Column) -> Column:
    return V.variant(F.filter(V.elements(items), V.has_value))


def squash_duplicates(items: Column) -> Column:
    """Items of a list without repeats, first ones kept; equality is that of their JSON text."""
    def distinct(pair: Column) -> Column:
        return F.filter(pair["items"], lambda item, at: F.array_position(pair["texts"], F.get(pair["texts"], at)) == at + 1)

    texts = F.transform(V.elements(items), lambda item: F.coalesce(F.to_json(item), F.lit("")))
    return V.variant(V.let(F.struct(V.elements(items).alias("items"), texts.alias("texts")), distinct))


def sort_list(items: Column) -> Column:
    """Numbers in numeric order; a list with other items in the order of their texts. Items stay as they are."""
    def order(found: Column) -> Column:
        numeric = F.forall(found, lambda item: number(item).isNotNull())
        keys = F.transform(found, lambda item, at: F.struct(
            F.when(numeric, number(item)).alias("number"), V.text(item).alias("text"), at.alias("at")))
        by_key = F.array_sort(keys, lambda a, b: _compared(a, b))
        return F.transform(by_key, lambda key: F.get(found, key["at"]))

    return V.variant(V.let(V.elements(items), order))


def _compared(a: Column, b: Column) -> Column:
    """-1, 0 or 1 by number, text and place; an item without text comes last."""
    def by(name: str, otherwise: Column) -> Column:
        x, y = a[name], b[name]
        return F.when(x.isNull() & y.isNull(), otherwise).when(x.isNull(), F.lit(1)).when(y.isNull(), F.lit(-1)).when(
            x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(otherwise)

    return by("number", by("text", by("at", F.lit(0))))


def is_null(value: Column) -> Column:
    return ~V.has_value(value)


def not_null(value: Column) -> Column:
    return V.has_value(value)


def rename_values(value: Column, names: dict[str, str]) -> Column:
    """Replace listed texts; any other value keeps its own text."""
    content = V.text(value)
    table = F.map_from_arrays(F.array(*[F.lit(name) for name in names]), F.array(*[F.lit(name) for name in names.values()]))
    return F.coalesce(F.try_element_at(table, content), content)


def instant_micros(content: Column) -> Column:
    """Microseconds since the epoch of ISO-8601 text with a zone; NULL without one."""
    upper = F.upper(content)
    return F.when(upper.rlike(_INSTANT), F.unix_micros(upper.try_cast("timestamp")))


def iso_to_epoch(value: Column) -> Column:
    """ISO-8601 instant to text ``seconds.micros`` with six digits."""
    micros = F.when(V.scalar_kind(value) == "STRING", instant_micros(V.text(value)))
    seconds = F.floor(micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("bigint")
    return F.when(micros.isNotNull(), F.format_string("%d.%06d", seconds, F.pmod(micros, F.lit(1_000_000))))


def setting(spark: SparkSession, name: str) -> Column:
    """A named constant of the deployment from the session settings; JSON null if unset."""
    value = spark.conf.get(name, None)
    return V.json_null() if value is None else V.variant(F.lit(value))
