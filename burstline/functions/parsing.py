"""Lenient and strict reading of event fields, as plain column expressions.

Text that is not a number leaves the field unset instead of failing the row. The guards are
there because a cast takes more than the wanted grammar does: it trims blanks around integers,
and reads ``inf`` and ``nan`` in any case. They look at no more of a text than they must, as
they run for every field of every row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.functions.calendar import out_of_range
from burstline.schema import FIELD_TYPES, NUMBER_ONLY_FIELDS, STRICT_LONG_FIELDS

# The names among numbers, as they may be written, and as a cast reads them.
NAMED_DOUBLE = r"^[\x00-\x20]*[+-]?(Infinity|NaN)[\x00-\x20]*$"
NAMED_DOUBLE_ANY_CASE = r"(?i)^[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*$"
# Fixed value: characters up to the space count as blank at the ends of a text.
BLANKS = "".join(chr(code) for code in range(33))
NOT_BLANK = r"[^\x00-\x20]"


def trim_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def not_blank(text: Column) -> Column:
    return text.rlike(NOT_BLANK)


def filled(text: Column) -> Column:
    """The trimmed text, or null when nothing is left of it."""
    return F.when(not_blank(text), trim_blanks(text))


def to_integer(text: Column, target: T.DataType) -> Column:
    """A sign and digits. The cast checks all but blanks at the ends."""
    starts = F.substring(text, 1, 1).between("+", "9")
    ends = F.substring(text, -1, 1).between("0", "9")
    return F.when(starts & ends, text.try_cast(target))


def to_double(text: Column) -> Column:
    """A decimal number, or a name in its own spelling."""
    number = text.try_cast(T.DoubleType())
    named = F.isnan(number) | (F.abs(number) == float("inf"))
    odd = named & text.rlike(NAMED_DOUBLE_ANY_CASE) & ~text.rlike(NAMED_DOUBLE)
    return F.when(~odd, number)


def to_boolean(text: Column) -> Column:
    return F.lower(text) == "true"


def parsed(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``source`` read as ``target``; null where it cannot be read."""
    if source == target:
        return value
    if isinstance(target, (T.LongType, T.IntegerType)):
        if isinstance(source, T.IntegralType):
            return value.try_cast(target)
        return to_integer(value.cast("string"), target)
    if isinstance(target, T.DoubleType):
        if isinstance(source, T.NumericType):
            return value.cast(target)
        return to_double(value.cast("string"))
    if isinstance(target, T.BooleanType):
        return to_boolean(value.cast("string"))
    return value.cast(target)


def _typed_fields(events: DataFrame) -> list[tuple[str, T.DataType, T.DataType]]:
    """Fields of the event record that this source has: name, source type, wanted type."""
    return [
        (field.name, field.dataType, FIELD_TYPES[field.name])
        for field in events.schema
        if field.name in FIELD_TYPES
    ]


def check_number_only(events: DataFrame) -> None:
    for name in NUMBER_ONLY_FIELDS:
        if name in events.columns:
            found = events.schema[name].dataType
            if not isinstance(found, (T.DoubleType, T.FloatType)):
                raise ValueError(f"{name} must be a double, found {found.simpleString()}")


def parse_fields(events: DataFrame, text_fields: tuple[str, ...] = ()) -> DataFrame:
    """Every known field in its type; ``text_fields`` besides them as text; other columns as they are."""
    check_number_only(events)
    changes = {
        name: parsed(F.col(name), source, target)
        for name, source, target in _typed_fields(events)
        if source != target
    }
    changes |= {name: F.col(name).cast("string") for name in text_fields}
    return events.withColumns(changes) if changes else events


def unreadable(events: DataFrame) -> Column:
    """Whether a strict field of a row cannot be read."""
    bad = [
        F.col(name).isNotNull() & parsed(F.col(name), source, target).isNull()
        for name, source, target in _typed_fields(events)
        if name in STRICT_LONG_FIELDS
    ]
    return reduce(lambda a, b: a | b, bad, F.lit(False))


def readable(events: DataFrame) -> DataFrame:
    """Rows whose strict fields can be read."""
    return events.where(~unreadable(events))


def quarantined(events: DataFrame) -> DataFrame:
    """Rows set aside because a strict field cannot be read."""
    return events.where(unreadable(events))


def _checks(events: DataFrame) -> list[tuple[str, Column, Column]]:
    """What can go wrong with a row: the field, whether its value cannot be read, and the value.

    ``eventtime.day`` is of times that were read but lie beyond the calendar, so that they have no day.
    """
    checks = []
    for name, source, target in _typed_fields(events):
        value = parsed(F.col(name), source, target)
        if not isinstance(target, (T.BooleanType, T.StringType)):
            checks.append((name, F.col(name).isNotNull() & value.isNull(), F.col(name)))
        if name == "eventtime":
            checks.append((f"{name}.day", out_of_range(value), F.col(name)))
    return checks


def parse_failures(events: DataFrame) -> DataFrame:
    """How many values of each field could not be read: one pass, one row per field; see ``_checks``."""
    counts = [(name, F.count_if(bad)) for name, bad, _ in _checks(events)]
    rows = F.array(*[F.struct(F.lit(name).alias("field"), count.alias("failures")) for name, count in counts])
    return events.agg(rows.alias("rows")).select(F.inline("rows"))


def parse_warnings(events: DataFrame, event_id: str = "eventid") -> DataFrame:
    """One row per value that could not be read: the event's id, the field, and the value as text. Nothing is shuffled."""
    found = [F.when(bad, F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"))) for name, bad, value in _checks(events)]
    if not found:
        return events.select(event_id, F.lit("").alias("field"), F.lit("").alias("value")).limit(0)
    return events.select(event_id, F.inline(F.array_compact(F.array(*found))))
