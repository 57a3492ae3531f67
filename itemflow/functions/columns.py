"""Column expressions shared by all operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Answer letters and the option numbers they stand for.
LETTER_CODES = {"A": 1, "B": 2, "C": 3, "D": 4}

# Fixed value: a digit followed by "_d" marks the name of a deleted template.
DELETED_TEMPLATE_PATTERN = "[0-9]_d"

# An aggregate that can be evaluated per group or over a window: it receives a
# function that places each plain aggregate it is made of.
Aggregate = Callable[[Callable[[Column], Column]], Column]


def grouped(aggregate: Column) -> Column:
    """Place an aggregate in a ``groupBy().agg()``."""
    return aggregate


def only(value: Column, where: Column | None) -> Column:
    """The value where the condition holds, null elsewhere."""
    return value if where is None else F.when(where, value)


def plain(aggregate: Column) -> Aggregate:
    return lambda place: place(aggregate)


def total_rows(where: Column | None = None) -> Aggregate:
    return plain(F.count(only(F.lit(1), where)))


def count_where(condition: Column, where: Column | None = None) -> Aggregate:
    condition = condition if where is None else where & condition
    return plain(F.count(F.when(condition, 1)))


def any_where(condition: Column, where: Column | None = None) -> Aggregate:
    """True if the condition holds on some row; a null condition is false."""
    condition = F.coalesce(condition, F.lit(False))
    return plain(F.max(condition if where is None else F.coalesce(where & condition, F.lit(False))))


def strict(aggregate: Callable[[Column], Column], value: Column, where: Column | None = None) -> Aggregate:
    """An aggregate that is null as soon as one of its values is null.

    Spark skips nulls; score sums must not, or an unscored response would pass
    for a wrong one.
    """
    rows = only(F.lit(1), where)
    value = only(value, where)
    return lambda place: F.when(place(F.count(value)) == place(F.count(rows)), place(aggregate(value)))


def strict_sum(value: Column, where: Column | None = None) -> Aggregate:
    return strict(F.sum, value, where)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null when the denominator is 0 or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def milliseconds_to_minutes(value: Column) -> Column:
    return value / F.lit(60_000.0)


def letter_to_number(letter: Column) -> Column:
    """A-D as 1-4; any other text becomes null."""
    pairs = [F.lit(x) for pair in LETTER_CODES.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), letter).cast("bigint")


def is_deleted_name(template_name: Column) -> Column:
    return F.coalesce(template_name.rlike(DELETED_TEMPLATE_PATTERN), F.lit(False))


def is_attempted(raw_response: Column, text: bool = False) -> Column:
    """A response counts as attempted unless it is missing or 0; ``text``: the column holds text."""
    return F.coalesce(raw_response != ("0" if text else 0), F.lit(False))


def cast_or_refuse(text: Column, kind: DataType, name: str) -> Column:
    """The text as the type; one that is no such value stops the run and is named in the error."""
    value = text.try_cast(kind)
    refused = F.raise_error(F.concat(F.lit(f"{name} holds no {kind.simpleString()}: "), text)).cast(kind)
    return F.when(text.isNotNull() & value.isNull(), refused).otherwise(value)


def zero_where(value: Column, flag: Column) -> Column:
    """The value, or 0 where the flag is set; null where the flag is null."""
    return value * (~flag).cast("int")
