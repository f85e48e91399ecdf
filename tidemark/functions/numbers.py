"""Numeric expressions. Spark runs in ANSI mode, so every cast is a try cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip


def not_nan(c: Column) -> Column:
    """NaN and null are both missing; keep one spelling of it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def parse_double(c: Column, kind: T.DataType | None = None) -> Column:
    """The number in a column, null where there is none.

    Text is read; with ``kind`` a numeric column is taken as it is.
    """
    if isinstance(kind, T.NumericType):
        return not_nan(c)
    return not_nan(strip(c.cast("string")).try_cast("double"))


def lenient_double(c: Column, kind: T.DataType | None = None) -> Column:
    return F.coalesce(parse_double(c, kind), F.lit(0.0))


def lenient_long(c: Column, kind: T.DataType | None = None) -> Column:
    """``'123.7'`` to 123; what is no number becomes 0."""
    whole = c if isinstance(kind, T.IntegralType) else parse_double(c, kind).try_cast("bigint")
    return F.coalesce(whole.cast("bigint"), F.lit(0).cast("bigint"))


def non_numeric(c: Column, kind: T.DataType | None = None) -> Column:
    """A value is there, but it is no number."""
    if isinstance(kind, T.IntegralType):
        return F.lit(False)
    return c.isNotNull() & parse_double(c, kind).isNull()


def relative_change(old: Column, new: Column) -> Column:
    """(new - old) / old; from zero it is infinite growth or 0."""
    a, b = old.cast("double"), new.cast("double")
    from_zero = F.when(b > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    return F.when(a == 0, from_zero).otherwise(F.try_divide(b - a, a))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.when(whole > 0, F.try_divide(part.cast("double"), whole.cast("double"))).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return rate(part, whole) * 100


def score2(c: Column) -> Column:
    """Scores are reported with two decimals (half up)."""
    return F.round(c.cast("double"), 2)


def rate1(c: Column) -> Column:
    """Rates are reported with one decimal (half up)."""
    return F.round(c.cast("double"), 1)


def sort_number(c: Column) -> Column:
    """Sort value of a displayed number: its leading number, ``+1,234`` is 1234, ``-2.5%`` is -2.5; other text is 0."""
    plain = F.regexp_replace(c.cast("string"), "[+,]", "")
    leading = F.regexp_extract(plain, r"^\s*(-?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE]-?\d+)?))", 1)
    return F.coalesce(leading.try_cast("double"), F.lit(0.0))


def with_commas(c: Column) -> Column:
    """Display form of a count: ``1,234``."""
    return F.format_number(c, 0)


def signed(c: Column, digits: int = 0) -> Column:
    """Display form of a change: ``+1,234``, ``-5``, ``0``."""
    return F.concat(F.when(c > 0, "+").otherwise(""), F.format_number(c, digits))
