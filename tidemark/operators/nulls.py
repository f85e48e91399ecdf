"""Missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import not_nan


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and null both mean missing; keep null."""
    fractional = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: not_nan(F.col(c)) for c in fractional}) if fractional else df


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Nulls per column, long form, all columns in one pass."""
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(list(by), list(columns), "column_name", "null_count")


class NullsFound(ValueError):
    """A column holds nulls that may not."""


def never_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise at once if one of the columns holds a null.

    All columns are counted in one pass that reads nothing else. A test inside
    the column's expression would go unnoticed where the column is not read.
    """
    guarded = [c for c in dict.fromkeys(columns) if c in df.columns]
    if not guarded:
        return df
    found = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in guarded]).first()
    bad = [f"column {c} may not hold a null value, {found[c]} found" for c in guarded if found[c]]
    if bad:
        raise NullsFound("; ".join(bad))
    return df


def handle_nulls(
    df: DataFrame,
    strategy: str,
    defaults: dict[str, object] | None = None,
    critical: Sequence[str] = (),
) -> DataFrame:
    """``fail`` on any null, ``skip`` such rows, or fill in the ``default``.

    Critical columns may not hold a null under any strategy.
    """
    if strategy not in ("fail", "skip", "default"):
        raise ValueError(f"unknown null strategy: {strategy}")
    df = never_null(df, df.columns if strategy == "fail" else critical)
    if strategy == "fail":
        return df
    if strategy == "skip":
        return df.na.drop("any")
    known = {c: v for c, v in (defaults or {}).items() if c in df.columns}
    return df.na.fill(known) if known else df


def filled_counts(df: DataFrame, defaults: dict[str, object], by: Sequence[str] = ()) -> DataFrame:
    """How many nulls the default strategy replaces, per column."""
    return null_counts(df, [c for c in defaults if c in df.columns], by)


def critical_nulls(df: DataFrame, strategy: str, critical: Sequence[str], name: str = "name") -> DataFrame:
    """Policy for nulls in critical columns other than the name, after load.

    ``fail`` raises, ``skip`` drops the rows, ``default`` leaves them, since
    typing has already put a default in.
    """
    columns = [c for c in critical if c != name]
    if strategy == "fail":
        return never_null(df, columns)
    if strategy == "skip":
        return df.na.drop("any", subset=columns)
    if strategy == "default":
        return df
    raise ValueError(f"unknown null strategy: {strategy}")
