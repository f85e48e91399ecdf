"""Row filters a reader of the results applies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.labels import change_class
from tidemark.functions.numbers import sort_number
from tidemark.functions.text import comparable_name, plausible_field, valid_name

ALL = "all"
CATEGORY_FILTERS = (
    "crossfield",
    "nearcrossfield",
    "approachingcrossfield",
    "multidisciplinary",
    "singlefield",
)


def with_valid_names(df: DataFrame, name: str = "name") -> DataFrame:
    return df.filter(valid_name(F.col(name)))


def with_comparable_names(df: DataFrame, name: str = "name") -> DataFrame:
    return df.filter(comparable_name(F.col(name)))


def with_plausible_field(df: DataFrame, field: str) -> DataFrame:
    return df.filter(plausible_field(F.col(field)))


def of_sheets(df: DataFrame, sheets: Sequence[str], column: str = "sheet_type") -> DataFrame:
    """Known sheet types only; prunes partitions of a stored snapshot."""
    return df.filter(F.col(column).isin(*sheets))


def search(df: DataFrame, text: str, name: str = "name") -> DataFrame:
    """Names that contain the text, in any case."""
    return df.filter(F.contains(F.lower(F.col(name)), F.lower(F.lit(text))))


def filter_entries(df: DataFrame, subject: str = ALL, change: str = ALL, delta: str = "paper_change") -> DataFrame:
    """Per-entry view: one subject, one class of change."""
    test = change_class(F.col(delta), change)
    return df.filter(test if subject == ALL else test & (F.col("subject") == subject))


def filter_entities(df: DataFrame, subject: str = ALL, show: str = ALL, delta: str = "paper_change") -> DataFrame:
    """Aggregated view: a subject among several, a change class or a category."""
    if show in CATEGORY_FILTERS:
        test = F.col("category_key") == show
    else:
        test = change_class(F.col(delta), show)
    return df.filter(test if subject == ALL else test & F.array_contains("subjects", subject))


def filter_category(df: DataFrame, category: str = ALL) -> DataFrame:
    return df if category == ALL else df.filter(F.col("category_key") == category)


def sort_key(df: DataFrame, column: str) -> Column:
    """Numbers by value, text without regard to case."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column)
    return F.lower(F.col(column).cast("string"))


def sort_by(df: DataFrame, column: str, descending: bool = False, as_number: bool = False) -> DataFrame:
    """Sort by any column; ``as_number`` reads displayed numbers such as ``+1,234``."""
    key = sort_number(F.col(column)) if as_number else sort_key(df, column)
    return df.orderBy(key.desc() if descending else key.asc())
