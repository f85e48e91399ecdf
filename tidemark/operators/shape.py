"""Headers and projections: from a source sheet to the canonical columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import lenient_double, lenient_long
from tidemark.functions.text import strip

UNNAMED = "unnamed_column"
# A missing column whose name holds one of these words is 0.
COUNT_WORDS = ("cited", "papers", "documents", "rank")
RATIO_WORDS = ("percent", "score", "impact")


@dataclass(frozen=True)
class HeaderMatch:
    """Which source header feeds which target, and what is left over."""

    source_of: dict[str, str]
    unmapped: tuple[str, ...]
    missing: tuple[str, ...]


def snake(header: str) -> str:
    return re.sub("[^a-z0-9]+", "_", header.strip().lower()).strip("_")


def clean_headers(df: DataFrame) -> DataFrame:
    """Trim headers; a blank header gets a placeholder."""
    return df.toDF(*[c.strip() or UNNAMED for c in df.columns])


def match_headers(
    headers: Sequence[str],
    mapping: dict[str, str],
    variants: dict[str, Sequence[str]] | None = None,
    strict: bool = False,
) -> HeaderMatch:
    """Match source headers to targets by spelling.

    A header matches the configured spelling as it is, in upper, lower, title
    or snake case. Unless ``strict``, the snake case of the header itself and
    the listed ``variants`` match too. Two headers for one target are an error.
    """
    known: dict[str, str] = {}
    for target, source in mapping.items():
        for spelling in (source, source.upper(), source.lower(), source.title(), snake(source)):
            known[spelling] = target
    for target, others in (variants or {}).items():
        for other in others:
            known[other] = known[snake(other)] = target

    source_of: dict[str, str] = {}
    unmapped = []
    for header in headers:
        target = known.get(header.strip())
        if target is None and not strict:
            target = known.get(snake(header))
        if target is None:
            unmapped.append(header)
        elif target in source_of:
            raise ValueError(f"{header!r} and {source_of[target]!r} both map to {target}")
        else:
            source_of[target] = header
    missing = tuple(t for t in mapping if t not in source_of)
    return HeaderMatch(source_of, tuple(unmapped), missing)


def column_default(name: str) -> int | float | str:
    if any(w in name for w in COUNT_WORDS):
        return 0
    if any(w in name for w in RATIO_WORDS):
        return 0.0
    return ""


def require_columns(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    missing = [c for c in critical if c not in df.columns]
    if missing:
        raise ValueError(f"missing critical columns: {missing}")
    return df


def map_headers(
    df: DataFrame,
    mapping: dict[str, str],
    schema: str | T.StructType,
    keep: Sequence[str] = (),
    variants: dict[str, Sequence[str]] | None = None,
    strict: bool = False,
    missing: str = "default",
    critical: Sequence[str] = (),
) -> DataFrame:
    """One projection to the canonical columns, in canonical order.

    Unmapped columns are dropped, except those in ``keep``. A missing column
    is filled by the rule of its name (``default``) or with a blank, which is
    null for a number (``blank``). Values keep their source type; typing is a
    step of its own.
    """
    sources = [c for c in df.columns if c not in keep]
    found = match_headers(sources, mapping, variants, strict)
    absent = [c for c in critical if c in found.missing]
    if absent:
        raise ValueError(f"missing critical columns: {absent}")
    types = {f.name: f.dataType for f in as_schema(schema).fields}

    def filler(name: str) -> Column:
        if missing == "blank":
            blank = F.lit("") if isinstance(types[name], T.StringType) else F.lit(None)
            return blank.cast(types[name])
        return F.lit(column_default(name)).cast(types[name])

    columns = [
        F.col(f"`{found.source_of[t]}`").alias(t) if t in found.source_of else filler(t).alias(t)
        for t in mapping
    ]
    return df.select(*keep, *columns)


def as_schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def column_difference(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) columns compared with what is expected."""
    return (
        [c for c in expected if c not in df.columns],
        [c for c in df.columns if c not in expected],
    )


def typed(df: DataFrame, schema: str | T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Lenient typing: trimmed text, numbers or 0, null text to ``''``."""

    def convert(f: T.StructField) -> Column:
        c, kind = F.col(f.name), df.schema[f.name].dataType
        if isinstance(f.dataType, T.StringType):
            return F.coalesce(strip(c.cast("string")), F.lit(""))
        if isinstance(f.dataType, T.IntegralType):
            return lenient_long(c, kind).cast(f.dataType)
        if isinstance(f.dataType, T.FractionalType):
            return lenient_double(c, kind).cast(f.dataType)
        return c.cast(f.dataType)

    return df.select(*keep, *[convert(f).alias(f.name) for f in as_schema(schema).fields])


def enforced(df: DataFrame, schema: str | T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Strict typing at load: the schema's columns, in its order.

    A fraction becomes the nearest whole number (half to even), as on insert
    into an integer column. Text that is no number is an error.
    """
    fields = as_schema(schema).fields
    require_columns(df, [f.name for f in fields])

    def convert(f: T.StructField) -> Column:
        c, kind = F.col(f.name), df.schema[f.name].dataType
        if isinstance(f.dataType, T.NumericType) and isinstance(kind, T.StringType):
            c, kind = strip(c).cast("double"), T.DoubleType()
        if isinstance(f.dataType, T.IntegralType) and isinstance(kind, T.FractionalType):
            c = F.bround(c, 0)
        return c.cast(f.dataType)

    return df.select(*keep, *[convert(f).alias(f.name) for f in fields])


def comparable(df: DataFrame, name: str, metrics: Sequence[str]) -> DataFrame:
    """Trim the name and read every metric as a number, 0 where it is none."""
    changed = {name: strip(F.col(name))}
    for m in metrics:
        kind = df.schema[m].dataType
        whole = isinstance(kind, T.IntegralType)
        changed[m] = F.coalesce(F.col(m), F.lit(0)) if whole else lenient_double(F.col(m), kind)
    return df.withColumns(changed)
