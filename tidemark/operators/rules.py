"""Data-quality checks: every rule is a predicate, all are counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import non_numeric, parse_double
from tidemark.functions.text import digits_only, is_blank, null_like, strip
from tidemark.operators.duplicates import duplicate_groups
from tidemark.spec import Rule

# Limits of the checks across columns.
LOW_CITATIONS = 100
HIGH_SCORE = 5

Predicates = dict[tuple[str, str], Column]


class ValidationFailed(ValueError):
    """A check found violations and the caller wants none."""


def count_violations(df: DataFrame, predicates: Predicates, by: Sequence[str] = ()) -> DataFrame:
    """Long form: ``by``, check, column_name, violations (zero included)."""
    names = {f"_c{i}": key for i, key in enumerate(predicates)}
    counts = df.groupBy(*by).agg(
        *[F.count_if(p).alias(n) for n, p in zip(names, predicates.values())]
    )
    entries = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"), F.col(n).alias("violations"))
        for n, (check, column) in names.items()
    ]
    return counts.select(*by, F.inline(F.array(*entries)))


def type_predicates(df: DataFrame, columns: Sequence[str]) -> Predicates:
    return {("non_numeric", c): non_numeric(F.col(c), df.schema[c].dataType) for c in columns if c in df.columns}


def range_predicates(df: DataFrame, rules: Sequence[Rule]) -> Predicates:
    out: Predicates = {}
    for r in rules:
        if r.column not in df.columns:
            continue
        value = parse_double(F.col(r.column), df.schema[r.column].dataType)
        if r.min_value is not None:
            out["below_minimum", r.column] = value < r.min_value
        if r.max_value is not None:
            out["above_maximum", r.column] = value > r.max_value
    return out


def rule_predicates(df: DataFrame, rules: Sequence[Rule]) -> Predicates:
    """Ranges, numbers that cannot be read, short and empty values."""
    out = range_predicates(df, rules)
    for r in rules:
        if r.column not in df.columns:
            continue
        c = F.col(r.column)
        if r.min_value is not None or r.max_value is not None:
            out["not_a_number", r.column] = non_numeric(c, df.schema[r.column].dataType)
        if r.min_length is not None:
            out["too_short", r.column] = F.length(strip(c.cast("string"))) < r.min_length
        if r.required:
            out["required_empty", r.column] = is_blank(c.cast("string"))
    return out


def null_predicates(df: DataFrame, critical: Sequence[str]) -> Predicates:
    return {("null_value", c): F.col(c).isNull() for c in critical if c in df.columns}


def sanity_predicates(
    df: DataFrame, high_values: dict[str, float], texts: Sequence[str], name: str = "name"
) -> Predicates:
    """Looks wrong, though no rule forbids it."""
    out: Predicates = {}
    for column, high in high_values.items():
        if column not in df.columns:
            continue
        c, kind = F.col(column), df.schema[column].dataType
        value = parse_double(c, kind)
        out["negative", column] = value < 0
        out["very_high", column] = value > high
        out["not_numeric", column] = non_numeric(c, kind)
    for column in texts:
        if column not in df.columns:
            continue
        c = F.col(column)
        out["null_like", column] = null_like(c)
        out["numeric_text", column] = ~null_like(c) & digits_only(c)
        if column == name:
            out["very_short", column] = ~null_like(c) & ~digits_only(c) & (F.length(strip(c)) < 3)
    return out


def integrity_predicates(name: str, category: str, non_negative: Sequence[str]) -> Predicates:
    out: Predicates = {("empty_name", name): F.col(name).isNull() | (F.trim(name) == "")}
    for c in non_negative:
        out["negative", c] = F.col(c) < 0
    field = F.col(category)
    out["invalid_category", category] = field.isNull() | (F.trim(field) == "") | (field == "nan")
    return out


def consistency_predicates(papers: str, cited: str, score: str, percents: Sequence[str]) -> Predicates:
    out: Predicates = {("papers_but_low_citations", papers): (F.col(papers) > 0) & (F.col(cited) < LOW_CITATIONS)}
    for c in percents:
        out["percent_out_of_range", c] = (F.col(c) < 0) | (F.col(c) > 100)
    out["high_score_without_papers", score] = (F.col(score) > HIGH_SCORE) & (F.col(papers) == 0)
    return out


def duplicate_check(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows that share their key with another row; spelling counts."""
    groups = duplicate_groups(df, keys, by, case_sensitive=True)
    return groups.groupBy(*by).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations")).select(
        *by,
        F.lit("duplicate_key").alias("check"),
        F.lit("|".join(keys)).alias("column_name"),
        "violations",
    )


def column_check(df: DataFrame, critical: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per missing column, in the long form of the other checks."""
    missing = [c for c in critical if c not in df.columns]
    fields = [T.StructField(c, df.schema[c].dataType) for c in by]
    schema = T.StructType(
        [
            *fields,
            T.StructField("check", T.StringType()),
            T.StructField("column_name", T.StringType()),
            T.StructField("violations", T.LongType()),
        ]
    )
    rows = [(*[None] * len(by), "missing_column", c, 1) for c in missing]
    return df.sparkSession.createDataFrame(rows, schema)


# The names checks are chosen by.
CHECKS = (
    "check_required_columns",
    "check_data_types",
    "check_value_ranges",
    "check_null_constraints",
    "check_duplicate_constraints",
)


def run_checks(
    df: DataFrame,
    checks: Sequence[str] = CHECKS,
    critical: Sequence[str] = (),
    numeric: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    keys: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """The chosen checks as one frame; only violated checks are listed."""
    unknown = set(checks) - set(CHECKS)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    predicates: Predicates = {}
    if "check_data_types" in checks:
        predicates |= type_predicates(df, numeric)
    if "check_value_ranges" in checks:
        predicates |= range_predicates(df, rules)
    if "check_null_constraints" in checks:
        predicates |= null_predicates(df, critical)
    parts = []
    if predicates:
        parts.append(count_violations(df, predicates, by))
    if "check_duplicate_constraints" in checks and keys and all(k in df.columns for k in keys):
        parts.append(duplicate_check(df, keys, by))
    if "check_required_columns" in checks and any(c not in df.columns for c in critical):
        parts.append(column_check(df, critical, by))
    if not parts:
        return column_check(df, [], by)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.filter(F.col("violations") > 0)


def enforce(violations: DataFrame, shown: int = 5) -> None:
    """Raise with the first few violations, if there are any."""
    first = violations.limit(shown + 1).collect()
    if not first:
        return
    text = "; ".join(f"{r['check']} on {r['column_name']}: {r['violations']}" for r in first[:shown])
    raise ValidationFailed(text + (" and more" if len(first) > shown else ""))
