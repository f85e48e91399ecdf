"""Repeated entities: flag, count and remove."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import fold
from tidemark.operators.scale import attach, keep_first, keep_matching, running_totals
from tidemark.session import Stored, store


# Characters of a key that groups are ordered by at first.
BEGINNING = 64


class DuplicatesFound(ValueError):
    """Duplicates exist and the caller wants none."""


def _key(df: DataFrame, column: str, case_sensitive: bool) -> Column:
    """The value that rows are compared by; there is one zero, whatever its sign."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(df.schema[column].dataType)).otherwise(c)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = c if case_sensitive else fold(c)
        return F.coalesce(c, F.lit(""))
    return c


def _digest(columns: Sequence[str]) -> Column:
    """256 bits that stand for the values of all columns, so that wide text is not shuffled."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat_ws("|", *parts), 256))


def duplicate_groups(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), case_sensitive: bool = False
) -> DataFrame:
    """Keys held by more than one row: normalised keys, rows and surplus."""
    normal = [_key(df, k, case_sensitive).alias(k) for k in keys]
    counted = df.select(*by, *normal).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1).withColumn("surplus", F.col("n_rows") - 1)


def flag_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = (),
    case_sensitive: bool = False,
    fail: bool = False,
) -> DataFrame:
    """Add ``is_duplicate``, ``duplicate_profile`` and ``duplicate_group_id``.

    Groups are numbered ``DUP_0001`` upward within ``by``, in key order. The
    numbers come from the groups, not from the rows. No row is removed. Rows meet
    by a digest of their keys, and groups are ordered by the beginning of their first
    key, which is counted along; whole keys are read again where beginnings are equal.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"duplicate key columns not found: {missing}")
    norm = {k: f"_key_{k}" for k in keys}
    order = [norm[k] for k in keys]
    normal = df.withColumns({norm[k]: _key(df, k, case_sensitive) for k in keys})
    normal = normal.withColumn("_digest", _digest(order))
    # Joins sort by their first key, which the digest is, as it differs in its first bytes.
    on = ["_digest", *by]
    counts = _with_beginnings(normal, on, order[0]).filter(F.col("n_rows") > 1)
    repeated = store(counts.withColumn("_one", F.lit(1).cast("bigint")), "digests")
    if fail and repeated.rows:
        raise DuplicatesFound(f"duplicates found on {list(keys)}")
    cells, ranks = _sortable(normal, repeated, by, on, order)
    ranked = running_totals(cells, by, ranks, "_one")
    number = F.format_string("DUP_%04d", F.col("before") + 1).alias("_group")
    numbered = store(ranked.select(*on, "n_rows", number), "duplicates")
    # Normalised keys are made again behind the join, so that they are not shuffled.
    joined = attach(normal.select(*df.columns, "_digest"), numbered, on, "n_rows", null_safe=on)
    profile = F.concat_ws(
        " | ", *[F.concat(F.lit(f"{k}:"), F.coalesce(_key(df, k, case_sensitive).cast("string"), F.lit(""))) for k in keys]
    )
    return joined.select(
        *df.columns,
        F.col("_group").isNotNull().alias("is_duplicate"),
        F.when(F.col("_group").isNotNull(), profile).otherwise(F.lit("")).alias("duplicate_profile"),
        F.coalesce("_group", F.lit("")).alias("duplicate_group_id"),
    )


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _with_beginnings(normal: DataFrame, on: Sequence[str], first: str) -> DataFrame:
    """Rows of each digest as ``n_rows``, and its first key or that text's first characters as ``_begin``."""
    rows = F.count(F.lit(1)).alias("n_rows")
    if not _is_text(normal, first):
        return normal.groupBy(*on).agg(rows, F.min(first).alias("_begin"))
    # Text follows from its digest; as one more key it is aggregated by hash, as a minimum by sorting.
    return normal.withColumn("_begin", F.left(F.col(first), F.lit(BEGINNING))).groupBy(*on, "_begin").agg(rows)


def _sortable(
    normal: DataFrame, repeated: Stored, by: Sequence[str], on: Sequence[str], order: Sequence[str]
) -> tuple[Stored, list[str]]:
    """Groups and the columns that order them: ``_begin``, then all keys as ``_whole`` where beginnings are shared."""
    groups = repeated.df
    if len(order) > 1:
        alike = groups
    elif _is_text(normal, order[0]):
        # A shorter beginning is the whole key.
        alike = groups.filter(F.length("_begin") >= BEGINNING)
    else:
        return repeated, ["_begin"]
    counted = alike.groupBy(*by, "_begin").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    shared = store(counted, "beginnings")
    if not shared.rows:
        return repeated, ["_begin"]
    # The keys themselves are read for these groups only.
    doubtful = store(keep_matching(groups, shared, [*by, "_begin"], "_n", null_safe=[*by, "_begin"]).select(*on, "n_rows"), "doubtful")
    rows = keep_matching(normal.select(*on, *order), doubtful, on, "n_rows", null_safe=on)
    whole = rows.groupBy(*on).agg(F.min(F.struct(*order)).alias("_whole"), F.lit(1).cast("bigint").alias("_weight"))
    return store(attach(groups, store(whole, "groups"), on, "_weight", null_safe=on), "sortable"), ["_begin", "_whole"]


def duplicate_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), case_sensitive: bool = True) -> DataFrame:
    """Per group: duplicate keys, rows they hold, rows that are surplus."""
    return (
        duplicate_groups(df, keys, by, case_sensitive)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("duplicate_groups"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("duplicate_rows"),
            F.coalesce(F.sum("surplus"), F.lit(0)).alias("surplus_rows"),
        )
    )


def remove_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row of each key, in ``order_by``."""
    return keep_first(df, [*by, *keys], order_by)
