"""Fingerprints of snapshots that do not depend on the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def content_hash(columns: Sequence[str]) -> Column:
    """An aggregate over rows as a multiset: two sums of 64-bit row hashes, as text.

    Equal rows in any order give equal text; a row more or less, or a changed value, another
    one. Nulls count as values of their own.
    """
    values = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast(_WIDE)) for seed in (1, 2)]
    return F.concat_ws(":", *[F.coalesce(s, F.lit(0).cast(_WIDE)).cast("string") for s in sums])


def snapshot_contents(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, row_count and content_hash of every snapshot; one aggregate, combined before its shuffle."""
    columns = sorted(c for c in df.columns if c not in by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), content_hash(columns).alias("content_hash"))
