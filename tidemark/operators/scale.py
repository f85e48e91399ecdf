"""Joins and ranks that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Stored, materialise, store

# Largest table that is sent to every executor, checked by measuring it.
BROADCAST_BYTES = 64 * 1024 * 1024
# Largest table of heavy keys that is sent to every executor, checked in the same way.
HEAVY_BYTES = 64 * 1024 * 1024
# Most rows of a group that one task ranks, checked by counting.
GROUP_LIMIT = 250_000
# Most bytes of a table whose groups are ranked without looking at their sizes, by its measure.
GROUP_BYTES = 64 * 1024 * 1024


def attach(
    rows: DataFrame,
    stored: Stored,
    on: Sequence[str],
    weight: str,
    null_safe: Sequence[str] = (),
    broadcast_bytes: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Left join a stored table with one row per key onto ``rows``.

    A small table is broadcast. Of a larger one the keys with more rows than
    one of ``parts`` shuffle partitions should get are broadcast, fewer than
    ``parts`` of them, and the rest is joined by shuffle, with the rows of
    heavy and null keys spread over the partitions of that shuffle.
    ``weight`` is the number of rows of a key and is not part of the result.
    Columns in ``null_safe`` also match null to null.
    """
    values = stored.df
    added = [c for c in values.columns if c not in on and c != weight]
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if stored.nbytes <= limit:
        return _left(rows, F.broadcast(values.drop(weight)), on, added, null_safe)

    heavy = _heaviest(values, on, weight, parts).select(*on, F.struct(*added).alias("_heavy"))
    marked = _left(rows, F.broadcast(heavy), on, ["_heavy"], null_safe)

    no_match = F.lit(False)
    for c in on:
        if c not in null_safe:
            no_match = no_match | F.col(c).isNull()
    # ``_place`` is one more join key. For a light key it follows from the key;
    # rows of heavy and null keys get their input partition instead, which no
    # value has. A task that is run again sends its rows to the same places.
    types = {f.name: f.dataType for f in values.schema.fields}
    place = F.pmod(F.xxhash64(*[F.col(c).cast(types[c]) for c in on]), F.lit(1 << 31))
    elsewhere = -(F.spark_partition_id() + 1).cast("bigint")
    marked = marked.withColumn(
        "_place", F.when(F.col("_heavy").isNotNull() | no_match, elsewhere).otherwise(place)
    )
    light = (
        _left(values, F.broadcast(heavy), on, ["_heavy"], null_safe)
        .filter(F.col("_heavy").isNull())
        .select(*on, F.struct(*added).alias("_light"), place.alias("_place"))
    )
    joined = _left(marked, light, [*on, "_place"], ["_light"], null_safe)
    found = F.coalesce("_heavy", "_light")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in added])


def _heaviest(values: DataFrame, on: Sequence[str], weight: str, parts: int | None) -> DataFrame:
    """The keys that weigh more than 1/parts of all, and fewer if they are wide."""
    order = (F.desc(weight), *on)
    parts = parts or int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = values.agg(F.sum(weight)).first()[0] or 0
    top = store(values.filter(F.col(weight) > total / parts), "heavy")
    while top.nbytes > HEAVY_BYTES:
        fewer = min(top.rows - 1, top.rows * HEAVY_BYTES // top.nbytes)
        top = store(top.df.orderBy(*order).limit(fewer), "heavy")
    return top.df


def _left(
    rows: DataFrame,
    values: DataFrame,
    on: Sequence[str],
    added: Sequence[str],
    null_safe: Sequence[str],
) -> DataFrame:
    renamed = {c: f"_on_{i}" for i, c in enumerate(on)}
    right = values.select(*[F.col(c).alias(renamed[c]) for c in on], *added).alias("_r")
    cond = F.lit(True)
    for c in on:
        same, key = F.col(f"_l.{c}"), F.col(f"_r.{renamed[c]}")
        cond = cond & (same.eqNullSafe(key) if c in null_safe else same == key)
    return rows.alias("_l").join(right, cond, "left").drop(*renamed.values())


def keep_matching(rows: DataFrame, keys: Stored, on: Sequence[str], weight: str, **limits) -> DataFrame:
    """Left semi join with a stored key table, safe for heavy keys."""
    marked = replace(keys, df=keys.df.withColumn("_kept", F.lit(True)))
    return attach(rows, marked, on, weight, **limits).filter("_kept").drop("_kept")


def running_totals(
    cells: Stored,
    by: Sequence[str],
    order: Sequence[str],
    weight: str,
    sums: dict[str, Column] | None = None,
    group_limit: int | None = None,
) -> DataFrame:
    """For each row, the weight of the rows before it in its group.

    Adds ``before`` and ``total``, plus the group totals of the expressions in
    ``sums``. ``cells`` is a stored table of distinct (by, order) keys. Where
    its groups are small, in rows and in bytes, a window per group does. Otherwise rows are cut into
    slices by range partitioning, each slice is summed on its own and gets the
    total of the slices before it.
    """
    sums = sums or {}
    stored = cells.df
    group = Window.partitionBy(*by)
    to_previous = (Window.unboundedPreceding, -1)
    limit = GROUP_LIMIT if group_limit is None else group_limit
    # Bytes of a group are taken from the average row, so that long keys are cut as well.
    width = cells.nbytes / max(cells.rows, 1)
    limit = min(limit, GROUP_BYTES / max(width, 1))
    if cells.rows <= limit or _largest_group(stored, by) <= limit:
        before = F.sum(weight).over(group.orderBy(*order).rowsBetween(*to_previous))
        return stored.select(
            "*",
            F.coalesce(before, F.lit(0)).alias("before"),
            F.sum(weight).over(group).alias("total"),
            *[F.sum(e).over(group).alias(n) for n, e in sums.items()],
        )

    # The slice number is stored: partitioning a second time may cut elsewhere.
    sliced = stored.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id())
    sliced = materialise(sliced, "slices")
    per_slice = sliced.groupBy(*by, "_slice").agg(
        F.sum(weight).alias("_w"), *[F.sum(e).alias(n) for n, e in sums.items()]
    )
    offsets = per_slice.select(
        *by,
        "_slice",
        F.coalesce(F.sum("_w").over(group.orderBy("_slice").rowsBetween(*to_previous)), F.lit(0)).alias("_offset"),
        F.sum("_w").over(group).alias("total"),
        *[F.sum(n).over(group).alias(n) for n in sums],
    )
    joined = _left(sliced, offsets, [*by, "_slice"], ["_offset", "total", *sums], by)
    inside = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(*to_previous)
    before = F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return joined.withColumn("before", before).drop("_slice", "_offset")


def _largest_group(df: DataFrame, by: Sequence[str]) -> int:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order_by``; ties go to the smaller row.

    An aggregate, not a window: each task reduces its rows of a key to one
    before the shuffle, so a heavy key costs no more than a light one.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*[c for c in order_by if c in rest], *[c for c in rest if c not in order_by]]
    if not ordered:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_first"))
    picked = {c: F.col(c) for c in keys} | {c: F.col("_first")[c].alias(c) for c in rest}
    return first.select(*[picked[c] for c in df.columns])


def first_rows(df: DataFrame, by: Sequence[str], order_by: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of each group (Spark trims groups before the shuffle)."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
