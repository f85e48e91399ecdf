"""Spread, ranks and outliers of numeric columns, per group.

Statistics take two passes. The first is one aggregate: count, mean, deviation and,
from a mergeable sketch, a narrow bracket around each quartile. In the second
all values outside the brackets snap to their edges, and what is left is
counted: exact quartiles from about a thousandth of the distinct values.

Ranks need every value. They work on *cells*, distinct values with their number
of rows, which are counted before the shuffle, so a value that fills a third of a
table is one cell, and a group of any size is ranked slice by slice. They
come back to the rows by a row key, once for all fields. Where ranks are wanted,
quartiles are read off the ranked cells, without passes of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.labels import outlier_flag, outlier_severity, outside_fences, z_score
from tidemark.functions.numbers import not_nan, percent
from tidemark.operators.rules import count_violations
from tidemark.operators.scale import BROADCAST_BYTES, attach, running_totals
from tidemark.session import Stored, materialise, store

# Distinct ranks the sketch of a first pass tells apart, and the half width of a bracket in these.
ACCURACY, MARGIN = 10_000, 3
QUARTILES = (("q1", 0.25), ("q3", 0.75))
EDGES = ("_q1_lo", "_q1_hi", "_q3_lo", "_q3_hi")
STATS = ("n", "mean", "std", "std_pop", "min", "max", "q1", "q3", "iqr")
HIGH_OUTLIER_RATE = 20.0


def _long(df: DataFrame, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per value that is there: ``keep``, field, value."""
    numbers = df.select(*keep, *[not_nan(F.col(f)).alias(f) for f in fields])
    return numbers.unpivot(list(keep), list(fields), "field", "value").filter("value IS NOT NULL")


def count_cells(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> Stored:
    """Distinct values per (by, field) and how many rows hold them."""
    return store(_long(df, fields, by).groupBy(*by, "field", "value").agg(F.count(F.lit(1)).alias("n")), "cells")


def ranked(cells: Stored, by: Sequence[str] = ()) -> DataFrame:
    """The cells with the rows before them and the group's rows."""
    return running_totals(cells, [*by, "field"], ["value"], "n")


def _at_rank(rank: Column) -> Column:
    """The value that holds the 0-based rank, picked out of the cells."""
    return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("value")))


def _quartile_ranks() -> list[tuple[str, Column]]:
    """The 0-based ranks that each quartile lies between."""
    position = {name: (F.col("total") - 1) * F.lit(q) for name, q in QUARTILES}
    return [(f"{name}_{side}", f(position[name])) for name, _ in QUARTILES for side, f in (("low", F.floor), ("high", F.ceil))]


def _interpolated(name: str, q: float) -> Column:
    position = (F.col("total") - 1) * F.lit(q)
    low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
    return (low + (high - low) * (position - F.floor(position))).alias(name)


def _moments(df: DataFrame, fields: Sequence[str], by: Sequence[str]) -> Stored:
    """First pass: one row per (by, field) with count, mean, deviations, range and the brackets of the quartiles."""
    share = F.array(*[F.lit(q + side * MARGIN / ACCURACY) for _, q in QUARTILES for side in (-1, 1)])
    value = F.col("value")
    grouped = _long(df, fields, by).groupBy(*by, "field").agg(
        F.count(F.lit(1)).alias("total"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.stddev_pop(value).alias("std_pop"),
        F.min(value).alias("min"), F.max(value).alias("max"), F.percentile_approx(value, share, ACCURACY).alias("_edges"),
    )
    # Where ranks are fewer than the sketch tells apart, the bracket is the whole range.
    few = F.col("total") <= ACCURACY
    edges = {c: F.when(few, F.col("min" if c.endswith("lo") else "max")).otherwise(F.col("_edges")[i]) for i, c in enumerate(EDGES)}
    return store(grouped.withColumns(edges).drop("_edges"), "moments")


def _bracketed(df: DataFrame, fields: Sequence[str], by: Sequence[str], moments: Stored) -> Stored:
    """Second pass: (by, field), the values beside each quartile, and whether these lie in the brackets."""
    on = [*by, "field"]
    brackets = replace(moments, df=moments.df.select(*on, *EDGES, F.col("total").alias("_weight")))
    value, (lo1, hi1, lo3, hi3) = F.col("value"), (F.col(c) for c in EDGES)
    inside = value.between(lo1, hi1) | value.between(lo3, hi3)
    edge = F.when(value < lo1, lo1).when(value < lo3, lo3).otherwise(hi3)
    near = attach(_long(df, fields, by), brackets, on, "_weight", null_safe=by)
    snapped = near.select(*on, F.when(inside, value).otherwise(edge).alias("to"), (~inside & (value < edge)).alias("up"), (~inside & (value > edge)).alias("down"))
    counted = snapped.groupBy(*on, "to").agg(F.count(F.lit(1)).alias("n"), F.count_if("up").alias("up"), F.count_if("down").alias("down"))
    cells = ranked(store(counted.withColumnRenamed("to", "value"), "cells"), by)
    sure = F.lit(True)
    for _, rank in _quartile_ranks():
        here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
        known = (rank >= F.col("before") + F.col("up")) & (rank < F.col("before") + F.col("n") - F.col("down"))
        sure = sure & (~here | known)
    picks = [_at_rank(rank).alias(name) for name, rank in _quartile_ranks()]
    return store(cells.groupBy(*on).agg(*picks, F.bool_and(sure).alias("sure"), F.lit(1).alias("_one")), "quartiles")


def field_stats(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, both standard deviations, exact interpolated quartiles."""
    on = [*by, "field"]
    moments = _moments(df, fields, by)
    found = _bracketed(df, fields, by, moments)
    if not found.df.filter("NOT sure").isEmpty():
        # The sketch promises brackets that hold; a group in which one does not gets its whole range.
        doubtful = attach(moments.df, replace(found, df=found.df.select(*on, "sure", "_one")), on, "_one", null_safe=by)
        wide = {c: F.when(F.col("sure"), F.col(c)).otherwise(F.col("min" if c.endswith("lo") else "max")) for c in EDGES}
        found = _bracketed(df, fields, by, store(doubtful.withColumns(wide).drop("sure"), "moments"))

    both = attach(moments.df.drop(*EDGES), found, on, "_one", null_safe=by).select("*", *[_interpolated(*q) for q in QUARTILES])
    return both.select(*on, F.col("total").alias("n"), "mean", "std", "std_pop", "min", "max", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))


def _stats_of_cells(df: DataFrame, fields: Sequence[str], by: Sequence[str], cells: Stored) -> DataFrame:
    """Count, mean, deviation and quartiles per (by, field), the quartiles from cells that are ranked already."""
    on = [*by, "field"]
    value = F.col("value")
    moments = _long(df, fields, by).groupBy(*on).agg(
        F.count(F.lit(1)).alias("total"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
    picks = [_at_rank(rank).alias(name) for name, rank in _quartile_ranks()]
    found = store(cells.df.groupBy(*on).agg(*picks, F.lit(1).alias("_one")), "quartiles")
    both = attach(moments, found, on, "_one", null_safe=by)
    return both.select(*on, F.col("total").alias("n"), "mean", "std", *[_interpolated(*q) for q in QUARTILES])


def profile(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Statistics of each field in each group."""
    return field_stats(df, fields, by)


def percent_rank_of_cell() -> Column:
    """(rows before) / (rows - 1) in percent; a single row has 0."""
    return F.when(F.col("total") > 1, F.col("before") / (F.col("total") - 1) * 100).otherwise(F.lit(0.0))


def _with_ranks(df: DataFrame, fields: Sequence[str], by: Sequence[str], cells: Stored) -> DataFrame:
    """Add ``_<field>_rank``, the percent rank of each value in its group, or null.

    ``cells`` are the ranked cells. Ranks that may be broadcast are looked up row by row. Others meet narrow rows of
    a row key and one value, are put together by that key, and join the wide rows
    once, however many fields there are.
    """
    cells = replace(cells, df=cells.df.select(*by, "field", "value", "n", percent_rank_of_cell().alias("rank")))
    if cells.nbytes <= BROADCAST_BYTES:
        for f in fields:
            mine = cells.df.filter(F.col("field") == f).select(*by, F.col("value").alias(f"_{f}_key"), F.col("rank").alias(f"_{f}_rank"), "n")
            df = attach(df.withColumn(f"_{f}_key", not_nan(F.col(f))), replace(cells, df=mine), [*by, f"_{f}_key"], "n", null_safe=by)
        return df
    # Stored, so that a row keeps its key.
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    long = attach(_long(rows, fields, ["_row", *by]), cells, [*by, "field", "value"], "n", null_safe=by)
    per_row = long.groupBy("_row").agg(*[F.max(F.when(F.col("field") == f, F.col("rank"))).alias(f"_{f}_rank") for f in fields])
    return rows.join(per_row, "_row", "left").drop("_row")


def with_outliers(
    df: DataFrame,
    fields: Sequence[str],
    by: Sequence[str] = (),
    threshold: float = 3.0,
    percentiles: bool = True,
) -> DataFrame:
    """Add z-score, percentile and outlier flag per field, and the severity.

    Missing values get 0, 0 and ``None``. The rows themselves are not moved
    when the statistics and cells are small enough to broadcast.
    """
    cells = store(ranked(count_cells(df, fields, by), by), "ranked") if percentiles else None
    stats = field_stats(df, fields, by) if cells is None else _stats_of_cells(df, fields, by, cells)
    wide = (
        stats.groupBy(*by)
        .agg(
            F.max("n").alias("_weight"),
            *[
                F.max(F.when(F.col("field") == f, F.col(s))).alias(f"_{f}_{s}")
                for f in fields
                for s in ("mean", "std", "q1", "q3")
            ],
        )
    )
    out = attach(df, store(wide, "stats"), by, "_weight", null_safe=by)
    if cells is not None:
        out = _with_ranks(out, fields, by, cells)

    added: list[Column] = []
    for f in fields:
        value = not_nan(F.col(f))
        z = z_score(value, F.col(f"_{f}_mean"), F.col(f"_{f}_std"))
        flag = outlier_flag(value, z, F.col(f"_{f}_q1"), F.col(f"_{f}_q3"), threshold)
        added.append(z.alias(f"{f}_z_score"))
        if percentiles:
            added.append(F.coalesce(f"_{f}_rank", F.lit(0.0)).alias(f"{f}_percentile"))
        added.append(flag.alias(f"{f}_outlier_flag"))
    out = out.select(*df.columns, *added)
    severity = outlier_severity(
        [F.col(f"{f}_z_score") for f in fields], [F.col(f"{f}_outlier_flag") for f in fields]
    )
    return out.withColumn("outlier_severity", severity)


def outlier_report(
    df: DataFrame, fields: Sequence[str], by: Sequence[str] = (), threshold: float = 3.0
) -> DataFrame:
    """Rows outside the fences and rows beyond ``threshold`` population z."""
    stats = store(
        field_stats(df, fields, by).select(
            *by, "field", "q1", "q3", "mean", F.col("std_pop").alias("std"), F.col("n").alias("_weight")
        ),
        "stats",
    )
    joined = attach(_long(df, fields, by), stats, [*by, "field"], "_weight", null_safe=by)
    z = F.abs(z_score(F.col("value"), F.col("mean"), F.col("std")))
    return joined.groupBy(*by, "field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(outside_fences(F.col("value"), F.col("q1"), F.col("q3"))).alias("iqr_outliers"),
        F.count_if(z > threshold).alias("z_outliers"),
    )


def severity_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per severity with their share, and the share of all outliers."""
    counts = df.groupBy(*by, "outlier_severity").agg(F.count(F.lit(1)).alias("n_rows"))
    # The windows run over the counts: one row per severity.
    group = Window.partitionBy(*by)
    total = F.sum("n_rows").over(group)
    outliers = F.sum(F.when(F.col("outlier_severity") != "Normal", F.col("n_rows")).otherwise(F.lit(0))).over(group)
    return counts.withColumns({"share": percent(F.col("n_rows"), total), "outlier_rate": percent(outliers, total)})


def outlier_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Outliers per group and whether there are more than expected."""
    n, out = F.count(F.lit(1)), F.count_if(F.col("outlier_severity") != "Normal")
    return df.groupBy(*by).agg(
        n.alias("total_rows"),
        out.alias("outlier_rows"),
        percent(out, n).alias("outlier_rate"),
        (percent(out, n) > HIGH_OUTLIER_RATE).alias("high_outlier_rate"),
    )


def statistics_columns(fields: Sequence[str]) -> list[str]:
    """The columns that enrichment adds, in order."""
    parts = [f"{f}_{s}" for f in fields for s in ("z_score", "percentile", "outlier_flag")]
    return [*parts, "outlier_severity"]


def check_statistics(df: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Null z-scores, percentiles outside 0..100 and outlier rows, long form."""
    missing = [c for c in statistics_columns(fields) if c not in df.columns]
    if missing:
        raise ValueError(f"missing statistics columns: {missing}")
    predicates = {}
    for f in fields:
        z, p = F.col(f"{f}_z_score"), F.col(f"{f}_percentile")
        predicates["null_z_score", f] = F.col(f).isNotNull() & z.isNull()
        predicates["percentile_out_of_range", f] = (p < 0) | (p > 100)
    flagged = reduce(or_, [F.col(f"{f}_outlier_flag") != "None" for f in fields])
    predicates["outlier_row", "outlier_severity"] = F.col("outlier_severity") != "Normal"
    predicates["flag_without_severity", "outlier_severity"] = flagged & (F.col("outlier_severity") == "Normal")
    return count_violations(df, predicates, by)


def long_outliers(df: DataFrame, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per row and metric: value, is_outlier, score, method."""
    entries = [
        F.struct(
            F.lit(f).alias("metric"),
            F.col(f).cast("double").alias("value"),
            (F.col(f"{f}_outlier_flag") != "None").alias("is_outlier"),
            F.abs(F.col(f"{f}_z_score")).alias("outlier_score"),
            F.col(f"{f}_outlier_flag").alias("outlier_method"),
        )
        for f in fields
    ]
    return df.select(*keep, F.inline(F.array(*entries)))
