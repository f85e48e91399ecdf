"""Snapshot comparison.

Both snapshots are one frame with a period column. An entity's rows of both
periods meet in a single aggregation by (pair, entity): that is full outer
join, keep-first and row counts at the price of one shuffle, and repeated
rows are reduced before they travel. Entities that are known to be unique and
carry text are paired by a full outer join instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import rate, relative_change
from tidemark.functions.text import comparable_name, fold
from tidemark.operators.scale import keep_matching
from tidemark.operators.shape import comparable
from tidemark.operators.stats import long_outliers
from tidemark.session import store
from tidemark.spec import CompareSpec, Metric

# A row without a name is counted in the totals, but belongs to no class.
UNNAMED = "unnamed"
ONLY_1, ONLY_2 = "only_in_1", "only_in_2"
CHANGED, UNCHANGED, UNCLASSIFIED = "changed", "unchanged", "unclassified"


def pair_up(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """One row per (pair, entity) with ``<column>_1`` and ``<column>_2``.

    ``rows_1`` and ``rows_2`` tell how many rows the entity has in each
    period; 0 means it is absent there. Rows without a name are counted: they
    are one row per pair, without values. With ``assume_unique`` an entity that
    repeats fails the job, whichever columns are read. Over a table that is
    stored in buckets by name, nothing is shuffled.
    """
    wanted = df.filter(F.col(spec.period).isin(*spec.periods))
    if not spec.assume_unique or _aggregates_by_hash(wanted, spec.payload):
        return _grouped(wanted, spec)
    paired = _join_sides(wanted.filter(F.col(spec.entity).isNotNull()), spec)
    counts = [F.count_if(F.col(spec.period) == p).alias(f"rows_{i}") for i, p in enumerate(spec.periods, 1)]
    unnamed = wanted.filter(F.col(spec.entity).isNull()).groupBy(*spec.pair_by).agg(*counts)
    return paired.unionByName(unnamed, allowMissingColumns=True)


def _grouped(wanted: DataFrame, spec: CompareSpec) -> DataFrame:
    """``pair_up`` by one aggregate; rows without a name are a group of their pair."""
    sides = [(i, F.col(spec.period) == p) for i, p in enumerate(spec.periods, 1)]
    named = F.col(spec.entity).isNotNull()
    counts = [F.count_if(side).alias(f"rows_{i}") for i, side in sides]
    if spec.assume_unique:
        values = [F.max(F.when(side & named, F.col(c))).alias(f"{c}_{i}") for i, side in sides for c in spec.payload]
        grouped = wanted.groupBy(*spec.keys).agg(*counts, *values)
        return grouped.filter(_once(F.when(named, F.greatest("rows_1", "rows_2"))))

    order = [c for c in spec.order_by if c not in spec.payload]
    ranked = [*[F.col(c) for c in spec.order_by], *[F.col(c) for c in spec.payload if c not in spec.order_by]]
    whole = F.struct(*ranked)
    first = [F.min(F.when(side & named, whole)).alias(f"_side_{i}") for i, side in sides]
    # Spark aggregates structs by sorting; a hash as first key makes most comparisons ones of two numbers.
    hashed = wanted.withColumn("_hash", F.xxhash64(*spec.keys))
    grouped = hashed.groupBy("_hash", *spec.keys).agg(*counts, *first)
    columns = [F.col(f"_side_{i}")[c].alias(f"{c}_{i}") for i, _ in sides for c in (*spec.payload, *order)]
    return grouped.select(*spec.keys, "rows_1", "rows_2", *columns)


def _once(rows: Column) -> Column:
    """A condition that fails the job where a promised-unique entity repeats; as a filter it is never pruned."""
    repeated = F.raise_error(F.lit("an entity repeats inside a snapshot, but the comparison assumes it is unique"))
    return F.when(rows > 1, repeated).otherwise(F.lit(True))


def _aggregates_by_hash(df: DataFrame, columns: Sequence[str]) -> bool:
    """Spark aggregates fixed-width columns by hash and others by sort."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return all(isinstance(df.schema[c].dataType, fixed) for c in columns)


def _join_sides(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """Pair unique entities by a full outer join, which sorts each side once.

    With text among the values this is cheaper than an aggregate that sorts
    before and after the shuffle and has nothing to combine. The rows of an entity
    are counted in the partitions and the order that the join needs anyway. A pair
    is one struct, as its columns may be null.
    """
    pair = F.struct(*[F.col(k) for k in spec.pair_by]) if spec.pair_by else F.lit(0)

    def side(i: int) -> DataFrame:
        values = [F.col(c).alias(f"{c}_{i}") for c in spec.payload]
        rows = df.filter(F.col(spec.period) == spec.periods[i - 1])
        keyed = rows.select(pair.alias(f"_pair_{i}"), F.col(spec.entity).alias(f"_entity_{i}"), *values)
        same = F.count(F.lit(1)).over(Window.partitionBy(f"_pair_{i}", f"_entity_{i}"))
        return keyed.withColumn(f"rows_{i}", same).filter(_once(F.col(f"rows_{i}")))

    cond = (F.col("_pair_1") == F.col("_pair_2")) & (F.col("_entity_1") == F.col("_entity_2"))
    joined = side(1).join(side(2), cond, "full_outer").withColumn("_pair", F.coalesce("_pair_1", "_pair_2"))
    keys = [F.col("_pair")[k].alias(k) for k in spec.pair_by]
    counts = [F.coalesce(f"rows_{i}", F.lit(0)).cast("bigint").alias(f"rows_{i}") for i in (1, 2)]
    named = F.coalesce("_entity_1", "_entity_2").alias(spec.entity)
    return joined.select(*keys, named, *counts, *[f"{c}_{i}" for i in (1, 2) for c in spec.payload])


def differs(m: Metric) -> Column:
    """Three-valued: unknown when one side is null."""
    a, b = F.col(f"{m.name}_1"), F.col(f"{m.name}_2")
    return F.abs(b - a) > m.tolerance if m.tolerance > 0 else a != b


def same(m: Metric) -> Column:
    a, b = F.col(f"{m.name}_1"), F.col(f"{m.name}_2")
    return F.abs(b - a) <= m.tolerance if m.tolerance > 0 else a == b


def _classified(paired: DataFrame, spec: CompareSpec, settle: bool = False) -> DataFrame:
    """Add status, deltas and relative changes.

    With ``settle`` a delta within the tolerance is reported as 0.
    """
    metrics = spec.metrics
    status = (
        F.when(F.col(spec.entity).isNull(), UNNAMED)
        .when(F.col("rows_2") == 0, ONLY_1)
        .when(F.col("rows_1") == 0, ONLY_2)
        .when(reduce(or_, [differs(m) for m in metrics]), CHANGED)
        .when(reduce(and_, [same(m) for m in metrics]), UNCHANGED)
        .otherwise(UNCLASSIFIED)
    )
    matched = ~status.isin(UNNAMED, ONLY_1, ONLY_2)
    extra = []
    for m in metrics:
        a, b = F.col(f"{m.name}_1"), F.col(f"{m.name}_2")
        delta = b - a
        if settle and m.tolerance > 0:
            delta = F.when(F.abs(delta) > m.tolerance, delta).otherwise(F.lit(0.0))
        extra.append(F.when(matched, delta).alias(f"{m.name}_change"))
        extra.append(F.when(matched, relative_change(a, b)).alias(f"{m.name}_relative"))
    return paired.select("*", status.alias("status"), *extra)


def compare(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """Classify every entity of every pair: exact key, tolerance per metric."""
    return _classified(pair_up(df, spec), spec)


def compare_normalised(df: DataFrame, spec: CompareSpec, tolerance: float = 0.001) -> DataFrame:
    """Classify on the trimmed, lower-case key; one tolerance for all floats.

    Unreadable and missing numbers count as 0, blank and ``nan`` names are
    left out. ``entity_1`` and ``entity_2`` hold the spellings of each period.
    """
    ready = comparable(df.filter(comparable_name(F.col(spec.entity))), spec.entity, spec.metric_names)
    fractional = {f.name for f in ready.schema.fields if isinstance(f.dataType, T.FractionalType)}
    metrics = tuple(Metric(m, tolerance if m in fractional else 0) for m in spec.metric_names)
    spelled = ready.withColumn("entity", F.col(spec.entity)).withColumn(spec.entity, fold(F.col(spec.entity)))
    folded = CompareSpec(
        metrics=metrics,
        periods=spec.periods,
        entity=spec.entity,
        pair_by=spec.pair_by,
        period=spec.period,
        carry=(*spec.carry, "entity"),
        order_by=spec.order_by,
        assume_unique=spec.assume_unique,
    )
    return _classified(pair_up(spelled, folded), folded, settle=True)


def pair_coverage(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """Per pair: rows in each period, whether both exist, what is missing."""
    first, second = spec.periods
    counted = (
        df.filter(F.col(spec.period).isin(first, second))
        .groupBy(*spec.pair_by)
        .agg(
            F.count_if(F.col(spec.period) == first).alias("rows_1"),
            F.count_if(F.col(spec.period) == second).alias("rows_2"),
        )
    )
    missing = F.when(F.col("rows_1") == 0, first).when(F.col("rows_2") == 0, second)
    return counted.select("*", missing.isNull().alias("is_complete"), missing.alias("missing_period"))


def complete_pairs(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """The rows of pairs that exist in both periods."""
    found = pair_coverage(df, spec).filter("is_complete")
    keys = found.select(*spec.pair_by, (F.col("rows_1") + F.col("rows_2")).alias("_weight"))
    return keep_matching(df, store(keys, "pairs"), spec.pair_by, "_weight")


def only_in(compared: DataFrame, side: int, spec: CompareSpec) -> DataFrame:
    """Entities that exist in one period only, with that period's values."""
    status = {1: ONLY_1, 2: ONLY_2}[side]
    values = [F.col(f"{c}_{side}").alias(c) for c in spec.payload]
    return compared.filter(F.col("status") == status).select(*spec.keys, *values)


def changes(compared: DataFrame, spec: CompareSpec) -> DataFrame:
    """Changed entities: both values, delta and relative change per metric."""
    per_metric = [f"{m}_{s}" for m in spec.metric_names for s in ("1", "2", "change", "relative")]
    carried = [F.col(f"{c}_2").alias(c) for c in spec.carry]
    return compared.filter(F.col("status") == CHANGED).select(*spec.keys, *carried, *per_metric)


def unchanged(compared: DataFrame, spec: CompareSpec) -> DataFrame:
    """Entities without a change, with the values of the second period."""
    values = [F.col(f"{c}_2").alias(c) for c in spec.payload]
    return compared.filter(F.col("status") == UNCHANGED).select(*spec.keys, *values)


def summarise(compared: DataFrame, spec: CompareSpec, over: str = "matched") -> DataFrame:
    """One row per pair: totals, class counts, rates and aggregate changes.

    ``over='matched'`` sums and averages deltas over all matched entities;
    ``over='changed'`` sums over changed ones and averages the deltas that are
    not 0.
    """
    if over not in ("matched", "changed"):
        raise ValueError(f"unknown scope: {over}")

    def counted(*statuses: str) -> Column:
        return F.count_if(F.col("status").isin(*statuses))

    matched = counted(CHANGED, UNCHANGED, UNCLASSIFIED)
    deltas = []
    for m in spec.metric_names:
        delta = F.col(f"{m}_change")
        if over == "matched":
            total, mean = F.sum(delta), F.avg(delta)
        else:
            delta = F.when(F.col("status") == CHANGED, delta)
            total, mean = F.sum(delta), F.avg(F.when(delta != 0, delta))
            total, mean = F.coalesce(total, F.lit(0)), F.coalesce(mean, F.lit(0.0))
        deltas += [total.alias(f"total_{m}_change"), mean.alias(f"avg_{m}_change")]
    grouped = compared.groupBy(*spec.pair_by).agg(
        F.sum("rows_1").alias("total_1"),
        F.sum("rows_2").alias("total_2"),
        matched.alias("matched"),
        counted(ONLY_1).alias("only_in_1"),
        counted(ONLY_2).alias("only_in_2"),
        counted(CHANGED).alias("changed"),
        counted(UNCHANGED).alias("unchanged"),
        counted(UNCLASSIFIED).alias("unclassified"),
        *deltas,
    )
    return grouped.withColumns(
        {
            "only_in_1_by_subtraction": F.col("total_1") - F.col("matched"),
            "only_in_2_by_subtraction": F.col("total_2") - F.col("matched"),
            "match_rate": rate(F.col("matched"), F.greatest("total_1", "total_2")),
            "change_rate": rate(F.col("changed"), F.col("matched")),
        }
    )


def fanout_totals(df: DataFrame, spec: CompareSpec) -> DataFrame:
    """Matched rows and delta sums as a plain join of the raw rows gives them.

    An entity with m rows before and n rows after counts m * n times. The
    numbers follow from the row counts and sums of each side, so no pair of
    rows is ever built. A pair of rows in which a metric is null on either side
    adds nothing to that metric's total and mean, so each metric has counts of
    its own.
    """
    sides = [(i, F.col(spec.period) == p) for i, p in enumerate(spec.periods, 1)]
    per_entity = (
        df.filter(F.col(spec.period).isin(*spec.periods) & F.col(spec.entity).isNotNull())
        .groupBy(*spec.keys)
        .agg(
            *[F.count_if(side).alias(f"_n_{i}") for i, side in sides],
            *[F.sum(F.when(side, F.col(m))).alias(f"_sum_{m}_{i}") for i, side in sides for m in spec.metric_names],
            *[F.count(F.when(side, F.col(m))).alias(f"_n_{m}_{i}") for i, side in sides for m in spec.metric_names],
        )
    )
    # A heavy entity alone may exceed a long, so products are exact decimals.
    wide = "decimal(20,0)"
    n1, n2 = F.col("_n_1").cast(wide), F.col("_n_2").cast(wide)
    pairs = F.sum(n1 * n2)
    deltas = []
    for m in spec.metric_names:
        kind = "double" if isinstance(df.schema[m].dataType, T.FractionalType) else wide
        k1, k2 = F.col(f"_n_{m}_1").cast(wide), F.col(f"_n_{m}_2").cast(wide)
        crossed = k1.cast(kind) * F.col(f"_sum_{m}_2").cast(kind) - k2.cast(kind) * F.col(f"_sum_{m}_1").cast(kind)
        total = F.sum(F.when((k1 > 0) & (k2 > 0), crossed))
        mean = F.try_divide(total.cast("double"), F.sum(k1 * k2).cast("double"))
        deltas += [total.alias(f"total_{m}_change"), mean.alias(f"avg_{m}_change")]
    grouped = per_entity.groupBy(*spec.pair_by).agg(
        F.sum("_n_1").alias("total_1"), F.sum("_n_2").alias("total_2"), pairs.alias("matched"), *deltas
    )
    return grouped.withColumns(
        {
            "only_in_1_by_subtraction": F.col("total_1") - F.col("matched"),
            "only_in_2_by_subtraction": F.col("total_2") - F.col("matched"),
            "match_rate": rate(F.col("matched"), F.greatest("total_1", "total_2")),
        }
    )


DUPLICATE_FLAGS = ("is_duplicate", "duplicate_profile", "duplicate_group_id")


def _named(compared: DataFrame, spec: CompareSpec) -> DataFrame:
    return compared.filter(F.col(spec.entity).isNotNull())


def _turned(before: Column, after: Column, kind: str) -> Column:
    return F.when(~before & after, f"became_{kind}").when(before & ~after, f"resolved_{kind}")


def duplicate_changes(compared: DataFrame, spec: CompareSpec) -> DataFrame:
    """Entities that became duplicates or stopped being ones.

    ``compared`` must carry the three duplicate columns.
    """
    before, after = F.col("is_duplicate_1"), F.col("is_duplicate_2")
    profile = F.when(after, F.col("duplicate_profile_2")).otherwise(F.col("duplicate_profile_1"))
    moved = _named(compared, spec).select(
        *spec.keys,
        _turned(before, after, "duplicate").alias("change"),
        before.alias("was_duplicate"),
        after.alias("is_duplicate"),
        profile.alias("duplicate_profile"),
        F.col("duplicate_group_id_2").alias("duplicate_group_id"),
    )
    return moved.filter(F.col("change").isNotNull())


def current_duplicates(flagged: DataFrame, spec: CompareSpec) -> DataFrame:
    """All duplicate rows of the second period."""
    latest = flagged.filter((F.col(spec.period) == spec.periods[1]) & F.col("is_duplicate"))
    return latest.select(*spec.keys, "duplicate_profile", "duplicate_group_id")


def duplicate_change_summary(compared: DataFrame, flagged: DataFrame, spec: CompareSpec) -> DataFrame:
    """Per pair: became, resolved and current duplicates, 0 included."""
    turned = _turned(F.col("is_duplicate_1"), F.col("is_duplicate_2"), "duplicate")
    return _status_summary(compared, flagged, spec, "duplicate", [turned], [F.col("is_duplicate")])


def _status_summary(
    compared: DataFrame,
    rows: DataFrame,
    spec: CompareSpec,
    kind: str,
    turned: Sequence[Column],
    current: Sequence[Column],
) -> DataFrame:
    """Counts of status changes and of current cases, summed over metrics."""

    def counted(tests: Sequence[Column]) -> Column:
        return reduce(add, [F.count_if(t) for t in tests])

    zero = F.lit(0).cast("bigint")
    names = [f"became_{kind}s", f"resolved_{kind}s", f"current_{kind}s"]
    moved = _named(compared, spec).groupBy(*spec.pair_by).agg(
        *[counted([t == f"{w}_{kind}" for t in turned]).alias(n) for w, n in zip(("became", "resolved"), names)]
    )
    latest = rows.filter(F.col(spec.period) == spec.periods[1]).groupBy(*spec.pair_by).agg(counted(current).alias(names[2]))
    both = moved.withColumn(names[2], zero).unionByName(latest.withColumns({n: zero for n in names[:2]}))
    return both.groupBy(*spec.pair_by).agg(*[F.sum(n).alias(n) for n in names])


def _is_outlier(flag: Column) -> Column:
    return flag != "None"


def outlier_changes(compared: DataFrame, spec: CompareSpec, fields: Sequence[str]) -> DataFrame:
    """Entities that became outliers or stopped being ones, per metric.

    ``compared`` must carry the flag and z-score columns of each metric.
    """
    entries = []
    for f in fields:
        before, after = (_is_outlier(F.col(f"{f}_outlier_flag_{i}")) for i in (1, 2))
        z = F.when(after, F.col(f"{f}_z_score_2")).otherwise(F.col(f"{f}_z_score_1"))
        entries.append(
            F.struct(
                F.lit(f).alias("metric"),
                _turned(before, after, "outlier").alias("change"),
                F.col(f"{f}_1").cast("double").alias("value_1"),
                F.col(f"{f}_2").cast("double").alias("value_2"),
                F.abs(z).alias("outlier_score"),
            )
        )
    rows = _named(compared, spec).select(*spec.keys, F.inline(F.array(*entries)))
    return rows.filter(F.col("change").isNotNull())


def current_outliers(enriched: DataFrame, spec: CompareSpec, fields: Sequence[str]) -> DataFrame:
    """All outlier values of the second period, with score and method."""
    latest = enriched.filter(F.col(spec.period) == spec.periods[1])
    return long_outliers(latest, fields, spec.keys).filter("is_outlier").drop("is_outlier")


def outlier_change_summary(
    compared: DataFrame, enriched: DataFrame, spec: CompareSpec, fields: Sequence[str]
) -> DataFrame:
    """Per pair: became, resolved and current outliers over all metrics."""
    flags = {f: [_is_outlier(F.col(f"{f}_outlier_flag_{i}")) for i in (1, 2)] for f in fields}
    turned = [_turned(before, after, "outlier") for before, after in flags.values()]
    current = [_is_outlier(F.col(f"{f}_outlier_flag")) for f in fields]
    return _status_summary(compared, enriched, spec, "outlier", turned, current)


def grand_totals(per_pair: DataFrame) -> DataFrame:
    """Sums of a per-pair summary's count columns over all pairs."""
    counts = [f.name for f in per_pair.schema.fields if isinstance(f.dataType, T.LongType)]
    return per_pair.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in counts])


def snapshot_info(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and columns of each snapshot."""
    own = [c for c in df.columns if c not in by]
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumns({"column_count": F.lit(len(own)), "columns": F.lit(",".join(own))})
    )
