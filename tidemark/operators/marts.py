"""The tables behind each view of a comparison: entries, roll-ups, reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import (
    category_key,
    change_sign,
    cross_field_category,
    growth_status,
    score_band,
)
from tidemark.functions.numbers import percent, rate1, score2
from tidemark.functions.text import strip
from tidemark.operators.compare import CHANGED, ONLY_2, UNCHANGED, UNCLASSIFIED
from tidemark.operators.scale import first_rows, keep_matching
from tidemark.session import materialise, measure, store

TOP_CHANGES = 15
TOP_SUMMARY = 10


@dataclass(frozen=True)
class Roles:
    """Which compared columns play which part in the marts.

    ``by`` separates dashboards (one per sheet type). ``field`` is the column
    an entry is listed under.
    """

    papers: str = "highly_cited_papers"
    score: str = "indicative_cross_field_score"
    hot: str = "hot_papers"
    cited: str = "times_cited"
    field: str = "esi_field_2"
    entity: str = "name"
    by: tuple[str, ...] = ()


def entries(compared: DataFrame, roles: Roles) -> DataFrame:
    """One row per entity and field that exists in the second period.

    Changed, unchanged and new entities in one projection. An unchanged one
    shows the second period's values on both sides; a new one starts at 0 and
    is listed if it has papers.
    """
    status = F.col("status")
    new, same = status == ONLY_2, status == UNCHANGED
    papers, score = F.col(f"{roles.papers}_2"), F.col(f"{roles.score}_2")

    def before(first: Column, second: Column, zero: Column) -> Column:
        return F.when(new, zero).when(same, second).otherwise(first)

    listed = status.isin(CHANGED, UNCHANGED) | (new & (papers > 0))
    named = F.col(roles.entity) != ""
    change = F.when(new, papers).when(same, F.lit(0)).otherwise(F.col(f"{roles.papers}_change"))
    score_change = F.when(new, score).when(same, F.lit(0.0)).otherwise(F.col(f"{roles.score}_change"))
    return compared.filter(listed & named).select(
        *roles.by,
        F.col(roles.entity).alias("name"),
        F.col(roles.field).alias("subject"),
        status.alias("status"),
        before(F.col(f"{roles.papers}_1"), papers, F.lit(0)).alias("papers_1"),
        papers.alias("papers_2"),
        change.alias("paper_change"),
        score2(before(F.col(f"{roles.score}_1"), score, F.lit(0.0))).alias("score_1"),
        score2(score).alias("score_2"),
        score2(score_change).alias("score_change"),
        F.col(f"{roles.hot}_2").alias("hot_papers"),
        F.col(f"{roles.cited}_2").alias("times_cited"),
    )


def entities(entry_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Roll-up over fields: sums, the highest citation count, the category.

    ``subjects`` lists distinct fields, so its length is bounded by their
    number, however many rows a name has.
    """
    named = entry_rows.withColumn("name", strip(F.col("name"))).filter("name != ''")
    grouped = named.groupBy(*by, "name").agg(
        F.sort_array(F.collect_set("subject")).alias("subjects"),
        *[F.sum(c).alias(c) for c in ("papers_1", "papers_2", "paper_change")],
        *[score2(F.sum(c)).alias(c) for c in ("score_1", "score_2", "score_change")],
        F.sum("hot_papers").alias("hot_papers"),
        F.coalesce(F.max(F.when(F.col("times_cited") > 0, F.col("times_cited"))), F.lit(0)).alias("times_cited"),
    )
    counted = grouped.withColumn("field_count", F.size("subjects"))
    category = cross_field_category(F.col("field_count"), F.col("score_2"))
    return counted.withColumns(
        {
            "subject": F.array_join("subjects", ", "),
            "category": category,
            "category_key": category_key(category),
            "change_sign": change_sign(F.col("paper_change")),
        }
    )


def _significant(entry_rows: DataFrame) -> DataFrame:
    """Changed entries with a name whose paper count moved."""
    moved = entry_rows.filter((F.col("status") == CHANGED) & (F.col("paper_change") != 0))
    return moved.withColumn("name", strip(F.col("name"))).filter("name != ''")


def _bands(df: DataFrame) -> DataFrame:
    score = F.col("total_score")
    return df.withColumns(
        {
            "is_cross_field": score_band(score, "Cross-Field"),
            "is_near_cross_field": score_band(score, "Near Cross-Field"),
            "is_approaching_cross_field": score_band(score, "Approaching Cross-Field"),
        }
    )


def changed_multi_field(entry_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Entities with paper changes in more than one field, rolled up."""
    grouped = (
        _significant(entry_rows)
        .groupBy(*by, "name")
        .agg(
            F.sort_array(F.collect_set("subject")).alias("fields"),
            F.sum("papers_2").alias("total_papers"),
            F.sum("paper_change").alias("total_change"),
            score2(F.sum("score_2")).alias("total_score"),
        )
    )
    several = grouped.withColumn("field_count", F.size("fields")).filter("field_count > 1")
    return _bands(several)


def all_multi_field(entity_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Entities found in more than one field, changed or not."""
    several = entity_rows.filter("field_count > 1").select(
        *by,
        "name",
        F.col("subjects").alias("fields"),
        F.col("papers_2").alias("total_papers"),
        F.col("paper_change").alias("total_change"),
        F.col("score_2").alias("total_score"),
        "field_count",
    )
    return _bands(several)


def cross_field(entry_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Both multi-field lists merged by name: more fields win, then the first list."""
    first = changed_multi_field(entry_rows, by).withColumn("_order", F.lit(1))
    second = all_multi_field(entities(entry_rows, by), by).withColumn("_order", F.lit(0))
    both = first.unionByName(second)
    values = [c for c in both.columns if c not in (*by, "name", "field_count", "_order")]
    best = F.max(F.struct("field_count", "_order", *values)).alias("_best")
    picked = both.groupBy(*by, "name").agg(best)
    merged = picked.select(*by, "name", *[F.col("_best")[c].alias(c) for c in ("field_count", *values)])
    category = cross_field_category(F.col("field_count"), F.col("total_score"))
    return merged.withColumns({"category": category, "category_key": category_key(category)})


def unique_changes(entry_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Paper changes: all entries of a multi-field entity, else its best one."""
    moved = _significant(entry_rows)
    values = [c for c in moved.columns if c not in (*by, "name", "paper_change", "subject")]
    per_name = moved.groupBy(*by, "name").agg(
        F.count(F.lit(1)).alias("_weight"),
        (F.min("subject") != F.max("subject")).alias("_several"),
        F.max(F.struct("paper_change", "subject", *values)).alias("_best"),
    )
    per_name = store(per_name, "changes")
    single = per_name.df.filter(~F.col("_several")).select(*by, "name", "_best.*")
    names = measure(per_name.df.filter("_several").select(*by, "name", "_weight"))
    return keep_matching(moved, names, [*by, "name"], "_weight").unionByName(single)


def top_changes(
    entry_rows: DataFrame, direction: str, by: Sequence[str] = (), n: int = TOP_CHANGES, changes: DataFrame | None = None
) -> DataFrame:
    """The ``n`` largest increases or decreases with total score and category.

    Ties are broken by name and field. ``changes`` are the ``unique_changes``,
    if they are there already.
    """
    delta = F.col("paper_change")
    wanted, order = {"increase": (delta > 0, delta.desc()), "decrease": (delta < 0, delta.asc())}[direction]
    ranked = (unique_changes(entry_rows, by) if changes is None else changes).filter(wanted)
    if by:
        top = first_rows(ranked, by, [order, "name", "subject"], n)
    else:
        top = ranked.orderBy(order, "name", "subject").limit(n)
    # Stored so that both uses below see the same rows, and measured. Only the
    # entries of these names are rolled up.
    top = store(top, "top").df
    names = store(top.groupBy(*by, "name").agg(F.count(F.lit(1)).alias("_weight")), "names")
    mine = keep_matching(entry_rows.withColumn("name", strip(F.col("name"))), names, [*by, "name"], "_weight")
    lookup = cross_field(mine, by)
    lookup = lookup.select(*by, "name", "total_score", F.col("category").alias("_category"))
    return top.join(lookup, [*by, "name"], "left").select(
        *top.columns,
        F.coalesce("total_score", "score_2").alias("total_score"),
        F.coalesce("_category", F.lit("Single Field")).alias("category"),
        F.col("total_score").isNotNull().alias("in_cross_field_list"),
    )


def subject_growth(summary: DataFrame, subject: str = "subject", by: Sequence[str] = ()) -> DataFrame:
    """Growth and retention of each subject, with a status label."""
    growth = percent(F.col("total_2") - F.col("total_1"), F.col("total_1"))
    return summary.select(
        *by,
        F.col(subject).alias("subject"),
        "total_1",
        "total_2",
        rate1(percent(F.col("matched"), F.col("total_1"))).alias("retention_rate"),
        rate1(growth).alias("growth_rate"),
        F.col("changed").alias("entities_with_changes"),
        growth_status(growth).alias("status"),
    )


def executive_summary(summary: DataFrame, subject: str = "subject", by: Sequence[str] = ()) -> DataFrame:
    """Totals over all subjects and the overall rates."""
    matched, first = F.sum("matched"), F.sum("total_1")
    return summary.groupBy(*by).agg(
        first.alias("total_1"),
        F.sum("total_2").alias("total_2"),
        matched.alias("matched"),
        F.sum("changed").alias("changed"),
        F.count_distinct(subject).alias("total_subjects"),
        rate1(percent(F.sum("changed"), matched)).alias("change_rate"),
        rate1(percent(matched, first)).alias("retention_rate"),
    )


def cross_field_counts(cross_field_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Size of each cross-field band."""
    return cross_field_rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("multi_field"),
        F.count_if("is_cross_field").alias("cross_field"),
        F.count_if("is_near_cross_field").alias("near_cross_field"),
        F.count_if("is_approaching_cross_field").alias("approaching_cross_field"),
    )


def subject_list(df: DataFrame, subject: str = "subject") -> DataFrame:
    return df.select(subject).distinct()


def run_summary(snapshots: DataFrame, compared: DataFrame, by: Sequence[str], pair_by: Sequence[str]) -> DataFrame:
    """One row per run: snapshots, rows, pairs and the comparison classes."""
    rows = snapshots.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("snapshots"), F.sum("n").alias("rows_read")
    )
    pairs = compared.groupBy(*pair_by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("status").isin(CHANGED, UNCHANGED, UNCLASSIFIED)).alias("matched"),
        F.count_if(F.col("status") == CHANGED).alias("changed"),
        F.max(F.col("rows_1") > 0).alias("has_1"),
        F.max(F.col("rows_2") > 0).alias("has_2"),
    )
    complete = F.col("has_1") & F.col("has_2")
    totals = pairs.agg(
        F.count_if(complete).alias("successful_comparisons"),
        F.count_if(~complete).alias("incomplete_pairs"),
        F.sum("n").alias("entities"),
        F.sum("matched").alias("matched"),
        F.sum("changed").alias("changed"),
    )
    # Both are one row; as a union they need no join.
    columns = [*rows.columns, *totals.columns]
    both = rows.unionByName(totals, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in columns])
