"""Comparison queries: classes, lists, summaries, status changes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import compare as C
from tidemark.operators.duplicates import flag_duplicates
from tidemark.operators.scale import keep_first
from tidemark.operators.stats import with_outliers
from tidemark.session import materialise
from workload.frames import (
    PERIODS,
    RAW_ORDERS_SQL,
    RAW_SPEC,
    SHORT_SPEC,
    SNAPSHOTS_SQL,
    SPEC,
    raw_orders,
    rounded,
    snapshots,
    table,
)
from workload.registry import query


def compared_sql(changed: str, unchanged: str, source: str = "snap") -> str:
    return f"""
cmp AS (
  SELECT coalesce(a.name, b.name) AS name, coalesce(a.subject, b.subject) AS subject,
         a.papers AS papers_1, b.papers AS papers_2, a.hot AS hot_1, b.hot AS hot_2,
         a.cited AS cited_1, b.cited AS cited_2, a.score AS score_1, b.score AS score_2,
         CASE WHEN b.name IS NULL THEN 'only_in_1' WHEN a.name IS NULL THEN 'only_in_2'
              WHEN {changed} THEN 'changed' WHEN {unchanged} THEN 'unchanged'
              ELSE 'unclassified' END AS status
  FROM (SELECT * FROM {source} WHERE period = 'p1') a
  FULL OUTER JOIN (SELECT * FROM {source} WHERE period = 'p2') b
    ON a.name = b.name AND a.subject = b.subject
)"""


SHORT_SQL = f"WITH {SNAPSHOTS_SQL}, {compared_sql('a.papers != b.papers OR a.hot != b.hot', 'a.papers = b.papers AND a.hot = b.hot')}"
FULL_SQL = "WITH " + SNAPSHOTS_SQL + "," + compared_sql(
    "a.papers != b.papers OR abs(b.score - a.score) > 0.001 OR a.hot != b.hot OR a.cited != b.cited",
    "a.papers = b.papers AND abs(b.score - a.score) <= 0.001 AND a.hot = b.hot AND a.cited = b.cited",
)
RELATIVE = "CASE WHEN {a} = 0 THEN CASE WHEN {b} > 0 THEN CAST('Infinity' AS DOUBLE) ELSE 0.0 END ELSE round(CAST({b} - {a} AS DOUBLE) / {a}, 6) END"


def short_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.compare(snapshots(spark, sf_dir), SHORT_SPEC)


def full_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.compare(snapshots(spark, sf_dir), SPEC)


def summary_sql(metrics: tuple[str, ...]) -> str:
    deltas = ", ".join(
        f"CAST(sum({m}_2 - {m}_1) FILTER (WHERE m) AS BIGINT) AS total_{m}_change, "
        f"round(avg({m}_2 - {m}_1) FILTER (WHERE m), 6) AS avg_{m}_change"
        for m in metrics
    )
    return f"""
SELECT *, total_1 - matched AS only_in_1_by_subtraction, total_2 - matched AS only_in_2_by_subtraction,
  CASE WHEN greatest(total_1, total_2) > 0 THEN round(matched / greatest(total_1, total_2)::DOUBLE, 6) ELSE 0.0 END AS match_rate,
  CASE WHEN matched > 0 THEN round(changed / matched::DOUBLE, 6) ELSE 0.0 END AS change_rate
FROM (
  SELECT subject, count(papers_1) AS total_1, count(papers_2) AS total_2, count(*) FILTER (WHERE m) AS matched,
    count(*) FILTER (WHERE status = 'only_in_1') AS only_in_1, count(*) FILTER (WHERE status = 'only_in_2') AS only_in_2,
    count(*) FILTER (WHERE status = 'changed') AS changed, count(*) FILTER (WHERE status = 'unchanged') AS unchanged,
    count(*) FILTER (WHERE status = 'unclassified') AS unclassified, {deltas}
  FROM (SELECT *, papers_1 IS NOT NULL AND papers_2 IS NOT NULL AS m FROM cmp) GROUP BY subject)"""


RATES = ("match_rate", "change_rate")


@query(SHORT_SQL + summary_sql(("papers", "hot")))
def pair_summary(spark, sf_dir):
    out = C.summarise(short_comparison(spark, sf_dir), SHORT_SPEC)
    return rounded(out, *RATES, "avg_papers_change", "avg_hot_change")


@query(
    FULL_SQL
    + """
SELECT subject, count(*) FILTER (WHERE papers_1 IS NOT NULL AND papers_2 IS NOT NULL) AS matched,
  count(*) FILTER (WHERE status = 'changed') AS changed, count(*) FILTER (WHERE status = 'unchanged') AS unchanged,
  CAST(sum(cited_2 - cited_1) AS BIGINT) AS total_cited_change, round(sum(score_2 - score_1), 6) AS total_score_change,
  round(avg(cited_2 - cited_1), 4) AS avg_cited_change, round(avg(score_2 - score_1), 6) AS avg_score_change
FROM cmp GROUP BY subject"""
)
def tolerance_summary(spark, sf_dir):
    out = C.summarise(full_comparison(spark, sf_dir), SPEC)
    out = rounded(rounded(out, "total_score_change", "avg_score_change"), "avg_cited_change", digits=4)
    return out.select(
        "subject", "matched", "changed", "unchanged", "total_cited_change", "total_score_change", "avg_cited_change", "avg_score_change"
    )


@query(SHORT_SQL + "SELECT subject, name, status, papers_1, papers_2, hot_1, hot_2 FROM cmp")
def entity_status(spark, sf_dir):
    return short_comparison(spark, sf_dir).select("subject", "name", "status", "papers_1", "papers_2", "hot_1", "hot_2")


@query(
    SHORT_SQL
    + "SELECT subject, name, papers_1 AS papers, hot_1 AS hot, round(score_1, 6) AS score, cited_1 AS cited FROM cmp WHERE status = 'only_in_1' ORDER BY papers DESC"
)
def only_in_first(spark, sf_dir):
    out = C.only_in(short_comparison(spark, sf_dir), 1, SHORT_SPEC)
    return rounded(out, "score").orderBy(F.desc("papers"), "subject", "name")


@query(
    SHORT_SQL
    + "SELECT subject, name, papers_2 AS papers, hot_2 AS hot, round(score_2, 6) AS score, cited_2 AS cited FROM cmp WHERE status = 'only_in_2' ORDER BY papers DESC"
)
def only_in_second(spark, sf_dir):
    out = C.only_in(short_comparison(spark, sf_dir), 2, SHORT_SPEC)
    return rounded(out, "score").orderBy(F.desc("papers"), "subject", "name")


@query(
    SHORT_SQL
    + f"""SELECT subject, name, round(score_2, 6) AS score, cited_2 AS cited, papers_1, papers_2, papers_2 - papers_1 AS papers_change,
  {RELATIVE.format(a="papers_1", b="papers_2")} AS papers_relative, hot_1, hot_2, hot_2 - hot_1 AS hot_change,
  {RELATIVE.format(a="hot_1", b="hot_2")} AS hot_relative
FROM cmp WHERE status = 'changed'"""
)
def changed_entities(spark, sf_dir):
    out = C.changes(short_comparison(spark, sf_dir), SHORT_SPEC)
    return rounded(out, "score", "papers_relative", "hot_relative").orderBy(F.desc("papers_change"), "subject", "name")


@query(
    SHORT_SQL
    + "SELECT subject, name, papers_2 AS papers, hot_2 AS hot, round(score_2, 6) AS score, cited_2 AS cited FROM cmp WHERE status = 'unchanged'"
)
def unchanged_entities(spark, sf_dir):
    out = C.unchanged(short_comparison(spark, sf_dir), SHORT_SPEC)
    return rounded(out, "score").orderBy(F.desc("papers"), "subject", "name")


NULLABLE_SQL = (
    "WITH "
    + SNAPSHOTS_SQL
    + """, holes AS (
  SELECT name, subject, period, papers, CASE WHEN hot = 0 THEN NULL ELSE hot END AS hot, cited, score FROM snap
),"""
    + compared_sql("a.papers != b.papers OR a.hot != b.hot", "a.papers = b.papers AND a.hot = b.hot", "holes")
)


@query(NULLABLE_SQL + "SELECT subject, status, count(*) AS n_entities FROM cmp GROUP BY ALL")
def null_metric_classes(spark, sf_dir):
    """A null metric makes a comparison unknown, not changed."""
    holes = snapshots(spark, sf_dir).withColumn("hot", F.when(F.col("hot") != 0, F.col("hot")))
    return C.compare(holes, SHORT_SPEC).groupBy("subject", "status").agg(F.count(F.lit(1)).alias("n_entities"))


def respelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second period spells names in upper case, padded with blanks."""
    loud = F.concat(F.lit(" \t"), F.upper("name"), F.lit("  "))
    name = F.when(F.col("period") == PERIODS[1], loud).otherwise(F.col("name"))
    return snapshots(spark, sf_dir).withColumn("name", name)


SCORE_SPEC = replace(SPEC, metrics=tuple(m for m in SPEC.metrics if m.name != "cited"))
RESPELLED_SQL = (
    "WITH "
    + SNAPSHOTS_SQL
    + """, loud AS (
  SELECT lower(name) AS name, subject, period, papers, hot, cited, score,
         CASE WHEN period = 'p2' THEN upper(name) ELSE name END AS spelled
  FROM (SELECT trim(CASE WHEN period = 'p2' THEN ' ' || upper(name) || '  ' ELSE name END) AS name, * EXCLUDE (name) FROM snap)
),"""
    + compared_sql(
        "a.papers != b.papers OR abs(b.score - a.score) > 0.001 OR a.hot != b.hot",
        "a.papers = b.papers AND abs(b.score - a.score) <= 0.001 AND a.hot = b.hot",
        "loud",
    )
)


@query(
    RESPELLED_SQL
    + """
SELECT subject, count(papers_1) AS total_1, count(papers_2) AS total_2, count(*) FILTER (WHERE status IN ('changed', 'unchanged')) AS matched,
  count(*) FILTER (WHERE status = 'only_in_1') AS only_in_1, count(*) FILTER (WHERE status = 'only_in_2') AS only_in_2,
  count(*) FILTER (WHERE status = 'changed') AS changed, count(*) FILTER (WHERE status = 'unchanged') AS unchanged,
  CAST(coalesce(sum(papers_2 - papers_1) FILTER (WHERE status = 'changed'), 0) AS BIGINT) AS total_papers_change,
  round(coalesce(avg(papers_2 - papers_1) FILTER (WHERE status = 'changed' AND papers_2 != papers_1), 0.0), 6) AS avg_papers_change,
  round(coalesce(sum(score_2 - score_1) FILTER (WHERE status = 'changed' AND abs(score_2 - score_1) > 0.001), 0.0), 6) AS total_score_change,
  round(coalesce(avg(score_2 - score_1) FILTER (WHERE status = 'changed' AND abs(score_2 - score_1) > 0.001), 0.0), 6) AS avg_score_change
FROM cmp GROUP BY subject"""
)
def normalised_match_summary(spark, sf_dir):
    out = C.summarise(C.compare_normalised(respelled(spark, sf_dir), SCORE_SPEC), SCORE_SPEC, over="changed")
    out = rounded(out, "avg_papers_change", "total_score_change", "avg_score_change")
    return out.select(
        "subject", "total_1", "total_2", "matched", "only_in_1", "only_in_2", "changed", "unchanged",
        "total_papers_change", "avg_papers_change", "total_score_change", "avg_score_change",
    )


@query(
    RESPELLED_SQL
    + """
SELECT subject, name, upper(name) AS entity, papers_2 - papers_1 AS papers_change,
  CASE WHEN abs(score_2 - score_1) > 0.001 THEN round(score_2 - score_1, 6) ELSE 0.0 END AS score_change
FROM cmp WHERE status = 'changed'"""
)
def normalised_changes(spark, sf_dir):
    out = C.compare_normalised(respelled(spark, sf_dir), SCORE_SPEC).filter(F.col("status") == C.CHANGED)
    return rounded(out.select("subject", "name", F.col("entity_2").alias("entity"), "papers_change", "score_change"), "score_change")


@query(RESPELLED_SQL + "SELECT subject, name, status, coalesce(papers_1, papers_2) AS papers FROM cmp WHERE status IN ('only_in_1', 'only_in_2')")
def normalised_only_lists(spark, sf_dir):
    out = C.compare_normalised(respelled(spark, sf_dir), SCORE_SPEC).filter(F.col("status").isin(C.ONLY_1, C.ONLY_2))
    return out.select("subject", "name", "status", F.coalesce("papers_1", "papers_2").alias("papers"))


FIRST_SQL = f"""WITH {RAW_ORDERS_SQL}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY subject, name, period ORDER BY seq) AS rn,
         count(*) OVER (PARTITION BY subject, name, period) AS n FROM raw
), cmp AS (
  SELECT coalesce(a.name, b.name) AS name, coalesce(a.subject, b.subject) AS subject, coalesce(a.n, 0) AS rows_1, coalesce(b.n, 0) AS rows_2,
    a.seq AS seq_1, b.seq AS seq_2, a.price AS price_1, b.price AS price_2,
    CASE WHEN b.name IS NULL THEN 'only_in_1' WHEN a.name IS NULL THEN 'only_in_2' WHEN a.price != b.price THEN 'changed' ELSE 'unchanged' END AS status
  FROM (SELECT * FROM firsts WHERE period = 'p1' AND rn = 1) a FULL OUTER JOIN (SELECT * FROM firsts WHERE period = 'p2' AND rn = 1) b
    ON a.name = b.name AND a.subject = b.subject
)"""


@query(FIRST_SQL + "SELECT subject, name, rows_1, rows_2, seq_1, seq_2, price_1, price_2, status FROM cmp")
def repeated_entities_first_row(spark, sf_dir):
    """Entities repeat inside a snapshot; the first row by order key counts."""
    out = C.compare(raw_orders(spark, sf_dir), RAW_SPEC)
    return out.select("subject", "name", "rows_1", "rows_2", "seq_1", "seq_2", "price_1", "price_2", "status")


@query(
    f"""WITH {RAW_ORDERS_SQL}, t AS (
  SELECT subject, count(*) FILTER (WHERE period = 'p1') AS total_1, count(*) FILTER (WHERE period = 'p2') AS total_2 FROM raw GROUP BY subject
), j AS (
  SELECT a.subject, count(*) AS matched, CAST(sum(b.price - a.price) AS BIGINT) AS total_price_change, round(avg(b.price - a.price), 4) AS avg_price_change
  FROM raw a JOIN raw b ON a.subject = b.subject AND a.name = b.name AND a.period = 'p1' AND b.period = 'p2' GROUP BY a.subject
)
SELECT subject, total_1, total_2, matched, total_price_change, avg_price_change, total_1 - matched AS only_in_1_by_subtraction,
  total_2 - matched AS only_in_2_by_subtraction, round(matched / greatest(total_1, total_2)::DOUBLE, 6) AS match_rate
FROM t JOIN j USING (subject)"""
)
def fanout_totals(spark, sf_dir):
    """Totals of the plain row join, without building its pairs."""
    out = C.fanout_totals(raw_orders(spark, sf_dir), RAW_SPEC)
    whole = ("matched", "total_price_change", "only_in_1_by_subtraction", "only_in_2_by_subtraction")
    out = out.withColumns({c: F.col(c).cast("bigint") for c in whole})
    return rounded(rounded(out, "match_rate"), "avg_price_change", digits=4)


PAIR_KEY_SPEC = replace(RAW_SPEC, pair_by=("name", "subject"), entity="seq", order_by=())
COVERAGE_SQL = f"""WITH {RAW_ORDERS_SQL}, cov AS (
  SELECT name, subject, count(*) FILTER (WHERE period = 'p1') AS rows_1, count(*) FILTER (WHERE period = 'p2') AS rows_2 FROM raw GROUP BY ALL
)"""


@query(
    COVERAGE_SQL
    + "SELECT *, rows_1 > 0 AND rows_2 > 0 AS is_complete, CASE WHEN rows_1 = 0 THEN 'p1' WHEN rows_2 = 0 THEN 'p2' END AS missing_period FROM cov"
)
def pair_coverage(spark, sf_dir):
    """Customer and priority name a snapshot; many exist in one period only."""
    return C.pair_coverage(raw_orders(spark, sf_dir), PAIR_KEY_SPEC)


@query(COVERAGE_SQL + "SELECT subject, period, count(*) AS n_rows FROM raw SEMI JOIN (SELECT * FROM cov WHERE rows_1 > 0 AND rows_2 > 0) c USING (name, subject) GROUP BY ALL")
def complete_pair_rows(spark, sf_dir):
    rows = C.complete_pairs(raw_orders(spark, sf_dir), PAIR_KEY_SPEC)
    return rows.groupBy("subject", "period").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"WITH {SNAPSHOTS_SQL} SELECT subject, period, count(*) AS row_count, 5 AS column_count, 'name,papers,hot,cited,score' AS columns FROM snap GROUP BY ALL"
)
def snapshot_info(spark, sf_dir):
    return C.snapshot_info(snapshots(spark, sf_dir), ["subject", "period"])


DUP_SPEC = replace(RAW_SPEC, carry=C.DUPLICATE_FLAGS)


def flagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer with several orders in a snapshot is a duplicate there."""
    return flag_duplicates(raw_orders(spark, sf_dir), ["name"], by=["subject", "period"])


FLAGGED_SQL = f"""WITH {RAW_ORDERS_SQL}, groups AS (
  SELECT subject, period, lower(name) AS k, row_number() OVER (PARTITION BY subject, period ORDER BY lower(name)) AS g
  FROM raw GROUP BY subject, period, lower(name) HAVING count(*) > 1
), flagged AS (
  SELECT r.*, g.g IS NOT NULL AS is_duplicate, CASE WHEN g.g IS NULL THEN '' ELSE 'name:' || g.k END AS duplicate_profile,
         CASE WHEN g.g IS NULL THEN '' ELSE printf('DUP_%04d', g.g) END AS duplicate_group_id
  FROM raw r LEFT JOIN groups g ON r.subject = g.subject AND r.period = g.period AND lower(r.name) = g.k
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY subject, name, period ORDER BY seq) AS rn FROM flagged
), moved AS (
  SELECT b.subject, b.name, CASE WHEN b.is_duplicate THEN 'became_duplicate' ELSE 'resolved_duplicate' END AS change,
    a.is_duplicate AS was_duplicate, b.is_duplicate AS is_duplicate,
    CASE WHEN b.is_duplicate THEN b.duplicate_profile ELSE a.duplicate_profile END AS duplicate_profile, b.duplicate_group_id
  FROM firsts a JOIN firsts b ON a.subject = b.subject AND a.name = b.name AND a.period = 'p1' AND b.period = 'p2' AND a.rn = 1 AND b.rn = 1
  WHERE a.is_duplicate != b.is_duplicate
)"""


@query(FLAGGED_SQL + "SELECT * FROM moved")
def duplicate_status_changes(spark, sf_dir):
    return C.duplicate_changes(C.compare(flagged_orders(spark, sf_dir), DUP_SPEC), DUP_SPEC)


@query(FLAGGED_SQL + "SELECT subject, name, duplicate_profile, duplicate_group_id FROM flagged WHERE period = 'p2' AND is_duplicate")
def current_duplicates(spark, sf_dir):
    return C.current_duplicates(flagged_orders(spark, sf_dir), DUP_SPEC).orderBy("duplicate_group_id")


DUP_SUMMARY_SQL = """per_pair AS (
  SELECT subject, count(*) FILTER (WHERE change = 'became_duplicate') AS became_duplicates, count(*) FILTER (WHERE change = 'resolved_duplicate') AS resolved_duplicates,
         count(*) FILTER (WHERE change = 'current_duplicate') AS current_duplicates
  FROM (SELECT subject, change FROM moved UNION ALL SELECT subject, 'current_duplicate' FROM flagged WHERE period = 'p2' AND is_duplicate) GROUP BY subject)"""


def _duplicate_summary(spark, sf_dir):
    flagged = materialise(flagged_orders(spark, sf_dir), "flagged")
    return C.duplicate_change_summary(C.compare(flagged, DUP_SPEC), flagged, DUP_SPEC)


@query(f"{FLAGGED_SQL}, {DUP_SUMMARY_SQL} SELECT * FROM per_pair")
def duplicate_change_summary(spark, sf_dir):
    return _duplicate_summary(spark, sf_dir)


@query(
    f"""{FLAGGED_SQL}, {DUP_SUMMARY_SQL} SELECT CAST(sum(became_duplicates) AS BIGINT) AS total_became_duplicates,
  CAST(sum(resolved_duplicates) AS BIGINT) AS total_resolved_duplicates, CAST(sum(current_duplicates) AS BIGINT) AS total_current_duplicates FROM per_pair"""
)
def duplicate_grand_totals(spark, sf_dir):
    return C.grand_totals(_duplicate_summary(spark, sf_dir))


OUT_FIELDS = ("papers", "hot", "cited", "score")
OUT_SPEC = replace(
    SPEC, carry=tuple(f"{f}_{s}" for f in OUT_FIELDS for s in ("z_score", "outlier_flag"))
)
THRESHOLD = 2.0


def enriched_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read for the statistics and again for the rows.
    rows = materialise(snapshots(spark, sf_dir), "snapshots")
    return with_outliers(
        rows, OUT_FIELDS, by=["subject", "period"], threshold=THRESHOLD, percentiles=False
    )


def enriched_sql(source: str, fields: tuple[str, ...], by: str, threshold: float, keep: str) -> str:
    """Statistics by window and quantile functions, then flags and severity."""
    stats = ", ".join(
        f"avg({f}) AS {f}_m, stddev_samp({f}) AS {f}_s, quantile_cont({f}::DOUBLE, 0.25) AS {f}_q1, quantile_cont({f}::DOUBLE, 0.75) AS {f}_q3"
        for f in fields
    )
    zs = ", ".join(f"CASE WHEN {f}_s > 0 THEN ({f} - {f}_m) / {f}_s ELSE 0.0 END AS {f}_z_score" for f in fields)
    ranks = ", ".join(f"percent_rank() OVER (PARTITION BY {by} ORDER BY {f}) * 100 AS {f}_percentile" for f in fields)
    fence = "({f} < {f}_q1 - 1.5 * ({f}_q3 - {f}_q1) OR {f} > {f}_q3 + 1.5 * ({f}_q3 - {f}_q1))"
    flags = ", ".join(
        f"CASE WHEN abs({f}_z_score) > {threshold} AND {fence.format(f=f)} THEN 'IQR, Z-Score' WHEN abs({f}_z_score) > {threshold} THEN 'Z-Score' "
        f"WHEN {fence.format(f=f)} THEN 'IQR' ELSE 'None' END AS {f}_outlier_flag"
        for f in fields
    )
    flagged = " OR ".join(f"{f}_outlier_flag != 'None'" for f in fields)

    def band(bound: float) -> str:
        return " OR ".join(f"abs({f}_z_score) >= {bound}" for f in fields)

    return f"""
gstats AS (SELECT {by}, {stats} FROM {source} GROUP BY {by}),
zed AS (SELECT {source}.*, gstats.* EXCLUDE ({by}), {zs}, {ranks} FROM {source} JOIN gstats USING ({by})),
flg AS (SELECT *, {flags} FROM zed),
enriched AS (
  SELECT {keep}, {", ".join(f"{f}_z_score, {f}_percentile, {f}_outlier_flag" for f in fields)},
    CASE WHEN NOT ({flagged}) THEN 'Normal' WHEN {band(3)} THEN 'Extreme' WHEN {band(2)} THEN 'High' WHEN {band(1.5)} THEN 'Moderate' ELSE 'Low' END AS outlier_severity
  FROM flg
)"""


ENRICHED_SNAP_SQL = f"WITH {SNAPSHOTS_SQL}, {enriched_sql('snap', OUT_FIELDS, 'subject, period', THRESHOLD, 'name, subject, period, papers, hot, cited, score')}"
_METRIC_ROWS = " UNION ALL ".join(
    f"""SELECT b.subject, b.name, '{f}' AS metric, CASE WHEN b.{f}_outlier_flag != 'None' THEN 'became_outlier' ELSE 'resolved_outlier' END AS change,
  CAST(a.{f} AS DOUBLE) AS value_1, CAST(b.{f} AS DOUBLE) AS value_2,
  round(abs(CASE WHEN b.{f}_outlier_flag != 'None' THEN b.{f}_z_score ELSE a.{f}_z_score END), 6) AS outlier_score
  FROM enriched a JOIN enriched b ON a.subject = b.subject AND a.name = b.name AND a.period = 'p1' AND b.period = 'p2'
  WHERE (a.{f}_outlier_flag != 'None') != (b.{f}_outlier_flag != 'None')"""
    for f in OUT_FIELDS
)
_CURRENT_ROWS = " UNION ALL ".join(
    f"""SELECT subject, name, '{f}' AS metric, CAST({f} AS DOUBLE) AS value, round(abs({f}_z_score), 6) AS outlier_score, {f}_outlier_flag AS outlier_method
  FROM enriched WHERE period = 'p2' AND {f}_outlier_flag != 'None'"""
    for f in OUT_FIELDS
)


@query(f"{ENRICHED_SNAP_SQL} {_METRIC_ROWS}")
def outlier_status_changes(spark, sf_dir):
    compared = C.compare(enriched_snapshots(spark, sf_dir), OUT_SPEC)
    return rounded(C.outlier_changes(compared, OUT_SPEC, OUT_FIELDS), "outlier_score")


@query(f"{ENRICHED_SNAP_SQL} {_CURRENT_ROWS}")
def current_outliers(spark, sf_dir):
    out = C.current_outliers(enriched_snapshots(spark, sf_dir), OUT_SPEC, OUT_FIELDS)
    return rounded(out, "outlier_score").orderBy(F.desc("outlier_score"))


OUT_SUMMARY_SQL = f"""moved AS ({_METRIC_ROWS}), latest AS ({_CURRENT_ROWS}), per_pair AS (
  SELECT subject, count(*) FILTER (WHERE change = 'became_outlier') AS became_outliers, count(*) FILTER (WHERE change = 'resolved_outlier') AS resolved_outliers,
         count(*) FILTER (WHERE change = 'current_outlier') AS current_outliers
  FROM (SELECT subject, change FROM moved UNION ALL SELECT subject, 'current_outlier' FROM latest) GROUP BY subject)"""


def _outlier_summary(spark, sf_dir):
    enriched = materialise(enriched_snapshots(spark, sf_dir), "enriched")
    return C.outlier_change_summary(C.compare(enriched, OUT_SPEC), enriched, OUT_SPEC, OUT_FIELDS)


@query(f"{ENRICHED_SNAP_SQL}, {OUT_SUMMARY_SQL} SELECT * FROM per_pair")
def outlier_change_summary(spark, sf_dir):
    return _outlier_summary(spark, sf_dir)


@query(
    f"""{ENRICHED_SNAP_SQL}, {OUT_SUMMARY_SQL} SELECT CAST(sum(became_outliers) AS BIGINT) AS total_became_outliers,
  CAST(sum(resolved_outliers) AS BIGINT) AS total_resolved_outliers, CAST(sum(current_outliers) AS BIGINT) AS total_current_outliers FROM per_pair"""
)
def outlier_grand_totals(spark, sf_dir):
    return C.grand_totals(_outlier_summary(spark, sf_dir))


@query(
    """SELECT o_orderpriority, c_mktsegment, o_orderkey, o_custkey, o_totalprice FROM (
  SELECT o.o_orderpriority, c.c_mktsegment, o.o_orderkey, o.o_custkey, o.o_totalprice,
    row_number() OVER (PARTITION BY o.o_orderpriority, c.c_mktsegment ORDER BY o.o_orderdate, o.o_orderkey) AS rn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) WHERE rn = 1"""
)
def keep_first_per_key(spark, sf_dir):
    """25 heavy keys: each task hands over one row per key."""
    orders = table(spark, sf_dir, "orders").drop("o_orderstatus")
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = orders.join(segments, "o_custkey")
    return keep_first(joined, ["o_orderpriority", "c_mktsegment"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
