"""Sources and sinks: data is written, read back and compared."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.operators import compare as C
from tidemark.operators.scale import first_rows
from tidemark.plans import comparison as plan
from tidemark.session import scratch_path
from tidemark.sources import reports, snapshots as source
from tidemark.sources.store import Store
from workload.comparison import SHORT_SQL, short_comparison, summary_sql
from workload.frames import PERIODS, SHORT_SPEC, SNAPSHOTS_SQL, rounded, snapshots, table
from workload.registry import query

SCHEMA = "name STRING, papers BIGINT, hot BIGINT, cited BIGINT, score DOUBLE"
MAPPING = {"name": "Name", "papers": "Papers", "hot": "Hot", "cited": "Cited", "score": "Score"}
SHEET = "Incites Researchers"
SHEET_SPEC = replace(SHORT_SPEC, pair_by=("subject", "sheet_type"))


def sheet_snapshots(spark, sf_dir):
    return snapshots(spark, sf_dir).withColumn("sheet_type", F.lit("incites_researchers"))


SNAKE = "trim(regexp_replace(lower(subject), '[^a-z0-9]+', '_', 'g'), '_')"


def _round_trip(spark, sf_dir, fmt):
    """Write a folder per period, sheet and subject, then read both periods."""
    root = scratch_path(spark, f"folders-{fmt}")
    headed = snapshots(spark, sf_dir).withColumnsRenamed(MAPPING)
    for period in PERIODS:
        rows = headed.filter(F.col("period") == period).drop("period")
        writer = rows.write.option("header", True) if fmt == "csv" else rows.write
        writer.partitionBy("subject").format(fmt).save(f"{root}/{period}/{SHEET}")
    folders = {p: f"{root}/{p}" for p in PERIODS}
    # JSON is read with a schema, which saves the pass that would look for one.
    headers = ", ".join(f"`{h}` STRING" for h in MAPPING.values()) if fmt == "json" else None
    return source.read_periods(spark, folders, [SHEET, "No such sheet"], MAPPING, SCHEMA, fmt, source_schema=headers)


READ_SQL = f"""WITH {SNAPSHOTS_SQL} SELECT {SNAKE} AS subject, 'incites_researchers' AS sheet_type, period, count(*) AS row_count, CAST(sum(papers) AS BIGINT) AS papers, CAST(sum(cited) AS BIGINT) AS cited
FROM snap GROUP BY ALL"""


def _totals(rows):
    return rows.groupBy("subject", "sheet_type", "period").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("papers").try_cast("bigint")).alias("papers"),
        F.sum(F.col("cited").try_cast("bigint")).alias("cited"),
    )


@query(READ_SQL)
def csv_folder_scan(spark, sf_dir):
    return _totals(_round_trip(spark, sf_dir, "csv"))


@query(READ_SQL)
def json_folder_scan(spark, sf_dir):
    return _totals(_round_trip(spark, sf_dir, "json"))


@query(READ_SQL)
def parquet_folder_scan(spark, sf_dir):
    return _totals(_round_trip(spark, sf_dir, "parquet"))


def new_store(spark):
    return Store(spark, f"t_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store"))


def loaded(spark, sf_dir):
    store = new_store(spark)
    store.load(sheet_snapshots(spark, sf_dir), {"snapshots": SCHEMA})
    return store


@query(
    f"WITH {SNAPSHOTS_SQL} SELECT 'incites_researchers' AS sheet_type, period, subject, count(*) AS expected_rows, count(*) AS stored_rows, 'ok' AS verdict FROM snap GROUP BY ALL"
)
def store_reconciliation(spark, sf_dir):
    store = loaded(spark, sf_dir)
    return store.reconcile("snapshots", source.extraction_metadata(sheet_snapshots(spark, sf_dir)))


@query(
    f"""WITH {SNAPSHOTS_SQL} SELECT 'incites_researchers' AS sheet_type, period, subject, c.v[1] AS "check", c.v[2] AS column_name, c.n AS violations
FROM (SELECT period, subject, count(*) FILTER (WHERE papers < 0) AS n1, count(*) FILTER (WHERE trim(name) = '') AS n2 FROM snap GROUP BY ALL)
CROSS JOIN LATERAL (SELECT unnest([{{'v': ['empty_name', 'name'], 'n': n2}}, {{'v': ['negative', 'papers'], 'n': n1}}]) AS c)"""
)
def store_validation(spark, sf_dir):
    return loaded(spark, sf_dir).validate("snapshots", ["name", "papers", "hot"], non_negative=["papers"])


@query(
    f"WITH {SNAPSHOTS_SQL} SELECT 'incites_researchers' AS sheet_type, period, subject, count(*) AS row_count, 5 AS column_count, 'name,papers,hot,cited,score' AS columns FROM snap GROUP BY ALL"
)
def store_profile(spark, sf_dir):
    return loaded(spark, sf_dir).profile("snapshots")


@query(f"WITH {SNAPSHOTS_SQL} SELECT 'snapshots' AS table_name, count(*) AS row_count, 8 AS column_count FROM snap")
def store_summary(spark, sf_dir):
    return loaded(spark, sf_dir).summary()


@query(f"WITH {SNAPSHOTS_SQL} SELECT subject, count(*) AS n, CAST(sum(papers) AS BIGINT) AS papers FROM snap WHERE period = 'p2' AND papers >= 2 GROUP BY subject")
def store_sql_with_parameters(spark, sf_dir):
    text = "SELECT subject, count(*) AS n, sum(papers) AS papers FROM snapshots WHERE period = ? AND papers >= ? GROUP BY subject"
    return loaded(spark, sf_dir).sql(text, ["p2", 2])


@query(f"WITH {SNAPSHOTS_SQL} SELECT name, subject, period, papers FROM snap WHERE papers >= 3")
def query_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    loaded(spark, sf_dir).export("SELECT name, subject, period, papers FROM snapshots WHERE papers >= 3", path)
    return spark.read.schema("name STRING, subject STRING, period STRING, papers BIGINT").csv(path, header=True)


@query(f"WITH {SNAPSHOTS_SQL} SELECT subject, period, name, papers FROM snap QUALIFY row_number() OVER (PARTITION BY subject, period ORDER BY papers DESC, name) <= 3")
def sample_per_snapshot(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    return first_rows(rows, ["subject", "period"], [F.desc("papers"), "name"], 3).select("subject", "period", "name", "papers")


def saved(spark, sf_dir):
    root = scratch_path(spark, "reports")
    result = plan.run(sheet_snapshots(spark, sf_dir), SHEET_SPEC)
    plan.save(result, root, date="2000-01-01T00:00:00")
    return root


@query(
    f"""{SHORT_SQL} SELECT 'incites_researchers' AS sheet_type, {SNAKE} || '_incites_researchers' AS comparison_id, count(*) AS entity_count FROM cmp GROUP BY ALL"""
)
def report_round_trip(spark, sf_dir):
    """Reports are written as JSON and read back."""
    root = saved(spark, sf_dir)
    return reports.entity_counts(reports.read_entities(spark, root, "name STRING, status STRING"))


@query(
    f"""{SHORT_SQL}, s AS ({summary_sql(("papers", "hot"))}) SELECT {SNAKE} || '_incites_researchers' AS comparison_id, 'incites_researchers' AS sheet_type,
  total_1 AS dataset_1_total, total_2 AS dataset_2_total, matched, changed, unchanged, only_in_1, only_in_2, match_rate, total_papers_change FROM s"""
)
def report_documents(spark, sf_dir):
    root = saved(spark, sf_dir)
    docs = spark.read.json(f"{root}/summaries")
    out = docs.select(
        "comparison_id",
        "sheet_type",
        "summary_statistics.dataset_1_total",
        "summary_statistics.dataset_2_total",
        F.col("summary_statistics.total_researchers_compared").alias("matched"),
        F.col("summary_statistics.researchers_with_changes").alias("changed"),
        F.col("summary_statistics.researchers_unchanged").alias("unchanged"),
        F.col("summary_statistics.researchers_only_in_dataset_1").alias("only_in_1"),
        F.col("summary_statistics.researchers_only_in_dataset_2").alias("only_in_2"),
        "summary_statistics.match_rate",
        "summary_statistics.aggregate_changes.total_papers_change",
    )
    return rounded(out, "match_rate")


@query(f"{SHORT_SQL} SELECT count(DISTINCT subject) AS total_pairs, count(DISTINCT subject) AS successful_comparisons, 0 AS incomplete_pairs, 'p1' AS dataset_1_period, 'p2' AS dataset_2_period FROM cmp")
def run_document(spark, sf_dir):
    root = saved(spark, sf_dir)
    run = spark.read.json(f"{root}/comparison_summary")
    return run.select(
        "total_pairs", "successful_comparisons", F.col("incomplete_pairs").cast("int").alias("incomplete_pairs"), "dataset_1_period", "dataset_2_period"
    )


@query(
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events"
)
def json_properties(spark, sf_dir):
    """A JSON text column, read with an explicit schema."""
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"), "event_type")


@query(f"{SHORT_SQL} SELECT subject, status, count(*) AS n FROM cmp GROUP BY ALL")
def flow_classes(spark, sf_dir):
    """The whole flow: coverage, statistics, comparison, then its lists."""
    result = plan.run(sheet_snapshots(spark, sf_dir), SHEET_SPEC, analysed=["papers", "hot"])
    return result.compared.groupBy("subject", "status").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SNAPSHOTS_SQL} SELECT count(*) AS n_rows, CAST(sum(papers) AS BIGINT) AS papers, count(DISTINCT subject) AS n_subjects FROM snap")
def insert_by_position(spark, sf_dir):
    store = new_store(spark)
    rows = snapshots(spark, sf_dir).select("name", "subject", "period", "papers")
    store.create(rows.filter("false"), "target")
    for period in PERIODS:
        store.insert(rows.filter(F.col("period") == period).toDF("a", "b", "c", "d"), "target")
    return store.read("target").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("papers").alias("papers"), F.count_distinct("subject").alias("n_subjects")
    )


@query(f"{SHORT_SQL} SELECT subject, name, status FROM cmp WHERE status IN ('only_in_1', 'only_in_2')")
def name_set_difference(spark, sf_dir):
    """Both differences of the name sets, as anti joins give them."""
    compared = short_comparison(spark, sf_dir)
    return compared.filter(F.col("status").isin(C.ONLY_1, C.ONLY_2)).select("subject", "name", "status")
