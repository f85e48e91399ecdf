"""Untidy files, loads that replace what they read, stored layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import compare as C
from tidemark.operators import stats as S
from tidemark.operators.contents import snapshot_contents
from tidemark.operators.shape import enforced
from tidemark.plans import preparation as P
from tidemark.session import scratch_path
from tidemark.sources import snapshots as source
from tidemark.sources.pages import NameIndex, Pages
from tidemark.sources.store import PARTITIONS, LoadFailed
from workload.comparison import SHORT_SQL
from workload.dashboards import ENTRIES_SQL, entries, stored_entries
from workload.frames import PERIODS, SNAPSHOTS_SQL, table
from workload.registry import query
from workload.preparation import PART_SETTINGS, PREPARED_SQL, mapped_parts
from workload.statistics import EVENT_SQL, enriched_events
from workload.storage import SCHEMA, SHEET_SPEC, loaded, new_store, sheet_snapshots
from workload.untidy import SHEETS_SQL, sheets

# -- files with broken records ---------------------------------------------------

LINES_SQL = """lines AS (
  SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderpriority AS subject, o_custkey AS cust,
    CASE o_orderkey % 9 WHEN 0 THEN 'missing fields' WHEN 1 THEN 'surplus fields' END AS reason,
    CASE o_orderkey % 9 WHEN 0 THEN 'rejected' WHEN 1 THEN 'rejected' WHEN 2 THEN 'repaired' WHEN 3 THEN 'repaired' ELSE 'good' END AS outcome
  FROM orders)"""


def _untidy_folder(spark, sf_dir) -> str:
    """CSV files of orders; of nine records two are broken, two have blank fields too many, and one has a quoted line break."""
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey").cast("string"), F.floor("o_totalprice").cast("string")
    name = F.concat(F.lit("n"), key.cast("string"))
    fields = F.concat_ws(",", name, cust, price)
    lines = (
        F.when(key % 9 == 0, F.array(F.concat_ws(",", name, cust)))
        .when(key % 9 == 1, F.array(F.concat(fields, F.lit(",EXTRA"))))
        .when(key % 9 == 2, F.array(F.concat(fields, F.lit(","))))
        .when(key % 9 == 3, F.array(F.concat(name, F.lit(",,"), price, F.lit(", , "))))
        .when(key % 9 == 4, F.array(F.concat(F.lit('"'), name), F.concat(F.lit('x, y",'), cust, F.lit(","), price)))
        .otherwise(F.array(fields))
    )
    root = scratch_path(spark, "untidy")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subject"), F.explode(lines).alias("Name,Papers,Cited"))
    # One column that holds whole lines; what marks quotes and separators here does not occur.
    plain = {"sep": "\u0001", "quote": "\u0002", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, **plain).partitionBy("subject").csv(f"{root}/sheet")
    return f"{root}/sheet"


@query(
    f"""WITH {LINES_SQL} SELECT subject, count(*) FILTER (WHERE outcome = 'good') AS good, count(*) FILTER (WHERE outcome = 'repaired') AS repaired, count(*) FILTER (WHERE outcome = 'rejected') AS rejected,
  CAST(sum(CASE WHEN outcome != 'rejected' THEN price END) AS BIGINT) AS cited, CAST(sum(CASE WHEN outcome != 'rejected' AND k % 9 != 3 THEN cust END) AS BIGINT) AS papers,
  count(*) FILTER (WHERE k % 9 = 4) AS broken_names FROM lines GROUP BY subject"""
)
def csv_outcomes(spark, sf_dir):
    """Good, repaired and rejected records, summed over the files of a subject, with the numbers of the rows that were kept."""
    checked = source.read_checked(spark, _untidy_folder(spark, sf_dir))
    per_file = source.file_outcomes(checked).groupBy("subject").agg(*[F.sum(o).alias(o) for o in ("good", "repaired", "rejected")])
    kept = source.kept_rows(checked).groupBy("subject").agg(
        F.sum(F.col("Cited").cast("bigint")).alias("cited"), F.sum(F.col("Papers").try_cast("bigint")).alias("papers"),
        F.count_if(F.contains("Name", F.lit("\nx, y"))).alias("broken_names"),
    )
    return per_file.join(kept, "subject")


@query(
    f"""WITH {LINES_SQL} SELECT subject, reason, 'n' || k || ',' || cust || CASE WHEN reason = 'surplus fields' THEN ',' || price || ',EXTRA' ELSE '' END AS record FROM lines WHERE outcome = 'rejected'"""
)
def csv_rejects(spark, sf_dir):
    """What was left out, as it stands in the files."""
    checked = source.read_checked(spark, _untidy_folder(spark, sf_dir))
    rejects = source.rejected_rows(checked)
    return rejects.select("subject", F.col(source.REASON).alias("reason"), F.col(source.RAW).alias("record"))


# -- loads ----------------------------------------------------------------------


@query(
    f"""WITH {SNAPSHOTS_SQL} SELECT subject, period, count(*) AS n_rows, CAST(sum(papers + 1) AS BIGINT) AS papers, count(*) FILTER (WHERE period = 'p1') AS loaded_twice
FROM snap WHERE papers > 1 GROUP BY ALL"""
)
def load_over_itself(spark, sf_dir):
    """A load that reads the table it replaces, and one that fails and leaves it as it is."""
    store = loaded(spark, sf_dir)
    again = store.read("snapshots").filter("papers > 1").withColumn("papers", F.col("papers") + 1)
    report = store.load(again, {"snapshots": SCHEMA}, counters={"first": F.count_if(F.col("period") == PERIODS[0])})
    assert report.counted["snapshots"]["first"] <= report.rows_in == report.rows_stored
    try:
        store.load(store.read("snapshots").limit(3), {"snapshots": "name STRING, orcid STRING"})
    except LoadFailed:
        pass
    return store.read("snapshots").groupBy("subject", "period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("papers").alias("papers"), F.count_if(F.col("period") == PERIODS[0]).alias("loaded_twice")
    )


@query(f"{SHORT_SQL} SELECT subject, status, count(*) AS n, CAST(sum(CASE WHEN status NOT LIKE 'only_in%' THEN papers_2 - papers_1 END) AS BIGINT) AS papers_change FROM cmp GROUP BY ALL")
def bucketed_comparison(spark, sf_dir):
    """Snapshots that are stored in buckets by name are compared without a shuffle."""
    store = new_store(spark)
    store.load(sheet_snapshots(spark, sf_dir), {"snapshots": SCHEMA}, buckets=8)
    compared = C.compare(store.read("snapshots"), SHEET_SPEC)
    return compared.groupBy("subject", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("papers_change").alias("papers_change"))


@query(
    f"""WITH {SHEETS_SQL}, marked AS (SELECT *, CASE WHEN subject = '2-HIGH' AND id % 10 = 0 THEN 1 WHEN subject = '3-MEDIUM' AND id % 10 IN (0, 1) THEN 2 WHEN subject = '5-LOW' AND id % 50 = 0 THEN 3 END AS mark FROM sheets)
SELECT sheet_type, period, subject, count(*) AS expected_rows, count(*) - count(*) FILTER (WHERE mark = 3) AS stored_rows,
  CASE WHEN count(*) FILTER (WHERE mark = 3) > 0 THEN 'row_count_mismatch' WHEN count(mark) > 0 THEN 'content_mismatch' ELSE 'ok' END AS verdict FROM marked GROUP BY ALL"""
)
def reconciliation_contents(spark, sf_dir):
    """Changed numbers, names with a blank more, and lost rows, in a table that is stored in another order."""
    schema = "name STRING, papers BIGINT"
    key, subject = F.col("o_orderkey"), F.col("subject")
    rows = sheets(spark, sf_dir, "o_orderkey")
    papers = F.when((subject == "2-HIGH") & (key % 10 == 0), F.col("papers") + 1).otherwise(F.col("papers"))
    name = F.when((subject == "3-MEDIUM") & (key % 10 < 2), F.concat("name", F.lit(" "))).otherwise(F.col("name"))
    changed = rows.withColumns({"papers": papers, "name": name}).filter(~((subject == "5-LOW") & (key % 50 == 0)))
    store = new_store(spark)
    store.load(changed.orderBy(F.desc("name")), {"t": schema})
    wanted = snapshot_contents(enforced(rows, schema, keep=PARTITIONS), PARTITIONS)
    return store.reconcile("t", wanted)


@query(
    f"""WITH {PREPARED_SQL} SELECT count(*) AS records_processed, count(*) FILTER (WHERE p_type != esi_field) AS records_changed, count(*) FILTER (WHERE is_duplicate) AS duplicates_flagged,
  count(*) AS rows_in, count(*) AS rows_stored, 1 AS tables, 0 AS n_failures FROM prep"""
)
def observed_load(spark, sf_dir):
    """Counters of a transform and a load, seen while the table is written."""
    named = {"subject": F.col("p_brand"), "sheet_type": F.lit("parts"), "period": F.lit("p1")}
    schema = f"{PART_SETTINGS.schema}, is_duplicate BOOLEAN, duplicate_group_id STRING"
    run = P.load_prepared(new_store(spark), mapped_parts(spark, sf_dir).withColumns(named), PART_SETTINGS, {"parts": schema})
    return run.withColumn("n_failures", F.size("failures")).drop("failures")


# -- views ------------------------------------------------------------------------


def _paged(spark, sf_dir) -> Pages:
    keys = {"_k1": -F.col("paper_change"), "_k2": F.lower("name"), "_k3": F.col("subject")}
    return Pages.write(entries(spark, sf_dir), scratch_path(spark, "pages"), keys, lookup=["name"])


@query(ENTRIES_SQL + "SELECT name, subject, paper_change FROM ent ORDER BY paper_change DESC, lower(name), subject LIMIT 40 OFFSET 40")
def second_page(spark, sf_dir):
    """Entries by their change, 40 a page; the second page starts behind the last row of the first."""
    pages = _paged(spark, sf_dir)
    last = pages.page(40).select(*pages.keys).collect()[-1]
    return pages.page(40, tuple(last)).select("name", "subject", "paper_change")


@query(ENTRIES_SQL + "SELECT * FROM ent WHERE contains(lower(name), '0007') UNION ALL SELECT * FROM ent WHERE contains(lower(name), '9')")
def search_names_by_trigrams(spark, sf_dir):
    """The rows that a scan finds, for a text with trigrams and one that is too short for them."""
    rows = stored_entries(spark, sf_dir)
    index = NameIndex.write(rows, scratch_path(spark, "names"))
    return index.search(rows, "0007").unionByName(index.search(rows, "9"))


# -- checks that find something -----------------------------------------------------


@query(
    EVENT_SQL
    + """, spoiled AS (SELECT event_type, value, CASE WHEN event_id % 7 != 0 THEN value_z_score END AS z, CASE event_id % 11 WHEN 0 THEN -0.5 WHEN 1 THEN 100.5 ELSE value_percentile END AS p,
  value_outlier_flag AS flag, CASE WHEN event_id % 2 = 0 THEN 'Normal' ELSE outlier_severity END AS severity FROM enriched),
checked AS (SELECT event_type, count(*) FILTER (WHERE value IS NOT NULL AND z IS NULL) AS a, count(*) FILTER (WHERE p < 0 OR p > 100) AS b,
  count(*) FILTER (WHERE severity != 'Normal') AS c, count(*) FILTER (WHERE flag != 'None' AND severity = 'Normal') AS d FROM spoiled GROUP BY event_type)
SELECT event_type, 'null_z_score' AS "check", 'value' AS column_name, a AS violations FROM checked
UNION ALL SELECT event_type, 'percentile_out_of_range', 'value', b FROM checked
UNION ALL SELECT event_type, 'outlier_row', 'outlier_severity', c FROM checked
UNION ALL SELECT event_type, 'flag_without_severity', 'outlier_severity', d FROM checked"""
)
def statistics_violations(spark, sf_dir):
    """Enriched rows with missing scores, percentiles out of range and lost severities."""
    key = F.col("event_id")
    spoiled = enriched_events(spark, sf_dir).withColumns(
        {
            "value_z_score": F.when(key % 7 != 0, F.col("value_z_score")),
            "value_percentile": F.when(key % 11 == 0, -0.5).when(key % 11 == 1, 100.5).otherwise(F.col("value_percentile")),
            "outlier_severity": F.when(key % 2 == 0, "Normal").otherwise(F.col("outlier_severity")),
        }
    )
    return S.check_statistics(spoiled, ["value"], ["event_type"])
