"""Queries over untidy input: every verdict, check and branch has rows here.

The input is derived from the driver tables by rules that SQL can repeat.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tidemark.functions.numbers import sort_number
from tidemark.operators import compare as C
from tidemark.operators import filters, marts as M, shape
from tidemark.plans import preparation as P
from tidemark.session import scratch_path
from tidemark.sources import reports, snapshots as source
from tidemark.sources.store import Loaded, Store
from tidemark.spec import CompareSpec, Metric
from workload.frames import PERIODS, RAW_ORDERS_SQL, RAW_SPEC, raw_orders, rounded, table
from workload.registry import query
from workload.storage import new_store

# -- names and metrics that are missing ----------------------------------------

HOLES_SQL = f"""{RAW_ORDERS_SQL},
holes AS (SELECT CASE WHEN seq % 10 = 0 THEN NULL ELSE name END AS name, subject, period, seq, CASE WHEN seq % 5 = 1 THEN NULL ELSE price END AS price FROM raw)"""


def holes(spark, sf_dir):
    """Every tenth order has no customer, every fifth no price."""
    return raw_orders(spark, sf_dir).withColumns(
        {"name": F.when(F.col("seq") % 10 != 0, F.col("name")), "price": F.when(F.col("seq") % 5 != 1, F.col("price"))}
    )


def _one_per_name(rows):
    """Named orders, one a customer, and all unnamed ones; the label is text."""
    named = rows.filter("name IS NOT NULL").groupBy("name", "subject", "period").agg(F.sum("price").alias("price"))
    unnamed = rows.filter("name IS NULL").select("name", "subject", "period", "price")
    return named.unionByName(unnamed).withColumn("label", F.concat(F.lit("p"), F.col("price").cast("string")))


@query(
    f"""WITH {HOLES_SQL},
one AS (SELECT name, subject, period, sum(price) AS price FROM holes WHERE name IS NOT NULL GROUP BY ALL),
cmp AS (SELECT coalesce(a.subject, b.subject) AS subject, CASE WHEN b.name IS NULL THEN 'only_in_1' WHEN a.name IS NULL THEN 'only_in_2'
    WHEN a.price != b.price THEN 'changed' WHEN a.price = b.price THEN 'unchanged' ELSE 'unclassified' END AS status
  FROM (SELECT * FROM one WHERE period = 'p1') a FULL OUTER JOIN (SELECT * FROM one WHERE period = 'p2') b ON a.name = b.name AND a.subject = b.subject),
n AS (SELECT subject, status, count(*) AS entities, count(*) FILTER (WHERE status != 'only_in_2') AS rows_1, count(*) FILTER (WHERE status != 'only_in_1') AS rows_2 FROM cmp GROUP BY ALL
  UNION ALL SELECT subject, 'unnamed', 1, count(*) FILTER (WHERE period = 'p1'), count(*) FILTER (WHERE period = 'p2') FROM holes WHERE name IS NULL GROUP BY subject)
SELECT k.payload, subject, status, CAST(entities AS BIGINT) AS entities, CAST(rows_1 AS BIGINT) AS rows_1, CAST(rows_2 AS BIGINT) AS rows_2 FROM n, (SELECT unnest(['numbers', 'text']) AS payload) k"""
)
def unnamed_rows(spark, sf_dir):
    """Rows without a name count alike whether the values hold text or not."""
    rows = _one_per_name(holes(spark, sf_dir))
    spec = CompareSpec((Metric("price"),), PERIODS, pair_by=("subject",), assume_unique=True)
    out = [
        C.compare(rows, s).groupBy("subject", "status").agg(
            F.count(F.lit(1)).alias("entities"), F.sum("rows_1").alias("rows_1"), F.sum("rows_2").alias("rows_2")
        ).withColumn("payload", F.lit(label))
        for label, s in (("numbers", spec), ("text", replace(spec, carry=("label",))))
    ]
    return out[0].unionByName(out[1])


@query(
    f"""WITH {HOLES_SQL} SELECT subject, CAST(count(*) AS BIGINT) AS matched, CAST(sum(b.price - a.price) AS BIGINT) AS total_price_change, round(avg(b.price - a.price), 6) AS avg_price_change
FROM (SELECT * FROM holes WHERE period = 'p1') a JOIN (SELECT * FROM holes WHERE period = 'p2') b USING (name, subject) GROUP BY subject"""
)
def fanout_null_metrics(spark, sf_dir):
    """The plain join of repeated rows skips differences with a null."""
    out = C.fanout_totals(holes(spark, sf_dir), RAW_SPEC)
    return rounded(out, "avg_price_change").select(
        "subject", F.col("matched").cast("bigint").alias("matched"), F.col("total_price_change").cast("bigint").alias("total_price_change"), "avg_price_change"
    )


# -- tolerance and normalised names --------------------------------------------

STEPS_SQL = """steps AS (
  SELECT c_name AS name, c_mktsegment AS subject, p.period, CASE WHEN p.period = 'p1' THEN c_custkey / 8.0
    ELSE c_custkey / 8.0 + CASE c_custkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0005 WHEN 2 THEN 0.002 ELSE -0.0005 END END AS score
  FROM customer, (SELECT unnest(['p1', 'p2']) AS period) p)"""


def steps(spark, sf_dir):
    """Scores that move by 0, half the tolerance, twice the tolerance or back by half."""
    key = F.col("c_custkey")
    step = F.when(key % 4 == 0, 0.0).when(key % 4 == 1, 0.0005).when(key % 4 == 2, 0.002).otherwise(-0.0005)
    customers = table(spark, sf_dir, "customer").withColumn("period", F.explode(F.array(F.lit("p1"), F.lit("p2"))))
    score = key / F.lit(8.0)
    return customers.select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("subject"), "period", F.when(F.col("period") == "p1", score).otherwise(score + step).alias("score")
    )


STEP_SPEC = CompareSpec((Metric("score", 0.001),), PERIODS, pair_by=("subject",), assume_unique=True)


@query(
    f"""WITH {STEPS_SQL} SELECT a.subject, CASE WHEN abs(b.score - a.score) > 0.001 THEN 'changed' ELSE 'unchanged' END AS status,
  count(*) AS n, count(*) FILTER (WHERE a.score != b.score) AS moved FROM steps a JOIN steps b USING (name, subject) WHERE a.period = 'p1' AND b.period = 'p2' GROUP BY ALL"""
)
def tolerance_edges(spark, sf_dir):
    out = C.compare(steps(spark, sf_dir), STEP_SPEC)
    return out.groupBy("subject", "status").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score_1") != F.col("score_2")).alias("moved"))


SPELLED_SQL = f"""{STEPS_SQL},
spelled AS (SELECT CASE WHEN v = 1 THEN '  ' || upper(name) || ' ' ELSE name END AS name, subject, period, score + 10 * v AS score, v AS seq
  FROM steps, (SELECT unnest([0, 1]) AS v) k WHERE v = 0 OR ord % 3 = 0)""".replace("c_mktsegment AS subject", "c_mktsegment AS subject, c_custkey AS ord")


@query(
    f"""WITH {SPELLED_SQL},
k AS (SELECT *, lower(trim(name)) AS key, row_number() OVER (PARTITION BY lower(trim(name)), subject, period ORDER BY seq) AS rn FROM spelled),
f AS (SELECT key, subject, period, max(score) FILTER (WHERE rn = 1) AS score, count(*) AS n FROM k GROUP BY key, subject, period)
SELECT a.subject, CASE WHEN abs(b.score - a.score) > 0.001 THEN 'changed' ELSE 'unchanged' END AS status, count(*) AS n, CAST(sum(a.n) AS BIGINT) AS rows_1, CAST(sum(b.n) AS BIGINT) AS rows_2
FROM f a JOIN f b USING (key, subject) WHERE a.period = 'p1' AND b.period = 'p2' GROUP BY ALL"""
)
def normalised_repeats(spark, sf_dir):
    """A third of the names come in a second spelling; the first row counts."""
    rows = steps(spark, sf_dir).withColumn("ord", F.regexp_extract("name", r"(\d+)$", 1).cast("long"))
    again = rows.filter("ord % 3 = 0").withColumns({"name": F.concat(F.lit("  "), F.upper("name"), F.lit(" ")), "score": F.col("score") + 10, "seq": F.lit(1)})
    both = rows.withColumn("seq", F.lit(0)).unionByName(again).drop("ord")
    spec = CompareSpec((Metric("score"),), PERIODS, pair_by=("subject",), order_by=("seq",))
    out = C.compare_normalised(both, spec)
    return out.groupBy("subject", "status").agg(F.count(F.lit(1)).alias("n"), F.sum("rows_1").alias("rows_1"), F.sum("rows_2").alias("rows_2"))


# -- the store ------------------------------------------------------------------

SHEETS_SQL = """sheets AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE 'n' || o_orderkey END AS name, CASE WHEN o_orderkey % 11 = 0 THEN -1 ELSE o_custkey END AS papers,
    o_orderpriority AS subject, 'p1' AS period, CASE o_orderstatus WHEN 'F' THEN 'f' WHEN 'O' THEN 'o' END AS sheet_type FROM orders)"""


def sheets(spark, sf_dir, *more):
    """Orders as rows of two sheets, and of none."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.when(key % 7 == 0, " ").otherwise(F.concat(F.lit("n"), key.cast("string"))).alias("name"),
        F.when(key % 11 == 0, -1).otherwise(F.col("o_custkey")).cast("bigint").alias("papers"),
        F.col("o_orderpriority").alias("subject"),
        F.lit("p1").alias("period"),
        F.when(status == "F", "f").when(status == "O", "o").alias("sheet_type"),
        *more,
    )


def _loaded(spark, sf_dir) -> tuple[Store, Loaded]:
    store = new_store(spark)
    schemas = {"fit": "name STRING, papers BIGINT", "unfit": "name STRING, orcid STRING"}
    return store, store.load(sheets(spark, sf_dir), schemas, {"f": "fit", "o": "unfit"}, "fit")


@query(
    f"""WITH {SHEETS_SQL} SELECT sheet_type, subject, period, n AS expected_rows, CASE WHEN sheet_type = 'o' THEN NULL ELSE n END AS stored_rows,
  CASE WHEN sheet_type = 'o' THEN 'missing' ELSE 'ok' END AS verdict FROM (SELECT sheet_type, subject, period, count(*) AS n FROM sheets GROUP BY ALL)"""
)
def load_verdicts(spark, sf_dir):
    """One sheet fits, one does not, and rows without a sheet are loaded as well."""
    store, report = _loaded(spark, sf_dir)
    assert report.tables == ["fit"] and list(report.failures) == ["unfit"]
    return store.reconcile("fit", source.extraction_metadata(sheets(spark, sf_dir)))


@query(
    f"""WITH {SHEETS_SQL}, stored AS (SELECT sheet_type, subject, period, count(*) AS stored_rows FROM sheets WHERE sheet_type IS DISTINCT FROM 'o' AND subject != '1-URGENT' GROUP BY ALL),
wanted AS (SELECT sheet_type, subject, period, count(*) + max(CASE WHEN subject = '2-HIGH' THEN 1 ELSE 0 END) AS expected_rows FROM sheets WHERE sheet_type IS DISTINCT FROM 'o' AND subject != '3-MEDIUM' GROUP BY ALL)
SELECT coalesce(w.sheet_type, s.sheet_type) AS sheet_type, coalesce(w.subject, s.subject) AS subject, 'p1' AS period, expected_rows, stored_rows,
  CASE WHEN expected_rows IS NULL THEN 'unexpected' WHEN stored_rows IS NULL THEN 'missing' WHEN expected_rows != stored_rows THEN 'row_count_mismatch' ELSE 'ok' END AS verdict
FROM wanted w FULL OUTER JOIN stored s ON w.subject = s.subject AND w.sheet_type IS NOT DISTINCT FROM s.sheet_type"""
)
def reconciliation_verdicts(spark, sf_dir):
    """All four verdicts: right, missing, unexpected and miscounted snapshots."""
    rows = sheets(spark, sf_dir).filter(~F.col("sheet_type").eqNullSafe("o"))
    store = new_store(spark)
    store.load(rows.filter("subject <> '1-URGENT'"), {"t": "name STRING, papers BIGINT"})
    wanted = source.extraction_metadata(rows.filter("subject <> '3-MEDIUM'"))
    return store.reconcile("t", wanted.withColumn("row_count", F.col("row_count") + F.when(F.col("subject") == "2-HIGH", 1).otherwise(0)))


@query(
    f"""WITH {SHEETS_SQL} SELECT sheet_type, period, subject, c.v[1] AS "check", c.v[2] AS column_name, c.n AS violations
FROM (SELECT sheet_type, period, subject, count(*) FILTER (WHERE papers < 0) AS n1, count(*) FILTER (WHERE trim(name) = '') AS n2 FROM sheets GROUP BY ALL)
CROSS JOIN LATERAL (SELECT unnest([{{'v': ['empty_name', 'name'], 'n': n2}}, {{'v': ['negative', 'papers'], 'n': n1}}]) AS c)"""
)
def store_violations(spark, sf_dir):
    store = new_store(spark)
    store.load(sheets(spark, sf_dir), {"t": "name STRING, papers BIGINT"})
    return store.validate("t", ["name", "papers"], non_negative=["papers"])


@query(
    f"""WITH {SHEETS_SQL} SELECT CASE WHEN sheet_type = 'f' THEN 'first' ELSE 'second' END AS table_name, count(*) AS row_count, 5 AS column_count FROM sheets GROUP BY ALL"""
)
def store_after_drop(spark, sf_dir):
    """Clear, create three tables, drop one of them and one that is not there."""
    store, _ = _loaded(spark, sf_dir)
    store.clear()
    rows = sheets(spark, sf_dir)
    is_f = F.col("sheet_type").eqNullSafe("f")
    for name, mine in (("first", is_f), ("second", ~is_f), ("third", is_f)):
        store.create(rows.filter(mine), name)
    store.drop("third")
    store.drop("never_there")
    return store.summary()


@query(f"WITH {SHEETS_SQL} SELECT sheet_type, count(*) AS n_rows FROM sheets WHERE sheet_type IN ('o', 'f') GROUP BY ALL")
def known_sheets(spark, sf_dir):
    known = filters.of_sheets(sheets(spark, sf_dir), ["f", "o", "x"])
    return source.require_rows(known).groupBy("sheet_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    """SELECT 'o_custkey' AS column_name, 'extra' AS kind, count(o_custkey) AS filled FROM orders
UNION ALL SELECT 'o_orderstatus', 'extra', count(o_orderstatus) FROM orders UNION ALL SELECT 'o_orderdate', 'extra', count(o_orderdate) FROM orders
UNION ALL SELECT 'o_totalprice', 'extra', count(o_totalprice) FROM orders UNION ALL SELECT 'orcid', 'missing', 0"""
)
def column_differences(spark, sf_dir):
    """What a table lacks and has beyond a schema, with the values in each column."""
    orders = table(spark, sf_dir, "orders")
    missing, extra = shape.column_difference(orders, ["o_orderkey", "o_orderpriority", "orcid"])
    counts = orders.agg(*[F.count(c).alias(c) for c in extra], *[F.lit(0).cast("bigint").alias(c) for c in missing])
    long = counts.unpivot([], [*extra, *missing], "column_name", "filled")
    return long.withColumn("kind", F.when(F.col("column_name").isin(missing), "missing").otherwise("extra"))


# -- cleaning --------------------------------------------------------------------


@query(
    """WITH t AS (SELECT c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS name, CASE c_custkey % 6 WHEN 0 THEN 'nan' WHEN 1 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS balance FROM customer)
SELECT c_nationkey, k.c AS "check", k.n AS column_name, CAST(CASE k.c WHEN 'empty_name' THEN e WHEN 'negative' THEN f ELSE g END AS BIGINT) AS violations
FROM (SELECT c_nationkey, count(*) FILTER (WHERE name = '') AS e, count(*) FILTER (WHERE balance < 0) AS f, count(*) FILTER (WHERE segment IS NULL OR segment = 'nan') AS g FROM t GROUP BY ALL),
(SELECT unnest([{'c': 'empty_name', 'n': 'name'}, {'c': 'negative', 'n': 'balance'}, {'c': 'invalid_category', 'n': 'segment'}], recursive := true))  k"""
)
def cleaning_violations(spark, sf_dir):
    """Empty names, negative numbers and missing categories that are there."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_nationkey",
        F.when(key % 5 == 0, "").otherwise(F.col("c_name")).alias("name"),
        F.when(key % 6 == 0, "nan").when(key % 6 != 1, F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    found = P.cleaning_checks(
        rows, by=["c_nationkey"], name="name", category="segment", papers="balance", cited="balance", score="balance", non_negative=["balance"], percents=[]
    )
    return found.filter(F.col("check").isin("empty_name", "negative", "invalid_category"))


# -- reports ----------------------------------------------------------------------

REPORTS_SQL = """r AS (
  SELECT c_custkey, c_mktsegment, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS only_1, count(*) FILTER (WHERE o_orderstatus = 'O') AS only_2, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS changed
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def _reports(spark, sf_dir):
    """A nested report per customer, as JSON lines in a folder per segment; every seventh lacks its totals."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    entity = F.struct(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name"), F.lit(1).cast("bigint").alias("highly_cited_papers"))
    status = F.col("o_orderstatus")
    per_customer = orders.groupBy("c_custkey", "c_mktsegment").agg(
        F.collect_list(F.when(status == "F", entity)).alias("researchers_only_in_dataset_1"),
        F.collect_list(F.when(status == "O", entity)).alias("researchers_only_in_dataset_2"),
        F.collect_list(F.when(~status.isin("F", "O"), entity)).alias("researcher_changes"),
        F.count(F.lit(1)).alias("n"),
    )
    docs = per_customer.select(
        F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"), F.lit("_highly_cited_only")).alias("comparison_id"),
        F.when(F.col("c_custkey") % 7 != 0, F.struct(F.col("n").alias("dataset_1_total"))).alias("summary_statistics"),
        "researchers_only_in_dataset_1", "researchers_only_in_dataset_2", "researcher_changes",
        F.concat(F.lower("c_mktsegment"), F.lit("_highly_cited_only_comparison_report.json")).alias("report"),
    )
    root = scratch_path(spark, "nested")
    docs.write.partitionBy("report").json(f"{root}/highly_cited_only")
    return reports.read_documents(spark, root, lines=True)


@query(
    f"""WITH {REPORTS_SQL} SELECT 'customer_' || c_custkey || '_highly_cited_only' AS comparison_id, 'highly_cited_only' AS sheet_type, lower(c_mktsegment) AS subject,
  'highly_cited_only' AS dataset_type, 'Customer ' || c_custkey AS display_subject, CAST(n AS INTEGER) AS entity_count FROM r WHERE c_custkey % 7 != 0"""
)
def report_reader(spark, sf_dir):
    """Reports are read, checked, named by their path and counted."""
    return reports.document_counts(reports.valid_documents(_reports(spark, sf_dir)))


@query(
    f"""WITH {REPORTS_SQL} SELECT lower(c_mktsegment) || '_highly_cited_only_comparison_report.json' AS source, 'summary_statistics' AS missing, count(*) AS documents FROM r WHERE c_custkey % 7 = 0 GROUP BY ALL"""
)
def report_rejects(spark, sf_dir):
    out = reports.rejected_documents(_reports(spark, sf_dir))
    return out.groupBy(F.regexp_extract("source_file", "([^/=]+)$", 1).alias("source"), "missing").agg(F.count(F.lit(1)).alias("documents"))


@query(
    f"""WITH {HOLES_SQL},
one AS (SELECT name, subject, period, sum(price) AS price FROM holes WHERE name IS NOT NULL GROUP BY ALL),
cmp AS (SELECT coalesce(a.subject, b.subject) AS subject, CASE WHEN b.name IS NULL THEN 'researchers_only_in_dataset_1' WHEN a.name IS NULL THEN 'researchers_only_in_dataset_2'
    WHEN a.price != b.price THEN 'researcher_changes' WHEN a.price = b.price THEN 'researchers_unchanged' ELSE 'researchers_unclassified' END AS section
  FROM (SELECT * FROM one WHERE period = 'p1') a FULL OUTER JOIN (SELECT * FROM one WHERE period = 'p2') b ON a.name = b.name AND a.subject = b.subject)
SELECT section, count(*) AS n, false AS without_name FROM cmp GROUP BY section UNION ALL SELECT 'rows_without_name', count(DISTINCT subject), true FROM holes WHERE name IS NULL"""
)
def report_sections(spark, sf_dir):
    """Every classified row is in a section, also unclassified and unnamed ones."""
    spec = CompareSpec((Metric("price"),), PERIODS, pair_by=("subject",), assume_unique=True)
    root = scratch_path(spark, "sections")
    compared = C.compare(_one_per_name(holes(spark, sf_dir)), spec)
    reports.write_entities(compared, spec, root)
    rows = reports.read_entities(spark, root, "name STRING, status STRING")
    return rows.groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("name").isNull()).alias("without_name"))


@query(
    f"""WITH {HOLES_SQL}, kept AS (SELECT DISTINCT subject, period FROM holes WHERE NOT (subject = '5-LOW' AND period = 'p2') AND NOT (subject = '1-URGENT' AND period = 'p1')),
pairs AS (SELECT subject, count(*) AS n FROM kept GROUP BY subject)
SELECT count(*) AS total_pairs, count(*) FILTER (WHERE n = 2) AS successful_comparisons, count(*) FILTER (WHERE n = 1) AS incomplete_pairs, 'one pair is late' AS error FROM pairs"""
)
def incomplete_pairs(spark, sf_dir):
    rows = holes(spark, sf_dir).filter("NOT (subject = '5-LOW' AND period = 'p2') AND NOT (subject = '1-URGENT' AND period = 'p1')")
    run = reports.run_document(C.pair_coverage(rows, RAW_SPEC), RAW_SPEC, ["one pair is late"], "2000-01-01")
    return run.select("total_pairs", "successful_comparisons", "incomplete_pairs", F.col("errors")[0].alias("error"))


# -- display ------------------------------------------------------------------------


@query(
    """WITH g AS (SELECT c_nationkey, CASE WHEN c_acctbal >= 0 THEN '+' ELSE '-' END || format('{:,}', CAST(floor(abs(c_acctbal)) AS BIGINT)) || '.5%' AS shown,
  CAST(floor(abs(c_acctbal)) AS BIGINT) + 0.5 AS v, c_acctbal >= 0 AS up, c_custkey FROM customer)
SELECT c_custkey, shown, CAST(CASE WHEN up THEN v ELSE -v END AS DOUBLE) AS sort_value FROM g"""
)
def growth_sorted_as_shown(spark, sf_dir):
    """Displayed rates such as ``+1,234.5%`` sort by their number."""
    balance = F.col("c_acctbal")
    shown = F.concat(F.when(balance >= 0, "+").otherwise("-"), F.format_number(F.floor(F.abs(balance)), 0), F.lit(".5%"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", shown.alias("shown"))
    return filters.sort_by(rows.withColumn("sort_value", sort_number(F.col("shown"))), "shown", descending=True, as_number=True)


ENTRIES_SQL = f"""{RAW_ORDERS_SQL}, e AS (
  SELECT CASE WHEN seq % 9 = 0 THEN '  ' ELSE name END AS name, subject, period, count(*) AS papers FROM raw GROUP BY ALL),
moved AS (SELECT a.name, a.subject, b.papers - a.papers AS paper_change FROM e a JOIN e b USING (name, subject) WHERE a.period = 'p1' AND b.period = 'p2' AND a.papers != b.papers AND trim(a.name) != '')"""


@query(f"WITH {ENTRIES_SQL} SELECT name, subject, CAST(paper_change AS BIGINT) AS paper_change FROM moved WHERE paper_change > 0 ORDER BY paper_change DESC, name, subject LIMIT 15")
def top_increases_without_blank_names(spark, sf_dir):
    """A name of blanks only would lead the list."""
    raw = raw_orders(spark, sf_dir).withColumn("name", F.when(F.col("seq") % 9 == 0, "  ").otherwise(F.col("name")))
    rows = raw.groupBy("name", "subject", "period").agg(F.count(F.lit(1)).alias("papers"), F.lit(0).cast("bigint").alias("hot"), F.lit(0).cast("bigint").alias("cited"), F.lit(0.0).alias("score"))
    spec = CompareSpec((Metric("papers"), Metric("score")), PERIODS, pair_by=("subject",), carry=("hot", "cited"), assume_unique=True)
    entries = M.entries(C.compare(rows, spec), M.Roles(papers="papers", hot="hot", cited="cited", score="score", field="subject"))
    return M.top_changes(entries, "increase").select("name", "subject", "paper_change")
