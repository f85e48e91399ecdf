"""Statistics, outliers and duplicates over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import duplicates as D
from tidemark.operators import stats as S
from tidemark.operators.rules import duplicate_check
from workload.comparison import enriched_sql
from workload.frames import rounded, table
from workload.registry import query

STATS = ("mean", "std", "std_pop", "min", "max", "q1", "q3", "iqr")


def profile_sql(source: str, by: str, fields: tuple[str, ...], digits: int) -> str:
    """One SELECT per field, as the long form has one row per field."""

    def r(e: str) -> str:
        return f"round({e}, {digits})"

    return " UNION ALL ".join(
        f"""SELECT {by}, '{f}' AS field, count({f}) AS n, {r(f"avg({f})")} AS mean, {r(f"stddev_samp({f})")} AS std,
  {r(f"stddev_pop({f})")} AS std_pop, min({f})::DOUBLE AS min, max({f})::DOUBLE AS max,
  {r(f"quantile_cont({f}::DOUBLE, 0.25)")} AS q1, {r(f"quantile_cont({f}::DOUBLE, 0.75)")} AS q3,
  {r(f"quantile_cont({f}::DOUBLE, 0.75) - quantile_cont({f}::DOUBLE, 0.25)")} AS iqr FROM {source} GROUP BY {by}"""
        for f in fields
    )


def _profile(df, by, fields, digits):
    out = S.profile(df, fields, [by])
    return rounded(out, "mean", "std", "std_pop", "q1", "q3", "iqr", digits=digits)


LINE_FIELDS = ("l_quantity", "l_extendedprice", "l_discount")


@query(profile_sql("lineitem", "l_returnflag", LINE_FIELDS, 4))
def lineitem_profile(spark, sf_dir):
    """Exact quartiles of three groups that each hold a third of the rows."""
    return _profile(table(spark, sf_dir, "lineitem"), "l_returnflag", LINE_FIELDS, 4)


@query(profile_sql("orders", "o_orderpriority", ("o_totalprice",), 3))
def order_price_profile(spark, sf_dir):
    return _profile(table(spark, sf_dir, "orders"), "o_orderpriority", ("o_totalprice",), 3)


@query(profile_sql("events", "event_type", ("value",), 6))
def event_value_profile(spark, sf_dir):
    return _profile(table(spark, sf_dir, "events"), "event_type", ("value",), 6)


EVENT_SQL = "WITH ev AS (SELECT event_id, event_type, value FROM events)," + enriched_sql(
    "ev", ("value",), "event_type", 3.0, "event_id, event_type, value"
)


def enriched_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return S.with_outliers(events, ["value"], ["event_type"])


@query(
    EVENT_SQL
    + "SELECT event_id, event_type, value, round(value_z_score, 6) AS value_z_score, round(value_percentile, 6) AS value_percentile, value_outlier_flag, outlier_severity FROM enriched"
)
def event_outliers(spark, sf_dir):
    return rounded(enriched_events(spark, sf_dir), "value_z_score", "value_percentile")


ORDER_SQL = "WITH ord AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders)," + enriched_sql(
    "ord", ("o_totalprice",), "o_orderpriority", 1.5, "o_orderkey, o_orderpriority"
)


@query(
    ORDER_SQL
    + "SELECT o_orderkey, o_orderpriority, round(o_totalprice_z_score, 6) AS z_score, round(o_totalprice_percentile, 6) AS percentile, o_totalprice_outlier_flag AS flag, outlier_severity FROM enriched"
)
def order_price_outliers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    out = S.with_outliers(orders, ["o_totalprice"], ["o_orderpriority"], threshold=1.5)
    return rounded(
        out.select(
            "o_orderkey",
            "o_orderpriority",
            F.col("o_totalprice_z_score").alias("z_score"),
            F.col("o_totalprice_percentile").alias("percentile"),
            F.col("o_totalprice_outlier_flag").alias("flag"),
            "outlier_severity",
        ),
        "z_score",
        "percentile",
    )


LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag"
LINE_SQL = (
    f"WITH li AS (SELECT {LINE_KEYS}, l_quantity, l_extendedprice, CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax FROM lineitem),"
    + enriched_sql("li", ("l_quantity", "l_extendedprice"), "l_returnflag", 1.6, f"{LINE_KEYS}, l_quantity, l_extendedprice")
)


def enriched_lines(spark, sf_dir):
    keep = [*LINE_KEYS.split(", "), "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*keep)
    return S.with_outliers(lines, ["l_quantity", "l_extendedprice"], ["l_returnflag"], threshold=1.6)


@query(
    LINE_SQL
    + """SELECT l_returnflag, outlier_severity, l_quantity_outlier_flag, l_extendedprice_outlier_flag, count(*) AS n_rows,
  round(sum(l_quantity_percentile) / count(*), 4) AS mean_quantity_percentile, round(sum(l_extendedprice_percentile) / count(*), 4) AS mean_price_percentile
FROM enriched GROUP BY ALL"""
)
def lineitem_outlier_classes(spark, sf_dir):
    out = (
        enriched_lines(spark, sf_dir)
        .groupBy("l_returnflag", "outlier_severity", "l_quantity_outlier_flag", "l_extendedprice_outlier_flag")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("l_quantity_percentile").alias("mean_quantity_percentile"),
            F.avg("l_extendedprice_percentile").alias("mean_price_percentile"),
        )
    )
    return rounded(out, "mean_quantity_percentile", "mean_price_percentile", digits=4)


@query(
    LINE_SQL
    + """SELECT l_returnflag, outlier_severity, n_rows, round(100.0 * n_rows / sum(n_rows) OVER w, 6) AS share,
  round(100.0 * (sum(CASE WHEN outlier_severity != 'Normal' THEN n_rows ELSE 0 END) OVER w) / sum(n_rows) OVER w, 6) AS outlier_rate
FROM (SELECT l_returnflag, outlier_severity, count(*) AS n_rows FROM enriched GROUP BY ALL) WINDOW w AS (PARTITION BY l_returnflag)"""
)
def severity_distribution(spark, sf_dir):
    out = S.severity_distribution(enriched_lines(spark, sf_dir), ["l_returnflag"])
    return rounded(out, "share", "outlier_rate")


@query(
    LINE_SQL
    + """SELECT l_returnflag, count(*) AS total_rows, count(*) FILTER (WHERE outlier_severity != 'Normal') AS outlier_rows,
  round(100.0 * count(*) FILTER (WHERE outlier_severity != 'Normal') / count(*), 6) AS outlier_rate,
  100.0 * count(*) FILTER (WHERE outlier_severity != 'Normal') / count(*) > 20 AS high_outlier_rate FROM enriched GROUP BY l_returnflag"""
)
def outlier_rate(spark, sf_dir):
    return rounded(S.outlier_rate(enriched_lines(spark, sf_dir), ["l_returnflag"]), "outlier_rate")


@query(
    EVENT_SQL
    + """, checked AS (
  SELECT event_type, count(*) FILTER (WHERE value IS NOT NULL AND value_z_score IS NULL) AS a,
    count(*) FILTER (WHERE value_percentile < 0 OR value_percentile > 100) AS b, count(*) FILTER (WHERE outlier_severity != 'Normal') AS c,
    count(*) FILTER (WHERE value_outlier_flag != 'None' AND outlier_severity = 'Normal') AS d FROM enriched GROUP BY event_type)
SELECT event_type, 'null_z_score' AS "check", 'value' AS column_name, a AS violations FROM checked
UNION ALL SELECT event_type, 'percentile_out_of_range', 'value', b FROM checked
UNION ALL SELECT event_type, 'outlier_row', 'outlier_severity', c FROM checked
UNION ALL SELECT event_type, 'flag_without_severity', 'outlier_severity', d FROM checked"""
)
def statistics_checks(spark, sf_dir):
    return S.check_statistics(enriched_events(spark, sf_dir), ["value"], ["event_type"])


def outlier_report_sql(source: str, by: str, fields: tuple[str, ...], threshold: float) -> str:
    return " UNION ALL ".join(
        f"""SELECT {by}, '{f}' AS field, count(*) AS n,
  count(*) FILTER (WHERE {f} < q1 - 1.5 * (q3 - q1) OR {f} > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
  count(*) FILTER (WHERE s > 0 AND abs(({f} - m) / s) > {threshold}) AS z_outliers
  FROM {source} JOIN (SELECT {by}, avg({f}) AS m, stddev_pop({f}) AS s, quantile_cont({f}::DOUBLE, 0.25) AS q1, quantile_cont({f}::DOUBLE, 0.75) AS q3
    FROM {source} GROUP BY {by}) USING ({by}) GROUP BY {by}"""
        for f in fields
    )


@query(outlier_report_sql("lineitem", "l_returnflag", LINE_FIELDS, 1.6))
def lineitem_outlier_report(spark, sf_dir):
    return S.outlier_report(table(spark, sf_dir, "lineitem"), LINE_FIELDS, ["l_returnflag"], threshold=1.6)


@query(outlier_report_sql("events", "event_type", ("value",), 3))
def event_outlier_report(spark, sf_dir):
    return S.outlier_report(table(spark, sf_dir, "events"), ["value"], ["event_type"])


PART_GROUPS = """WITH grp AS (
  SELECT lower(p_name) AS n, lower(p_brand) AS b, count(*) AS n_rows, row_number() OVER (ORDER BY lower(p_name), lower(p_brand)) AS g
  FROM part GROUP BY lower(p_name), lower(p_brand) HAVING count(*) > 1)"""


@query(
    PART_GROUPS
    + """
SELECT p_partkey, p_name, p_brand, g IS NOT NULL AS is_duplicate,
  CASE WHEN g IS NULL THEN '' ELSE 'p_name:' || n || ' | p_brand:' || b END AS duplicate_profile,
  CASE WHEN g IS NULL THEN '' ELSE printf('DUP_%04d', g) END AS duplicate_group_id
FROM part LEFT JOIN grp ON lower(p_name) = n AND lower(p_brand) = b"""
)
def part_duplicate_flags(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return D.flag_duplicates(parts, ["p_name", "p_brand"])


@query(PART_GROUPS + "SELECT n AS p_name, b AS p_brand, n_rows, n_rows - 1 AS surplus FROM grp")
def part_duplicate_groups(spark, sf_dir):
    return D.duplicate_groups(table(spark, sf_dir, "part"), ["p_name", "p_brand"])


@query(
    """SELECT p_type, count(*) AS duplicate_groups, CAST(sum(n) AS BIGINT) AS duplicate_rows, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
FROM (SELECT p_type, p_name, p_brand, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1) GROUP BY p_type"""
)
def part_duplicate_counts(spark, sf_dir):
    return D.duplicate_counts(table(spark, sf_dir, "part"), ["p_name", "p_brand"], ["p_type"])


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) = 1")
def part_keep_first(spark, sf_dir):
    return D.remove_duplicates(table(spark, sf_dir, "part"), ["p_name", "p_brand"], ["p_partkey"])


@query(
    """SELECT p_type, 'duplicate_key' AS "check", 'p_name|p_brand' AS column_name, CAST(sum(n) AS BIGINT) AS violations
FROM (SELECT p_type, p_name, p_brand, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1) GROUP BY p_type"""
)
def part_duplicate_check(spark, sf_dir):
    return duplicate_check(table(spark, sf_dir, "part"), ["p_name", "p_brand"], ["p_type"])


@query(
    """WITH t AS (SELECT doc_id, lang, lower(trim(text, E' \\t\\n\\r\\f\\v')) AS k FROM documents),
g AS (SELECT lang, k, row_number() OVER (PARTITION BY lang ORDER BY k) AS g FROM t GROUP BY lang, k HAVING count(*) > 1)
SELECT t.doc_id, t.lang, g.g IS NOT NULL AS is_duplicate, CASE WHEN g.g IS NULL THEN '' ELSE printf('DUP_%04d', g.g) END AS duplicate_group_id
FROM t LEFT JOIN g ON t.lang = g.lang AND t.k = g.k"""
)
def document_duplicate_flags(spark, sf_dir):
    """Exact copies among whole texts, case and outer blanks aside."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return D.flag_duplicates(docs, ["text"], ["lang"]).select("doc_id", "lang", "is_duplicate", "duplicate_group_id")
