"""The tables behind each dashboard view, over the order snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.labels import change_sign
from tidemark.functions.numbers import signed
from tidemark.functions.text import comparison_id, dataset_type, display_subject
from tidemark.operators import compare as C
from tidemark.operators import filters
from tidemark.operators import marts as M
from tidemark.session import materialise
from workload.comparison import SHORT_SQL, short_comparison
from workload.frames import SHORT_SPEC, snapshots, table
from workload.registry import query

ROLES = M.Roles(papers="papers", score="score", hot="hot", cited="cited", field="subject", entity="name")


def shown_comparison(spark, sf_dir):
    """The short comparison with score and citation deltas for the views."""
    compared = short_comparison(spark, sf_dir)
    return compared.withColumn("score_change", F.col("score_2") - F.col("score_1"))


ENTRIES_SQL = f"""{SHORT_SQL}, ent AS (
  SELECT name, subject, status, CASE status WHEN 'only_in_2' THEN 0 WHEN 'unchanged' THEN papers_2 ELSE papers_1 END AS papers_1, papers_2,
    CASE status WHEN 'only_in_2' THEN papers_2 WHEN 'unchanged' THEN 0 ELSE papers_2 - papers_1 END AS paper_change,
    round(CASE status WHEN 'only_in_2' THEN 0.0 WHEN 'unchanged' THEN score_2 ELSE score_1 END, 2) AS score_1, round(score_2, 2) AS score_2,
    round(CASE status WHEN 'only_in_2' THEN score_2 WHEN 'unchanged' THEN 0.0 ELSE score_2 - score_1 END, 2) AS score_change,
    hot_2 AS hot_papers, cited_2 AS times_cited
  FROM cmp WHERE status IN ('changed', 'unchanged') OR (status = 'only_in_2' AND papers_2 > 0)
), roll AS (
  SELECT name, string_agg(DISTINCT subject, ', ' ORDER BY subject) AS subject, CAST(sum(papers_1) AS BIGINT) AS papers_1, CAST(sum(papers_2) AS BIGINT) AS papers_2,
    CAST(sum(paper_change) AS BIGINT) AS paper_change, round(sum(score_1), 2) AS score_1, round(sum(score_2), 2) AS score_2, round(sum(score_change), 2) AS score_change,
    CAST(sum(hot_papers) AS BIGINT) AS hot_papers, coalesce(max(times_cited) FILTER (WHERE times_cited > 0), 0) AS times_cited, CAST(count(DISTINCT subject) AS INTEGER) AS field_count
  FROM ent GROUP BY name
), entity AS (
  SELECT *, CASE WHEN field_count <= 1 THEN 'Single Field' WHEN score_2 >= 1.0 THEN 'Cross-Field' WHEN score_2 >= 0.85 THEN 'Near Cross-Field'
    WHEN score_2 >= 0.7 THEN 'Approaching Cross-Field' ELSE 'Multidisciplinary' END AS category FROM roll
), sig AS (SELECT * FROM ent WHERE status = 'changed' AND paper_change != 0),
multi AS (
  SELECT name, string_agg(DISTINCT subject, ', ' ORDER BY subject) AS fields, CAST(sum(papers_2) AS BIGINT) AS total_papers, CAST(sum(paper_change) AS BIGINT) AS total_change,
    round(sum(score_2), 2) AS total_score, CAST(count(DISTINCT subject) AS INTEGER) AS field_count, 1 AS o
  FROM sig GROUP BY name HAVING count(DISTINCT subject) > 1
), crossf AS (
  SELECT *, total_score >= 1.0 AS is_cross_field, total_score >= 0.85 AND total_score < 1.0 AS is_near_cross_field, total_score >= 0.7 AND total_score < 0.85 AS is_approaching_cross_field,
    CASE WHEN total_score >= 1.0 THEN 'Cross-Field' WHEN total_score >= 0.85 THEN 'Near Cross-Field' WHEN total_score >= 0.7 THEN 'Approaching Cross-Field' ELSE 'Multidisciplinary' END AS category
  FROM (SELECT * FROM multi UNION ALL SELECT name, subject, papers_2, paper_change, score_2, field_count, 0 FROM entity WHERE field_count > 1)
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY field_count DESC, o DESC) = 1
)
"""


def entries(spark, sf_dir):
    return M.entries(shown_comparison(spark, sf_dir), ROLES)


def stored_entries(spark, sf_dir):
    """For views that read the entries several times."""
    return materialise(entries(spark, sf_dir), "entries")


def _flat(df, column="subjects"):
    return df.drop(column)


@query(ENTRIES_SQL + "SELECT * FROM ent")
def entry_list(spark, sf_dir):
    return entries(spark, sf_dir).orderBy(F.desc("paper_change"), "name", "subject")


@query(
    ENTRIES_SQL
    + "SELECT *, lower(replace(replace(category, ' ', ''), '-', '')) AS category_key, CASE WHEN paper_change > 0 THEN 'positive' WHEN paper_change < 0 THEN 'negative' ELSE 'neutral' END AS change_sign FROM entity"
)
def entity_rollup(spark, sf_dir):
    return _flat(M.entities(entries(spark, sf_dir))).orderBy(F.desc("paper_change"), "name")


@query(
    ENTRIES_SQL
    + """SELECT name, fields, total_papers, total_change, total_score, field_count, total_score >= 1.0 AS is_cross_field,
  total_score >= 0.85 AND total_score < 1.0 AS is_near_cross_field, total_score >= 0.7 AND total_score < 0.85 AS is_approaching_cross_field FROM multi"""
)
def changed_multi_field(spark, sf_dir):
    return M.changed_multi_field(entries(spark, sf_dir)).withColumn("fields", F.array_join("fields", ", "))


CROSS_COLUMNS = "name, fields, total_papers, total_change, total_score, field_count, is_cross_field, is_near_cross_field, is_approaching_cross_field, category"


@query(ENTRIES_SQL + f"SELECT {CROSS_COLUMNS} FROM crossf")
def cross_field_list(spark, sf_dir):
    out = M.cross_field(stored_entries(spark, sf_dir)).withColumn("fields", F.array_join("fields", ", "))
    return out.select(*CROSS_COLUMNS.split(", ")).orderBy(F.desc("field_count"), "name")


@query(
    ENTRIES_SQL
    + """SELECT count(*) AS multi_field, count(*) FILTER (WHERE is_cross_field) AS cross_field, count(*) FILTER (WHERE is_near_cross_field) AS near_cross_field,
  count(*) FILTER (WHERE is_approaching_cross_field) AS approaching_cross_field FROM crossf"""
)
def cross_field_counts(spark, sf_dir):
    return M.cross_field_counts(M.cross_field(stored_entries(spark, sf_dir)))


@query(
    ENTRIES_SQL
    + """SELECT s.name, s.subject, s.papers_1, s.papers_2, s.paper_change, s.score_1, s.score_2, s.score_change, s.status FROM sig s
WHERE name IN (SELECT name FROM multi)
  OR (name NOT IN (SELECT name FROM multi) AND (s.name, s.paper_change, s.subject) IN (SELECT name, max(paper_change), max(subject) FROM sig GROUP BY name))"""
)
def unique_changes(spark, sf_dir):
    out = M.unique_changes(stored_entries(spark, sf_dir))
    return out.select("name", "subject", "papers_1", "papers_2", "paper_change", "score_1", "score_2", "score_change", "status")


def top_sql(test: str, order: str) -> str:
    return (
        ENTRIES_SQL
        + f"""SELECT s.*, coalesce(c.total_score, s.score_2) AS total_score, coalesce(c.category, 'Single Field') AS category, c.name IS NOT NULL AS in_cross_field_list
FROM (SELECT * FROM sig WHERE paper_change {test} ORDER BY paper_change {order}, name, subject LIMIT 15) s LEFT JOIN crossf c ON s.name = c.name"""
    )


@query(top_sql("> 0", "DESC"))
def top_increases(spark, sf_dir):
    return M.top_changes(stored_entries(spark, sf_dir), "increase")


@query(
    f"""WITH top AS ({top_sql("> 0", "DESC")}) SELECT name, subject, '+' || paper_change AS shown_change, in_cross_field_list
FROM top ORDER BY paper_change DESC, name, subject LIMIT 10"""
)
def summary_top_changes(spark, sf_dir):
    """The ten changes of the executive summary, as they are displayed."""
    top = M.top_changes(stored_entries(spark, sf_dir), "increase", n=M.TOP_SUMMARY)
    return top.select("name", "subject", signed(F.col("paper_change")).alias("shown_change"), "in_cross_field_list")


@query(top_sql("< 0", "ASC"))
def top_decreases(spark, sf_dir):
    return M.top_changes(stored_entries(spark, sf_dir), "decrease")


SUMMARY_SQL = """SELECT subject, count(papers_1) AS total_1, count(papers_2) AS total_2, count(*) FILTER (WHERE papers_1 IS NOT NULL AND papers_2 IS NOT NULL) AS matched,
  count(*) FILTER (WHERE status = 'changed') AS changed FROM cmp GROUP BY subject"""


@query(
    f"""{SHORT_SQL} SELECT subject, total_1, total_2, round(matched / total_1::DOUBLE * 100, 1) AS retention_rate, round(g, 1) AS growth_rate, changed AS entities_with_changes,
  CASE WHEN g >= 30 THEN 'High Growth' WHEN g >= 15 THEN 'Growing' WHEN g >= 5 THEN 'Expanding' WHEN g >= 0 THEN 'Moderate' WHEN g >= -10 THEN 'Declining' ELSE 'Major Decline' END AS status
FROM (SELECT *, (total_2 - total_1) / total_1::DOUBLE * 100 AS g FROM ({SUMMARY_SQL}))"""
)
def subject_growth(spark, sf_dir):
    summary = C.summarise(short_comparison(spark, sf_dir), SHORT_SPEC)
    return M.subject_growth(summary).orderBy(F.desc("growth_rate"), "subject")


@query(
    f"""{SHORT_SQL} SELECT CAST(sum(total_1) AS BIGINT) AS total_1, CAST(sum(total_2) AS BIGINT) AS total_2, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(changed) AS BIGINT) AS changed,
  count(DISTINCT subject) AS total_subjects, round(sum(changed) / sum(matched)::DOUBLE * 100, 1) AS change_rate, round(sum(matched) / sum(total_1)::DOUBLE * 100, 1) AS retention_rate FROM ({SUMMARY_SQL})"""
)
def executive_summary(spark, sf_dir):
    return M.executive_summary(C.summarise(short_comparison(spark, sf_dir), SHORT_SPEC))


@query(ENTRIES_SQL + "SELECT * FROM ent WHERE contains(lower(name), '0007')")
def search_names(spark, sf_dir):
    return filters.search(entries(spark, sf_dir), "0007")


@query(ENTRIES_SQL + "SELECT name, subject, paper_change FROM ent WHERE subject = '1-URGENT' AND paper_change < 0")
def filtered_entries(spark, sf_dir):
    out = filters.filter_entries(entries(spark, sf_dir), subject="1-URGENT", change="decrease")
    return filters.sort_by(out.select("name", "subject", "paper_change"), "paper_change")


@query(ENTRIES_SQL + "SELECT name, subject, paper_change, category FROM entity WHERE contains(subject, '5-LOW') AND abs(paper_change) >= 5")
def filtered_entities(spark, sf_dir):
    out = filters.filter_entities(M.entities(entries(spark, sf_dir)), subject="5-LOW", show="major")
    return filters.sort_by(out.select("name", "subject", "paper_change", "category"), "name", descending=True)


@query(ENTRIES_SQL + "SELECT category, count(*) AS n_entities, CAST(sum(papers_2) AS BIGINT) AS papers FROM entity WHERE category != 'Single Field' GROUP BY category")
def entity_categories(spark, sf_dir):
    rolled = materialise(M.entities(entries(spark, sf_dir)), "entities")
    parts = [filters.filter_entities(rolled, show=k) for k in filters.CATEGORY_FILTERS if k != "singlefield"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("category").agg(F.count(F.lit(1)).alias("n_entities"), F.sum("papers_2").alias("papers"))


@query("SELECT DISTINCT o_orderpriority AS subject FROM orders")
def subject_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subject"))
    return M.subject_list(orders).orderBy("subject")


@query(
    f"""{SHORT_SQL}, ids AS (SELECT *, lower(replace(split_part(subject, '-', 2), ' ', '_')) AS s FROM ({SUMMARY_SQL}))
SELECT s || '_incites_researchers' AS comparison_id, 'incites_researchers' AS dataset_type,
  CASE s WHEN 'not_specified' THEN 'Not Specified' ELSE upper(s[1]) || s[2:] END AS display_subject, matched,
  CASE WHEN total_2 > total_1 THEN 'positive' WHEN total_2 < total_1 THEN 'negative' ELSE 'neutral' END AS growth FROM ids"""
)
def reports_by_dataset_type(spark, sf_dir):
    summary = C.summarise(short_comparison(spark, sf_dir), SHORT_SPEC)
    subject = F.lower(F.replace(F.split_part("subject", F.lit("-"), F.lit(2)), F.lit(" "), F.lit("_")))
    cid = comparison_id(subject, F.lit("incites_researchers"))
    return summary.select(
        cid.alias("comparison_id"),
        dataset_type(cid).alias("dataset_type"),
        display_subject(cid).alias("display_subject"),
        "matched",
        change_sign(F.col("total_2") - F.col("total_1")).alias("growth"),
    )


@query(
    f"""{SHORT_SQL}, p AS ({SUMMARY_SQL}) SELECT (SELECT count(*) FROM (SELECT DISTINCT subject, period FROM snap)) AS snapshots, (SELECT count(*) FROM snap) AS rows_read,
  count(*) FILTER (WHERE total_1 > 0 AND total_2 > 0) AS successful_comparisons, count(*) FILTER (WHERE total_1 = 0 OR total_2 = 0) AS incomplete_pairs,
  (SELECT count(*) FROM cmp) AS entities, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(changed) AS BIGINT) AS changed FROM p"""
)
def run_summary(spark, sf_dir):
    rows = materialise(snapshots(spark, sf_dir), "snapshots")
    return M.run_summary(rows, C.compare(rows, SHORT_SPEC), ["subject", "period"], ["subject"])
