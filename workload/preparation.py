"""Normalising, null handling and quality checks over the driver tables.

The tables are clean, so some queries derive untidy columns first, by the same
expression in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.operators import filters, nulls, rules, shape
from tidemark.plans import preparation as P
from tidemark.spec import LightTransform, Rule
from workload.frames import RAW_ORDERS_SQL, raw_orders, table
from workload.registry import query

# -- categories, text and numbers -----------------------------------------

SEGMENTS = {
    "automobile": "Automobile Industry",
    "building": "Building Trade",
    "furniture": "Furniture Making",
    "household": "Household Goods",
}


def untidy_customers(spark, sf_dir):
    """Market segments in three spellings; one segment is not in the map."""
    spelled = (
        F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("\t"), F.lower("c_mktsegment"), F.lit(" \n")))
        .when(F.col("c_nationkey") % 3 == 1, F.initcap("c_mktsegment"))
        .when(F.col("c_nationkey") == 2, F.lit("  "))
        .when(F.col("c_nationkey") != 5, F.col("c_mktsegment"))
    )
    return table(spark, sf_dir, "customer").withColumn("segment", spelled)


UNTIDY_SQL = """untidy AS (
  SELECT *, CASE WHEN c_nationkey % 3 = 0 THEN chr(9) || lower(c_mktsegment) || ' ' || chr(10)
    WHEN c_nationkey % 3 = 1 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
    WHEN c_nationkey = 2 THEN '  ' WHEN c_nationkey != 5 THEN c_mktsegment END AS segment FROM customer
)"""


def canonical_sql(c: str, other: str) -> str:
    stripped = f"trim(coalesce({c}, ''), ' ' || chr(9) || chr(10))"
    cases = " ".join(f"WHEN lower({stripped}) = '{k}' THEN '{v}'" for k, v in SEGMENTS.items())
    return f"CASE WHEN {stripped} = '' THEN coalesce({c}, '') {cases} ELSE {other.format(stripped=stripped)} END"


@query(f"WITH {UNTIDY_SQL} SELECT c_custkey, {canonical_sql('segment', '{stripped}')} AS segment FROM untidy")
def canonical_category(spark, sf_dir):
    return untidy_customers(spark, sf_dir).select("c_custkey", X.canonical(F.col("segment"), SEGMENTS).alias("segment"))


@query(f"WITH {UNTIDY_SQL} SELECT {canonical_sql('segment', repr('Unknown'))} AS segment, count(*) AS n_rows FROM untidy GROUP BY ALL")
def canonical_category_default(spark, sf_dir):
    spelled = X.canonical(F.col("segment"), SEGMENTS, unknown="use_default").alias("segment")
    return untidy_customers(spark, sf_dir).groupBy(spelled).agg(F.count(F.lit(1)).alias("n_rows"))


SEGMENT_SETTINGS = LightTransform(
    column_mapping={},
    schema="segment STRING",
    category_column="segment",
    canonical=SEGMENTS,
    duplicate_keys=(),
    critical=(),
    never_null=(),
    by=("c_nationkey",),
)


@query(
    f"""WITH {UNTIDY_SQL} SELECT c_nationkey, count(*) AS records_processed,
  count(*) FILTER (WHERE coalesce(segment, '') != {canonical_sql('segment', '{stripped}')}) AS records_changed FROM untidy GROUP BY c_nationkey"""
)
def category_change_counts(spark, sf_dir):
    return P.category_changes(untidy_customers(spark, sf_dir), SEGMENT_SETTINGS, ["c_nationkey"])


@query(
    """SELECT o_orderkey, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') AS subject,
  trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_') || '_p1_' || lower(o_orderstatus) AS table_name FROM orders"""
)
def snake_case_names(spark, sf_dir):
    subject = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.snake_case(subject).alias("subject"),
        X.table_name(subject, F.lit("P1"), F.col("o_orderstatus")).alias("table_name"),
    )


@query(
    """WITH t AS (SELECT event_id, event_type || '_area_' || CASE WHEN user_id % 2 = 0 THEN 'feb' ELSE 'july' END || '_highly_cited_only' AS n FROM events)
SELECT event_id, split_part(n, '_', 1) || '_area' AS subject, split_part(n, '_', 3) AS period, 'highly_cited_only' AS sheet_type,
  split_part(n, '_', 1) || '_area_highly_cited_only' AS comparison_id, upper(n[1]) || split_part(n[2:], '_', 1) || ' Area' AS display_subject,
  'highly_cited_only' AS dataset_type FROM t"""
)
def table_name_parts(spark, sf_dir):
    period = F.when(F.col("user_id") % 2 == 0, "feb").otherwise("july")
    name = F.concat_ws("_", "event_type", F.lit("area"), period, F.lit("highly_cited_only"))
    parts = X.parse_table_name(name, ("feb", "july"))
    split = table(spark, sf_dir, "events").select("event_id", F.inline(F.array(parts)))
    cid = X.comparison_id(F.col("subject"), F.col("sheet_type"))
    return split.select(
        "*", cid.alias("comparison_id"), X.display_subject(cid).alias("display_subject"), X.dataset_type(cid).alias("dataset_type")
    )


# Numbers with a fraction, an exponent, a prefix or nothing at all.
UNTIDY_NUMBER_SQL = """CASE p_size % 7 WHEN 0 THEN 'x' || p_size WHEN 1 THEN ' ' || p_size || '.7 ' WHEN 2 THEN NULL
  WHEN 3 THEN p_size || 'e1' WHEN 4 THEN '' ELSE CAST(p_size AS VARCHAR) END"""


def untidy_number():
    size = F.col("p_size").cast("string")
    kind = F.col("p_size") % 7
    return (
        F.when(kind == 0, F.concat(F.lit("x"), size))
        .when(kind == 1, F.concat(F.lit(" "), size, F.lit(".7 ")))
        .when(kind == 2, F.lit(None))
        .when(kind == 3, F.concat(size, F.lit("e1")))
        .when(kind == 4, F.lit(""))
        .otherwise(size)
    )


@query(
    f"""WITH t AS (SELECT p_partkey, {UNTIDY_NUMBER_SQL} AS raw FROM part)
SELECT p_partkey, coalesce(raw, '?') AS raw, CAST(coalesce(trunc(TRY_CAST(trim(raw) AS DOUBLE)), 0) AS BIGINT) AS as_long,
  coalesce(TRY_CAST(trim(raw) AS DOUBLE), 0.0) AS as_double, raw IS NOT NULL AND TRY_CAST(trim(raw) AS DOUBLE) IS NULL AS bad FROM t"""
)
def safe_numbers(spark, sf_dir):
    raw = F.col("raw")
    return (
        table(spark, sf_dir, "part")
        .select("p_partkey", untidy_number().alias("raw"))
        .select(
            "p_partkey",
            F.coalesce(raw, F.lit("?")).alias("raw"),
            N.lenient_long(raw).alias("as_long"),
            N.lenient_double(raw).alias("as_double"),
            N.non_numeric(raw).alias("bad"),
        )
    )


# -- headers and types ------------------------------------------------------

MAPPING = {
    "name": "C Name",
    "rank": "C CustKey",
    "times_cited": "C AcctBal",
    "esi_field": "C MktSegment",
    "hot_papers": "Hot Papers",
    "indicative_score": "Indicative Score",
    "affiliation": "Affiliation",
}
MAPPED_SCHEMA = (
    "name STRING, rank INT, times_cited INT, esi_field STRING, hot_papers INT, indicative_score DOUBLE, affiliation STRING"
)


@query("SELECT c_name AS name, c_custkey AS rank, c_acctbal AS times_cited, c_mktsegment AS esi_field, 0 AS hot_papers, CAST(0 AS DOUBLE) AS indicative_score, '' AS affiliation FROM customer")
def mapped_headers(spark, sf_dir):
    """Headers match in snake case, one is dropped, three are filled in."""
    source = shape.clean_headers(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", " C_CustKey "))
    variants = {"name": ["c-name"], "rank": ["c custkey"], "times_cited": ["c.acctbal"], "esi_field": ["c mktsegment"]}
    return shape.map_headers(source, MAPPING, MAPPED_SCHEMA, variants=variants, critical=["name", "rank"])


@query(
    "SELECT trim(c_name) AS name, CAST(c_custkey AS INTEGER) AS rank, CAST(trunc(c_acctbal) AS INTEGER) AS times_cited, c_mktsegment AS esi_field, 0 AS hot_papers, CAST(0 AS DOUBLE) AS indicative_score, '' AS affiliation FROM customer"
)
def typed_columns(spark, sf_dir):
    mapped = shape.map_headers(
        table(spark, sf_dir, "customer"), MAPPING, MAPPED_SCHEMA, variants={"name": ["c name"]}, missing="blank"
    )
    return shape.typed(mapped, MAPPED_SCHEMA)


# -- missing values ---------------------------------------------------------

HOLES_SQL = """holes AS (
  SELECT p_partkey, CASE WHEN p_size % 7 != 0 THEN p_size % 7 END AS size, CASE WHEN p_size % 5 != 0 THEN p_retailprice END AS price,
         CASE WHEN p_size % 11 != 0 THEN p_type END AS kind, p_brand FROM part
)"""


def holes(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size % 7 != 0, size % 7).alias("size"),
        F.when(size % 5 != 0, F.col("p_retailprice")).alias("price"),
        F.when(size % 11 != 0, F.col("p_type")).alias("kind"),
        "p_brand",
    )


DEFAULTS = {"size": 0, "price": 0.0, "kind": "Unknown"}


@query(f"WITH {HOLES_SQL} SELECT p_partkey, coalesce(size, 0) AS size, coalesce(price, 0.0) AS price, coalesce(kind, 'Unknown') AS kind, p_brand FROM holes")
def nulls_default(spark, sf_dir):
    return nulls.handle_nulls(holes(spark, sf_dir), "default", DEFAULTS, critical=["p_partkey", "p_brand"])


@query(f"WITH {HOLES_SQL} SELECT * FROM holes WHERE size IS NOT NULL AND price IS NOT NULL AND kind IS NOT NULL")
def nulls_skip(spark, sf_dir):
    return nulls.handle_nulls(holes(spark, sf_dir), "skip", critical=["p_partkey"])


@query(f"WITH {HOLES_SQL} SELECT p_partkey, p_brand, coalesce(kind, '?') AS kind FROM holes WHERE size IS NOT NULL AND price IS NOT NULL")
def nulls_skip_critical(spark, sf_dir):
    out = nulls.critical_nulls(holes(spark, sf_dir), "skip", ["kind", "size", "price"], name="kind")
    return out.select("p_partkey", "p_brand", F.coalesce("kind", F.lit("?")).alias("kind"))


@query(
    f"""WITH {HOLES_SQL}, n AS (SELECT p_brand, count(*) - count(size) AS size, count(*) - count(price) AS price, count(*) - count(kind) AS kind FROM holes GROUP BY p_brand)
SELECT p_brand, 'size' AS column_name, size AS null_count FROM n UNION ALL SELECT p_brand, 'price', price FROM n UNION ALL SELECT p_brand, 'kind', kind FROM n"""
)
def null_counts(spark, sf_dir):
    return nulls.null_counts(holes(spark, sf_dir), ["size", "price", "kind"], ["p_brand"])


# -- name and field filters -------------------------------------------------

ODD_NAME_SQL = """CASE c_nationkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'nan' WHEN 3 THEN 'None' WHEN 4 THEN 'NaN'
  WHEN 5 THEN CAST(c_custkey AS VARCHAR) WHEN 6 THEN 'N/A' WHEN 7 THEN 'q' ELSE c_name END"""


def odd_names(spark, sf_dir):
    kind = F.col("c_nationkey") % 9
    name = F.when(kind == 0, F.lit(None))
    for i, text in ((1, "  "), (2, "nan"), (3, "None"), (4, "NaN"), (6, "N/A"), (7, "q")):
        name = name.when(kind == i, text)
    name = name.when(kind == 5, F.col("c_custkey").cast("string")).otherwise(F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


ODD_SQL = f"WITH odd AS (SELECT c_custkey, {ODD_NAME_SQL} AS name FROM customer) "


@query(ODD_SQL + "SELECT * FROM odd WHERE name IS NOT NULL AND trim(name) != '' AND name != 'nan' AND lower(name) != 'none'")
def valid_names(spark, sf_dir):
    return filters.with_valid_names(odd_names(spark, sf_dir))


@query(ODD_SQL + "SELECT * FROM odd WHERE name IS NOT NULL AND trim(name) != '' AND lower(trim(name)) != 'nan'")
def comparable_names(spark, sf_dir):
    return filters.with_comparable_names(odd_names(spark, sf_dir))


@query(ODD_SQL + "SELECT * FROM odd WHERE length(trim(name)) >= 2 AND lower(trim(name)) NOT IN ('nan', 'none', 'null', '', 'n/a', 'unknown') AND NOT regexp_full_match(trim(name), '[0-9]+')")
def plausible_fields(spark, sf_dir):
    return filters.with_plausible_field(odd_names(spark, sf_dir), "name")


# -- checks -----------------------------------------------------------------


def long_sql(source: str, by: str, checks: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT {by}, '{check}' AS "check", '{column}' AS column_name, count(*) FILTER (WHERE {test}) AS violations FROM {source} GROUP BY {by}"""
        for check, column, test in checks
    )


PART_RULES = (
    Rule("p_size", min_value=5, max_value=45, required=True),
    Rule("p_retailprice", min_value=905.5, max_value=1000),
    Rule("p_name", min_length=9, required=True),
)


@query(
    long_sql(
        "part",
        "p_type",
        [
            ("below_minimum", "p_size", "p_size < 5"),
            ("above_maximum", "p_size", "p_size > 45"),
            ("below_minimum", "p_retailprice", "p_retailprice < 905.5"),
            ("above_maximum", "p_retailprice", "p_retailprice > 1000"),
            ("not_a_number", "p_size", "false"),
            ("required_empty", "p_size", "p_size IS NULL"),
            ("not_a_number", "p_retailprice", "false"),
            ("too_short", "p_name", "length(trim(p_name)) < 9"),
            ("required_empty", "p_name", "p_name IS NULL OR trim(p_name) = ''"),
        ],
    )
)
def rule_violations(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return rules.count_violations(parts, rules.rule_predicates(parts, PART_RULES), ["p_type"])


@query(
    "WITH t AS (SELECT p_brand, "
    + UNTIDY_NUMBER_SQL
    + """ AS size, p_name FROM part)
SELECT * FROM ("""
    + long_sql(
        "t",
        "p_brand",
        [
            ("non_numeric", "size", "size IS NOT NULL AND TRY_CAST(trim(size) AS DOUBLE) IS NULL"),
            ("below_minimum", "size", "TRY_CAST(trim(size) AS DOUBLE) < 10"),
            ("above_maximum", "size", "TRY_CAST(trim(size) AS DOUBLE) > 300"),
            ("null_value", "size", "size IS NULL"),
            ("null_value", "p_name", "p_name IS NULL"),
        ],
    )
    + """ UNION ALL SELECT p_brand, 'duplicate_key', 'p_name', CAST(sum(n) AS BIGINT) FROM (SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1) GROUP BY p_brand
  UNION ALL SELECT NULL, 'missing_column', 'rank', 1) WHERE violations > 0"""
)
def validation_checks(spark, sf_dir):
    """All five checks at once; one critical column is missing."""
    parts = table(spark, sf_dir, "part").select("p_brand", untidy_number().alias("size"), "p_name")
    return rules.run_checks(
        parts,
        critical=["size", "p_name", "rank"],
        numeric=["size"],
        rules=[Rule("size", min_value=10, max_value=300)],
        keys=["p_name"],
        by=["p_brand"],
    )


@query(
    long_sql(
        "lineitem",
        "l_returnflag",
        [
            ("empty_name", "l_linestatus", "l_linestatus IS NULL OR trim(l_linestatus) = ''"),
            ("negative", "l_quantity", "l_quantity < 0"),
            ("negative", "l_discount", "l_discount < 0"),
            ("invalid_category", "l_returnflag", "l_returnflag IS NULL OR trim(l_returnflag) = '' OR l_returnflag = 'nan'"),
            ("papers_but_low_citations", "l_discount", "l_discount > 0 AND l_quantity < 100"),
            ("percent_out_of_range", "l_extendedprice", "l_extendedprice < 0 OR l_extendedprice > 100"),
            ("high_score_without_papers", "l_quantity", "l_quantity > 5 AND l_discount = 0"),
        ],
    )
)
def cleaning_checks(spark, sf_dir):
    return P.cleaning_checks(
        table(spark, sf_dir, "lineitem"),
        by=["l_returnflag"],
        name="l_linestatus",
        category="l_returnflag",
        papers="l_discount",
        cited="l_quantity",
        score="l_quantity",
        non_negative=["l_quantity", "l_discount"],
        percents=["l_extendedprice"],
    )


_NULL_LIKE = "(name IS NULL OR trim(name) = '' OR lower(trim(name)) IN ('nan', 'none', 'null', 'n/a'))"


@query(
    "WITH odd AS (SELECT c_mktsegment, c_acctbal, "
    + ODD_NAME_SQL
    + " AS name FROM customer) "
    + long_sql(
        "odd",
        "c_mktsegment",
        [
            ("negative", "c_acctbal", "c_acctbal < 0"),
            ("very_high", "c_acctbal", "c_acctbal > 9000"),
            ("not_numeric", "c_acctbal", "false"),
            ("null_like", "name", _NULL_LIKE),
            ("numeric_text", "name", f"NOT {_NULL_LIKE} AND regexp_full_match(trim(name), '[0-9]+')"),
            ("very_short", "name", f"NOT {_NULL_LIKE} AND NOT regexp_full_match(trim(name), '[0-9]+') AND length(trim(name)) < 3"),
        ],
    )
)
def sanity_checks(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    odd = odd_names(spark, sf_dir).join(base, "c_custkey")
    return rules.count_violations(odd, rules.sanity_predicates(odd, {"c_acctbal": 9000}, ["name"]), ["c_mktsegment"])


# -- whole chains -----------------------------------------------------------

PART_MAPPING = {"name": "P Name", "esi_field": "P Type", "hot_papers": "P Size", "times_cited": "P RetailPrice", "orcid": "ORCID"}
PART_SETTINGS = LightTransform(
    column_mapping=PART_MAPPING,
    schema="name STRING, esi_field STRING, hot_papers INT, times_cited INT, orcid STRING",
    category_column="esi_field",
    canonical={"economy": "Economy Class", "small": "Small Size"},
    duplicate_keys=("name", "esi_field"),
    critical=("name", "esi_field"),
    never_null=("name", "esi_field"),
    null_defaults={"hot_papers": 0},
    rules=(Rule("hot_papers", min_value=5, max_value=45),),
    numeric=("hot_papers", "times_cited"),
    by=("p_brand",),
)
PREPARED_SQL = """src AS (
  SELECT p_brand, p_name AS name, CASE lower(trim(p_type)) WHEN 'economy' THEN 'Economy Class' WHEN 'small' THEN 'Small Size' ELSE trim(p_type) END AS esi_field,
    CASE WHEN p_size % 7 != 0 THEN p_size END AS hot_papers, p_retailprice AS times_cited, '' AS orcid, p_type FROM part
), grp AS (
  SELECT p_brand, lower(name) AS n, lower(esi_field) AS e, row_number() OVER (PARTITION BY p_brand ORDER BY lower(name), lower(esi_field)) AS g
  FROM src GROUP BY p_brand, lower(name), lower(esi_field) HAVING count(*) > 1
), prep AS (
  SELECT s.p_brand, name, esi_field, coalesce(hot_papers, 0) AS hot_papers, times_cited, orcid, g IS NOT NULL AS is_duplicate,
    CASE WHEN g IS NULL THEN '' ELSE 'name:' || n || ' | esi_field:' || e END AS duplicate_profile,
    CASE WHEN g IS NULL THEN '' ELSE printf('DUP_%04d', g) END AS duplicate_group_id, p_type
  FROM src s LEFT JOIN grp ON s.p_brand = grp.p_brand AND lower(name) = n AND lower(esi_field) = e
)"""


def raw_parts(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_brand", "p_name", "p_type", F.when(size % 7 != 0, size).alias("p_size"), "p_retailprice"
    )


def mapped_parts(spark, sf_dir):
    return shape.map_headers(raw_parts(spark, sf_dir), PART_MAPPING, PART_SETTINGS.schema, keep=["p_brand"])


@query(f"WITH {PREPARED_SQL} SELECT * EXCLUDE (p_type) FROM prep")
def light_transform(spark, sf_dir):
    """Headers, category, duplicate flags and null defaults in one chain."""
    return P.light_transform(raw_parts(spark, sf_dir), PART_SETTINGS)


@query(
    f"""WITH {PREPARED_SQL} SELECT p_brand, count(*) AS records_processed, count(*) FILTER (WHERE p_type != esi_field) AS records_changed,
  count(*) FILTER (WHERE is_duplicate) AS duplicates_flagged, count(DISTINCT duplicate_group_id) FILTER (WHERE is_duplicate) AS duplicate_groups FROM prep GROUP BY p_brand"""
)
def light_transform_counts(spark, sf_dir):
    mapped = mapped_parts(spark, sf_dir)
    return P.transform_counts(mapped, P.light_transform(mapped, PART_SETTINGS, mapped=True), PART_SETTINGS)


@query(
    f"""WITH {PREPARED_SQL}, d AS (SELECT p_brand, sum(n) AS v FROM (SELECT p_brand, count(*) AS n FROM prep GROUP BY p_brand, name, esi_field HAVING count(*) > 1) GROUP BY p_brand)
SELECT p_brand, 'below_minimum' AS "check", 'hot_papers' AS column_name, count(*) AS violations FROM prep WHERE hot_papers < 5 GROUP BY p_brand
UNION ALL SELECT p_brand, 'above_maximum', 'hot_papers', count(*) FROM prep WHERE hot_papers > 45 GROUP BY p_brand
UNION ALL SELECT p_brand, 'duplicate_key', 'name|esi_field', CAST(v AS BIGINT) FROM d"""
)
def light_transform_checks(spark, sf_dir):
    return P.validate(P.light_transform(raw_parts(spark, sf_dir), PART_SETTINGS), PART_SETTINGS)


CLEAN_SETTINGS = LightTransform(
    column_mapping={},
    schema="name STRING, price BIGINT",
    category_column="",
    canonical={},
    duplicate_keys=("name",),
    critical=("name", "price"),
    never_null=("name",),
    by=("subject", "period"),
)
CLEANED_SQL = f"WITH {RAW_ORDERS_SQL}, cleaned AS (SELECT subject, period, name, seq, price FROM raw QUALIFY row_number() OVER (PARTITION BY subject, period, name ORDER BY seq) = 1)"


@query(CLEANED_SQL + " SELECT * FROM cleaned")
def cleaned_snapshots(spark, sf_dir):
    return P.clean(raw_orders(spark, sf_dir), CLEAN_SETTINGS, order_by=["seq"])


@query(
    CLEANED_SQL
    + """ SELECT subject, period, rows_before, rows_after, rows_before - rows_after AS rows_removed, 'cleaned' AS status
FROM (SELECT subject, period, count(*) AS rows_before FROM raw GROUP BY ALL) JOIN (SELECT subject, period, count(*) AS rows_after FROM cleaned GROUP BY ALL) USING (subject, period)"""
)
def cleaning_summary(spark, sf_dir):
    raw = raw_orders(spark, sf_dir)
    return P.cleaning_summary(raw, P.clean(raw, CLEAN_SETTINGS, order_by=["seq"]), ["subject", "period"])
