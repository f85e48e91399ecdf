"""Scalar expressions, by table."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import labels as L
from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.presets import CANONICAL_FIELDS


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_snake_case(spark):
    cases = {
        "Highly Cited Papers": "highly_cited_papers",
        "  ESI Field\t": "esi_field",
        "% Docs Cited": "docs_cited",
        "a--b__c": "a_b_c",
        "": "",
        None: "",
        "___": "",
    }
    assert column(spark, list(cases), X.snake_case) == list(cases.values())


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("agricultural sciences", "Agricultural Sciences"),
        ("biology_biochemistry", "Biology Biochemistry"),
        ("CHEMISTRY", "Chemistry"),
        ("Computer Science", "Computer Science"),
        ("  chemistry  ", "Chemistry"),
        ("\tcomputer science\n", "Computer Science"),
        ("engineering ", "Engineering"),
        ("Unknown Field ", "Unknown Field"),
        ("Invalid ESI", "Invalid ESI"),
        ("", ""),
        ("   ", "   "),
        (None, ""),
    ],
)
def test_canonical(spark, raw, expected):
    assert column(spark, [raw], lambda c: X.canonical(c, CANONICAL_FIELDS)) == [expected]


def test_canonical_strategies(spark):
    assert column(spark, ["odd", "physics"], lambda c: X.canonical(c, CANONICAL_FIELDS, "use_default")) == [
        "Unknown",
        "Physics",
    ]
    with pytest.raises(Exception, match="unknown category: odd"):
        column(spark, ["odd"], lambda c: X.canonical(c, CANONICAL_FIELDS, "flag_error"))
    with pytest.raises(ValueError):
        X.canonical(F.col("v"), {}, "interpolate")


def test_names(spark):
    names = ["Ada", None, "", "  ", "nan", "NaN", "None", "NONE"]
    assert column(spark, names, X.valid_name) == [True, False, False, False, False, True, False, False]
    assert column(spark, names, X.comparable_name) == [True, False, False, False, False, False, True, True]


def test_plausible_field(spark):
    good = ["Engineering", "Computer Science", "Mathematics", "Biology & Biochemistry"]
    bad = ["", "   ", "a", "123", "nan", "none", "N/A", "Unknown", None]
    assert column(spark, good + bad, X.plausible_field) == [True] * len(good) + [False] * len(bad)


def test_numbers(spark):
    raw = ["123.0", "123.7", " 5 ", "-3.9", "x", "", None, "NaN", "1e3"]
    assert column(spark, raw, N.lenient_long) == [123, 123, 5, -3, 0, 0, 0, 0, 1000]
    assert column(spark, raw, N.lenient_double) == [123.0, 123.7, 5.0, -3.9, 0.0, 0.0, 0.0, 0.0, 1000.0]
    assert column(spark, raw, N.non_numeric) == [False] * 4 + [True, True, False, True, False]


def test_relative_change(spark):
    cases = [(100, 150, 0.5), (100, 50, -0.5), (100, 100, 0.0), (0, 100, math.inf), (0, 0, 0.0), (50, 0, -1.0), (-100, -50, -0.5), (0, -5, 0.0)]
    df = spark.createDataFrame(cases, "a int, b int, e double")
    rows = df.select(N.relative_change(F.col("a"), F.col("b")).alias("r"), "e").collect()
    assert [r["r"] for r in rows] == [r["e"] for r in rows]


def test_table_names(spark):
    names = ["space_science_feb_highly_cited_only", "physics_july_incites_researchers", "physics_march_x", "feb_x", "a_feb_july_b"]
    parts = column(spark, names, lambda c: X.parse_table_name(c, ("feb", "july")))
    assert [tuple(p) for p in parts] == [
        ("space_science", "feb", "highly_cited_only"),
        ("physics", "july", "incites_researchers"),
        (None, None, None),
        (None, None, None),
        ("a", "feb", "july_b"),
    ]
    assert column(spark, ["Space Science"], lambda c: X.table_name(c, F.lit("Feb"), F.lit("Highly Cited only"))) == [names[0]]


def test_comparison_ids(spark):
    ids = ["space_science_highly_cited_only", "physics_incites_researchers", "other"]
    assert column(spark, ids, X.display_subject) == ["Space Science", "Physics", "Other"]
    assert column(spark, ids, X.dataset_type) == ["highly_cited_only", "incites_researchers", "general_research"]


def test_growth_status(spark):
    cases = {30.0: "High Growth", 29.9: "Growing", 15.0: "Growing", 5.0: "Expanding", 0.0: "Moderate", -10.0: "Declining", -10.1: "Major Decline"}
    assert column(spark, list(cases), L.growth_status, "double") == list(cases.values())


def test_cross_field_category(spark):
    cases = [(1, 5.0, "Single Field"), (2, 1.0, "Cross-Field"), (2, 0.85, "Near Cross-Field"), (2, 0.84, "Approaching Cross-Field"), (3, 0.69, "Multidisciplinary")]
    df = spark.createDataFrame(cases, "n int, s double, e string")
    category = L.cross_field_category(F.col("n"), F.col("s"))
    rows = df.select(category.alias("c"), L.category_key(category).alias("k"), "e").collect()
    assert [r["c"] for r in rows] == [r["e"] for r in rows]
    assert {r["k"] for r in rows} == {"singlefield", "crossfield", "nearcrossfield", "approachingcrossfield", "multidisciplinary"}


def test_severity(spark):
    cases = [(3.0, "IQR", "Extreme"), (-2.5, "IQR", "High"), (1.5, "Z-Score", "Moderate"), (0.2, "IQR", "Low"), (9.0, "None", "Normal")]
    df = spark.createDataFrame(cases, "z double, f string, e string")
    rows = df.select(L.outlier_severity([F.col("z")], [F.col("f")]).alias("s"), "e").collect()
    assert [r["s"] for r in rows] == [r["e"] for r in rows]


def test_displayed_numbers(spark):
    assert column(spark, [1234567, 0], N.with_commas, "int") == ["1,234,567", "0"]
    assert column(spark, [1234, -5, 0], N.signed, "int") == ["+1,234", "-5", "0"]
    assert column(spark, ["+1,234", "-5", "n/a", None], N.sort_number) == [1234.0, -5.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        L.change_class(F.col("v"), "huge")
