"""Headers, types, nulls, duplicates and checks."""

import pytest
from pyspark.sql import functions as F

from tidemark import presets as R
from tidemark.operators import duplicates as D
from tidemark.operators import filters, nulls, rules, shape
from tidemark.plans import preparation as P
from tidemark.spec import CompareSpec, Metric, Rule


@pytest.mark.parametrize(
    "headers, variants, mapped, unmapped",
    [
        (["Name", "Times Cited", "Highly Cited Papers", "ESI Field"], None, ["name", "times_cited", "highly_cited_papers", "esi_field"], ()),
        (
            ["Full Name", "Citation Count", "HC Papers", "Research Field"],
            {"name": ["Full Name"], "times_cited": ["Citation Count"], "highly_cited_papers": ["HC Papers"], "esi_field": ["Research Field"]},
            ["name", "times_cited", "highly_cited_papers", "esi_field"],
            (),
        ),
        (["Name", "Times Cited", "Unknown Column", "ESI Field"], None, ["name", "times_cited", "esi_field"], ("Unknown Column",)),
        (["  Name  ", "Times-Cited", "Highly_Cited_Papers", "ESI.Field"], None, ["name", "times_cited", "highly_cited_papers", "esi_field"], ()),
        (["NAME", "times cited", "hot_papers"], None, ["name", "times_cited", "hot_papers"], ()),
    ],
)
def test_match_headers(headers, variants, mapped, unmapped):
    found = shape.match_headers(headers, R.COLUMN_MAPPING, variants)
    assert list(found.source_of) == mapped
    assert found.unmapped == unmapped
    assert set(found.missing) == set(R.COLUMN_MAPPING) - set(mapped)


def test_match_headers_strict_and_ambiguous():
    strict = shape.match_headers(["Times-Cited", "Name"], R.COLUMN_MAPPING, strict=True)
    assert strict.unmapped == ("Times-Cited",)
    with pytest.raises(ValueError, match="both map to name"):
        shape.match_headers(["Name", "NAME"], R.COLUMN_MAPPING)


def test_map_headers_defaults(spark):
    raw = spark.createDataFrame([("Ada", "12", "x")], "`Name` string, `Times Cited` string, `Other` string")
    row = shape.map_headers(raw, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA).first()
    assert list(row.asDict()) == list(R.COLUMN_MAPPING)
    assert (row["times_cited"], row["percent_docs_cited"], row["rank"], row["orcid"]) == ("12", 0, 0, "")
    assert row["indicative_cross_field_score"] == 0.0
    blank = shape.map_headers(raw, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA, missing="blank").first()
    assert (blank["rank"], blank["orcid"]) == (None, "")
    with pytest.raises(ValueError, match="missing critical columns"):
        shape.map_headers(raw, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA, critical=["hot_papers"])


def test_clean_headers_and_difference(spark):
    df = shape.clean_headers(spark.createDataFrame([(1, 2)], "` a ` int, `  ` int"))
    assert df.columns == ["a", shape.UNNAMED]
    assert shape.column_difference(df, ["a", "b"]) == (["b"], [shape.UNNAMED])


def test_typed_and_enforced(spark):
    df = spark.createDataFrame([(" Ada ", "12.9", "x"), (None, None, "1.5")], "name string, n string, d string")
    out = shape.typed(df, "name string, n int, d double").collect()
    assert [tuple(r) for r in out] == [("Ada", 12, 0.0), ("", 0, 1.5)]
    strict = shape.enforced(spark.createDataFrame([("a", 1)], "name string, n bigint"), "n int, name string")
    assert strict.dtypes == [("n", "int"), ("name", "string")]
    with pytest.raises(ValueError):
        shape.enforced(strict, "missing string")
    texts = spark.createDataFrame([("2.5", 3.5), (" 7 ", -1.2), (None, None)], "t string, d double")
    assert [tuple(r) for r in shape.enforced(texts, "t int, d int").collect()] == [(2, 4), (7, -1), (None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        shape.enforced(spark.createDataFrame([("12a",)], "t string"), "t int").collect()


def test_null_strategies(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, 2.0), ("c", 3, 3.0)], "name string, n int, d double")
    assert nulls.handle_nulls(df, "skip").count() == 1
    filled = nulls.handle_nulls(df, "default", {"n": 0, "absent": 1}, ["name"]).orderBy("name").collect()
    assert [r["n"] for r in filled] == [1, 0, 3] and filled[0]["d"] is None
    # At once, so that no count or aggregate of another column can miss it.
    with pytest.raises(nulls.NullsFound, match="may not hold a null"):
        nulls.handle_nulls(df, "fail").count()
    with pytest.raises(nulls.NullsFound, match="column n may not hold a null"):
        nulls.handle_nulls(df, "default", {"n": 0}, ["n"]).agg({"name": "count"})
    with pytest.raises(nulls.NullsFound):
        nulls.critical_nulls(df, "fail", ["name", "n"])
    with pytest.raises(ValueError):
        nulls.handle_nulls(df, "interpolate")
    counts = {r["column_name"]: r["null_count"] for r in nulls.null_counts(df, df.columns).collect()}
    assert counts == {"name": 0, "n": 1, "d": 1}
    assert nulls.critical_nulls(df, "skip", ["name", "n"]).count() == 2
    assert nulls.critical_nulls(df, "default", ["name", "n"]).count() == 3
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert nulls.nan_to_null(nan).filter("x IS NULL").count() == 1


def test_duplicate_flags(spark):
    rows = [("x", "Ada", "F"), ("x", " ada ", "f"), ("x", "Bob", "F"), ("x", "AB", "z"), ("x", "ab", "Z"), ("y", "Ada", "F"), ("y", None, "F"), ("y", None, "F")]
    df = spark.createDataFrame(rows, "k string, name string, field string")
    out = D.flag_duplicates(df, ["name", "field"], ["k"])
    assert out.count() == len(rows)
    found = sorted((r["k"], r["name"] or "", r["is_duplicate"], r["duplicate_group_id"], r["duplicate_profile"]) for r in out.collect())
    assert found == [
        ("x", " ada ", True, "DUP_0002", "name:ada | field:f"),
        ("x", "AB", True, "DUP_0001", "name:ab | field:z"),
        ("x", "Ada", True, "DUP_0002", "name:ada | field:f"),
        ("x", "Bob", False, "", ""),
        ("x", "ab", True, "DUP_0001", "name:ab | field:z"),
        ("y", "", True, "DUP_0001", "name: | field:f"),
        ("y", "", True, "DUP_0001", "name: | field:f"),
        ("y", "Ada", False, "", ""),
    ]
    exact = D.flag_duplicates(df.na.drop(), ["name", "field"], ["k"], case_sensitive=True)
    assert not exact.filter("is_duplicate").count()
    with pytest.raises(D.DuplicatesFound):
        D.flag_duplicates(df, ["name", "field"], ["k"], fail=True)
    with pytest.raises(ValueError, match="not found"):
        D.flag_duplicates(df, ["nothing"])


def test_checks(spark):
    df = spark.createDataFrame(
        [("Ada", "40", 5), ("B", "x", -1), (None, "200000", 300), ("Ada", "60", 1)], "name string, times_cited string, hot_papers int"
    )
    found = rules.run_checks(
        df, critical=["name", "rank"], numeric=["times_cited"], rules=R.RULES, keys=["name"]
    )
    got = {(r["check"], r["column_name"]): r["violations"] for r in found.collect()}
    assert got == {
        ("non_numeric", "times_cited"): 1,
        ("below_minimum", "times_cited"): 1,
        ("above_maximum", "times_cited"): 1,
        ("below_minimum", "hot_papers"): 1,
        ("above_maximum", "hot_papers"): 1,
        ("null_value", "name"): 1,
        ("duplicate_key", "name"): 2,
        ("missing_column", "rank"): 1,
    }
    with pytest.raises(rules.ValidationFailed, match="and more"):
        rules.enforce(found)
    rules.enforce(found.filter("violations > 100"))
    assert rules.run_checks(df, checks=["check_required_columns"], critical=["name"]).isEmpty()
    with pytest.raises(ValueError):
        rules.run_checks(df, checks=["check_everything"])


def test_sanity(spark):
    df = spark.createDataFrame([("nan", -1), ("123", 600000), ("Al", 5), ("Ada", 5)], "name string, times_cited int")
    found = rules.count_violations(df, rules.sanity_predicates(df, R.HIGH_VALUES, ["name"]))
    got = {(r["check"], r["column_name"]): r["violations"] for r in found.collect()}
    assert got == {
        ("negative", "times_cited"): 1,
        ("very_high", "times_cited"): 1,
        ("not_numeric", "times_cited"): 0,
        ("null_like", "name"): 1,
        ("numeric_text", "name"): 1,
        ("very_short", "name"): 1,
    }


def test_light_transform(spark):
    rows = [
        ("physics", "highly_cited_only", "feb", "Ada", "10", "computer science"),
        ("physics", "highly_cited_only", "feb", "ADA", None, "Computer Science "),
        ("physics", "highly_cited_only", "feb", "Bob", "7", None),
    ]
    raw = spark.createDataFrame(rows, "subject string, sheet_type string, period string, `Name` string, `Times Cited` string, `ESI Field` string")
    out = P.light_transform(raw, R.researcher_transform(null_defaults={"times_cited": "0"}))
    got = sorted((r["name"], r["times_cited"], r["esi_field"], r["is_duplicate"]) for r in out.collect())
    assert got == [("ADA", "0", "Computer Science", True), ("Ada", "10", "Computer Science", True), ("Bob", "7", "", False)]
    assert out.columns == ["subject", "sheet_type", "period", *R.COLUMN_MAPPING, *[c.split()[0] for c in R.FLAG_SCHEMA.split(", ")]]
    violations = P.validate(out, R.researcher_transform())
    assert ("below_minimum", "times_cited", 3) in [(r["check"], r["column_name"], r["violations"]) for r in violations.collect()]
    with pytest.raises(rules.ValidationFailed):
        P.light_transform(raw, R.researcher_transform(fail_on_violation=True))


def test_large_category_map(spark, monkeypatch):
    df = spark.createDataFrame([(" PHYSICS",), ("odd ",), (None,), ("  ",)], "esi_field string")
    small = P.normalise_category(df, R.researcher_transform()).collect()
    monkeypatch.setattr(P, "MAP_LIMIT", 5)
    assert P.normalise_category(df, R.researcher_transform()).collect() == small
    assert [r[0] for r in small] == ["Physics", "odd", "", "  "]


def test_cleaning(spark):
    rows = [("s", "t", "feb", "Ada", "f", "12.7", 2), ("s", "t", "feb", "Ada", "f", "99", 1), ("s", "t", "feb", "Bob", "f", "x", 3)]
    df = spark.createDataFrame(rows, "subject string, sheet_type string, period string, name string, esi_field string, times_cited string, seq int")
    settings = R.researcher_transform(schema="name string, esi_field string, times_cited int", critical=("name", "esi_field"))
    out = P.clean(df, settings, ["seq"]).orderBy("name").collect()
    assert [(r["name"], r["times_cited"], r["seq"]) for r in out] == [("Ada", 99, 1), ("Bob", 0, 3)]
    summary = P.cleaning_summary(df, P.clean(df, settings, ["seq"]), ["subject", "period"]).first()
    assert (summary["rows_before"], summary["rows_after"], summary["rows_removed"], summary["status"]) == (3, 2, 1, "cleaned")


def test_reader_filters(spark):
    df = spark.createDataFrame(
        [("Ada Lovelace", "a", ["a", "b"], 7, "crossfield"), ("Bob", "b", ["b"], -2, "singlefield"), ("Cy", "a", ["a"], 0, "singlefield")],
        "name string, subject string, subjects array<string>, paper_change int, category_key string",
    )

    def names(out):
        return [r["name"] for r in out.orderBy("name").collect()]

    assert names(filters.search(df, "LOVE")) == ["Ada Lovelace"]
    assert names(filters.filter_entries(df, "a", "increase")) == ["Ada Lovelace"]
    assert names(filters.filter_entries(df, change="decrease")) == ["Bob"]
    assert names(filters.filter_entities(df, "b", "major")) == ["Ada Lovelace"]
    assert names(filters.filter_entities(df, show="singlefield")) == ["Bob", "Cy"]
    assert names(filters.filter_category(df)) == ["Ada Lovelace", "Bob", "Cy"]
    assert names(filters.of_sheets(df, ["a"], "subject")) == ["Ada Lovelace", "Cy"]
    assert [r["name"] for r in filters.sort_by(df, "paper_change", descending=True).collect()] == ["Ada Lovelace", "Cy", "Bob"]
    assert [r["name"] for r in filters.sort_by(df, "name").collect()] == ["Ada Lovelace", "Bob", "Cy"]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        Rule("x", min_value=2, max_value=1)
    with pytest.raises(ValueError):
        Metric("x", -1)
    with pytest.raises(ValueError):
        CompareSpec(metrics=(), periods=("a", "b"))
    with pytest.raises(ValueError):
        CompareSpec(metrics=(Metric("m"),), periods=("a", "a"))
    with pytest.raises(ValueError, match="two roles"):
        CompareSpec(metrics=(Metric("name"),), periods=("a", "b"))


def test_filled_counts(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "name string, n int")
    assert [tuple(r) for r in nulls.filled_counts(df, {"n": 0, "z": 1}).collect()] == [("n", 1)]
    assert df.filter(F.col("n").isNull()).count() == 1
