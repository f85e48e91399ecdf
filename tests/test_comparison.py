"""Comparison, marts and flows on small snapshots."""

import math
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark import presets as R
from tidemark.operators import compare as C
from tidemark.operators import marts as M
from tidemark.plans import comparison as plan
from tidemark.session import materialise
from tidemark.sources.store import Store
from tidemark.spec import CompareSpec, Metric
from workload.comparison import short_comparison
from workload.frames import SHORT_SPEC, SPEC, snapshots

SPEC13 = R.researcher_spec()


def rows_of(subject, period, *entities, sheet="highly_cited_only"):
    return [(subject, sheet, period, *e) for e in entities]


@pytest.fixture
def two(spark, canon):
    return canon(
        spark,
        rows_of(
            "physics", "feb",
            ("Ada", "Physics", 10, 1.0, 1, 100), ("Bob", "Physics", 5, 0.5, 0, 50), ("Cy", "Physics", 2, 0.2, 0, 20),
            ("Dee", "Physics", 0, 0.1, 0, None), ("Eve", "Physics", 3, 0.3, 1, 30),
        )
        + rows_of(
            "physics", "july",
            ("Ada", "Physics", 12, 1.0005, 1, 100), ("Bob", "Physics", 5, 0.5005, 0, 50), ("Dee", "Physics", 0, 0.1, 0, 10),
            ("Eve", "Chemistry", 1, 0.3, 1, None), ("Fay", "Physics", 4, 0.4, 2, 40), ("Gus", "Physics", 0, 0.0, 0, 4),
        )
        + rows_of("lonely", "feb", ("Zed", "Lonely", 1, 0.1, 0, 1)),
    )


def test_classes(two):
    out = {(r["subject"], r["name"]): r for r in C.compare(two, SPEC13).collect()}
    assert {k[1]: v["status"] for k, v in out.items()} == {
        "Ada": "changed",
        "Bob": "unchanged",
        "Cy": "only_in_1",
        "Dee": "unclassified",
        "Eve": "changed",
        "Fay": "only_in_2",
        "Gus": "only_in_2",
        "Zed": "only_in_1",
    }
    ada = out["physics", "Ada"]
    assert ada["highly_cited_papers_change"] == 2
    assert ada["highly_cited_papers_relative"] == pytest.approx(0.2)
    assert ada["indicative_cross_field_score_change"] == pytest.approx(0.0005)
    assert out["physics", "Eve"]["esi_field_2"] == "Chemistry"
    assert out["physics", "Fay"]["highly_cited_papers_change"] is None


def test_lists_and_summary(two):
    compared = C.compare(two, SPEC13)
    assert {r["name"] for r in C.only_in(compared, 1, SPEC13).collect()} == {"Cy", "Zed"}
    assert {r["name"] for r in C.unchanged(compared, SPEC13).collect()} == {"Bob"}
    assert [r["name"] for r in C.changes(compared, SPEC13).orderBy("name").collect()] == ["Ada", "Eve"]
    s = {r["subject"]: r for r in C.summarise(compared, SPEC13).collect()}
    p = s["physics"]
    assert (p["total_1"], p["total_2"], p["matched"], p["changed"], p["unchanged"], p["unclassified"]) == (5, 6, 4, 2, 1, 1)
    assert (p["only_in_1"], p["only_in_2"]) == (1, 2)
    assert p["match_rate"] == pytest.approx(4 / 6) and p["change_rate"] == 0.5
    assert (p["total_highly_cited_papers_change"], p["avg_highly_cited_papers_change"]) == (0, 0.0)
    assert (s["lonely"]["matched"], s["lonely"]["match_rate"], s["lonely"]["change_rate"]) == (0, 0.0, 0.0)


def test_pairs(two):
    cover = {r["subject"]: (r["is_complete"], r["missing_period"]) for r in C.pair_coverage(two, SPEC13).collect()}
    assert cover == {"physics": (True, None), "lonely": (False, "july")}
    assert {r["subject"] for r in C.complete_pairs(two, SPEC13).collect()} == {"physics"}


def test_row_without_a_name(spark, canon):
    """Null never equals null: such rows count, but match nothing."""
    df = canon(spark, rows_of("a", "feb", (None, "f", 1, 1.0, 1, 1), ("Ada", "f", 1, 1.0, 1, 1)) + rows_of("a", "july", (None, "f", 1, 1.0, 1, 1)))
    compared = C.compare(df, SPEC13)
    assert {r["name"]: r["status"] for r in compared.collect()} == {None: "unnamed", "Ada": "only_in_1"}
    total = C.summarise(compared, SPEC13).first()
    assert (total["total_1"], total["total_2"], total["matched"], total["only_in_1"], total["only_in_2"]) == (2, 1, 0, 1, 0)


def test_normalised(spark, canon):
    df = canon(
        spark,
        rows_of("a", "feb", (" Ada", "f", 1, 1.0, 1, 1), ("nan", "f", 1, 1.0, 1, 1), ("", "f", 1, 1.0, 1, 1), ("Bob", "f", None, 0.5, 0, 0))
        + rows_of("a", "july", ("ADA ", "f", 1, 1.0004, 1, 1), ("bob", "f", 0, 0.6, 0, 0)),
    )
    out = {r["name"]: r for r in C.compare_normalised(df, SPEC13).collect()}
    assert {k: v["status"] for k, v in out.items()} == {"ada": "unchanged", "bob": "changed"}
    assert out["ada"]["indicative_cross_field_score_change"] == 0.0
    assert (out["ada"]["entity_1"], out["ada"]["entity_2"]) == ("Ada", "ADA")
    assert out["bob"]["highly_cited_papers_change"] == 0
    total = C.summarise(C.compare_normalised(df, SPEC13), SPEC13, over="changed").first()
    assert total["avg_indicative_cross_field_score_change"] == pytest.approx(0.1)
    assert total["avg_hot_papers_change"] == 0.0


def test_repeated_entity_first_row(spark, canon):
    spec = R.researcher_spec(order_by=("times_cited",))
    df = canon(
        spark,
        rows_of("a", "feb", ("Ada", "f", 3, 1.0, 1, 2), ("Ada", "f", 9, 1.0, 1, 1)) + rows_of("a", "july", ("Ada", "f", 9, 1.0, 1, 1)),
    )
    row = C.compare(df, spec).first()
    assert (row["status"], row["rows_1"], row["rows_2"], row["highly_cited_papers_1"]) == ("unchanged", 2, 1, 9)
    assert C.summarise(C.compare(df, spec), spec).first()["total_1"] == 2


def test_fanout_of_a_heavy_entity(spark):
    """Products beyond a long stay exact."""
    schema = "subject string, period string, name string, papers bigint"
    one = spark.createDataFrame([("s", "p1", "Ada", 4_000_000_000_000), ("s", "p2", "Ada", 5_000_000_000_000)], schema)
    rows = one.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("i")
    spec = CompareSpec(metrics=(Metric("papers"),), periods=("p1", "p2"), pair_by=("subject",))
    out = C.fanout_totals(rows, spec).first()
    assert (out["matched"], out["total_papers_change"]) == (4_000_000, 4_000_000 * 10**12)
    assert out["avg_papers_change"] == 1e12


def test_unique_entities_pair_alike(spark, two):
    """Aggregate by sort, aggregate by hash and join give the same rows."""
    some = two.withColumn("subject", F.when(F.col("subject") != "lonely", F.col("subject")))
    columns = [c for c in C.compare(some, SPEC13).columns if c != "esi_field_1"]
    want = sorted(map(str, C.compare(some, SPEC13).select(columns).collect()))
    joined = C.compare(some, R.researcher_spec(assume_unique=True))
    assert "FullOuter" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, joined.select(columns).collect())) == want
    hashed = C.compare(some, R.researcher_spec(assume_unique=True, carry=()))
    rest = [c for c in columns if c != "esi_field_2"]
    assert sorted(map(str, hashed.select(rest).collect())) == sorted(map(str, C.compare(some, SPEC13).select(rest).collect()))


def test_self_comparison_is_unchanged(spark, sf_dir):
    one = snapshots(spark, sf_dir).filter("period = 'p1'")
    both = one.unionByName(one.withColumn("period", F.lit("p2")))
    assert {r["status"] for r in C.compare(both, SPEC).select("status").distinct().collect()} == {"unchanged"}


def test_swapping_the_periods(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    flipped = rows.withColumn("period", F.when(F.col("period") == "p1", "p2").otherwise("p1"))
    a = {(r["subject"], r["name"]): r for r in C.compare(rows, SHORT_SPEC).collect()}
    b = {(r["subject"], r["name"]): r for r in C.compare(flipped, SHORT_SPEC).collect()}
    swap = {"only_in_1": "only_in_2", "only_in_2": "only_in_1"}
    assert a.keys() == b.keys()
    for k, r in a.items():
        assert b[k]["status"] == swap.get(r["status"], r["status"])
        if r["papers_change"] is not None:
            assert b[k]["papers_change"] == -r["papers_change"]


def test_totals_add_up(spark, sf_dir):
    for r in C.summarise(short_comparison(spark, sf_dir), SHORT_SPEC).collect():
        assert r["only_in_1"] + r["matched"] == r["total_1"]
        assert r["only_in_2"] + r["matched"] == r["total_2"]
        assert r["changed"] + r["unchanged"] + r["unclassified"] == r["matched"]


def test_one_shuffle_compares(spark, sf_dir):
    """Pairing two stored snapshots takes a single shuffle."""
    one = materialise(snapshots(spark, sf_dir))
    plan_text = C.compare(one, SHORT_SPEC)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(subject#\d+, name", plan_text)) == 1
    assert plan_text.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan_text


def test_status_changes(spark):
    spec = R.researcher_spec(metrics=(R.METRICS[0],), carry=C.DUPLICATE_FLAGS)
    schema = "subject string, sheet_type string, period string, name string, highly_cited_papers int, is_duplicate boolean, duplicate_profile string, duplicate_group_id string"
    rows = [
        ("a", "s", "feb", "Ada", 1, False, "", ""),
        ("a", "s", "july", "Ada", 1, True, "p", "DUP_0001"),
        ("a", "s", "feb", "Bob", 1, True, "q", "DUP_0001"),
        ("a", "s", "july", "Bob", 1, False, "", ""),
        ("a", "s", "july", "New", 1, True, "r", "DUP_0002"),
    ]
    df = spark.createDataFrame(rows, schema)
    compared = C.compare(df, spec)
    got = {(r["name"], r["change"], r["duplicate_profile"]) for r in C.duplicate_changes(compared, spec).collect()}
    assert got == {("Ada", "became_duplicate", "p"), ("Bob", "resolved_duplicate", "q")}
    summary = C.duplicate_change_summary(compared, df, spec).first()
    assert (summary["became_duplicates"], summary["resolved_duplicates"], summary["current_duplicates"]) == (1, 1, 2)
    totals = C.grand_totals(C.duplicate_change_summary(compared, df, spec)).first()
    assert totals["total_current_duplicates"] == 2


@pytest.fixture
def fields(spark, canon):
    """Ada moves in two fields, Bob is listed twice under one field, Cy is new."""
    return canon(
        spark,
        rows_of("physics", "feb", ("Ada", "Physics", 1, 0.3, 0, 10), ("Bob", "Chemistry", 5, 0.5, 0, 50), ("Flat", "Physics", 1, 0.2, 0, 0))
        + rows_of("physics", "july", ("Ada", "Physics", 4, 0.6, 1, 30), ("Bob", "Chemistry", 4, 0.4, 0, 40), ("Cy", "Physics", 2, 0.7, 0, 5), ("No", "Physics", 0, 0.7, 0, 5), ("Flat", "Physics", 1, 0.2, 0, 0))
        + rows_of("chemistry", "feb", ("Ada", "Chemistry", 2, 0.2, 0, 20), ("Bob", "Chemistry", 5, 0.5, 0, 50))
        + rows_of("chemistry", "july", ("Ada", "Chemistry", 1, 0.5, 1, 20), ("Bob", "Chemistry", 2, 0.4, 0, 40)),
    )


def test_marts(fields):
    rows = M.entries(C.compare(fields, SPEC13), M.Roles())
    listed = {(r["name"], r["subject"], r["papers_1"], r["papers_2"], r["paper_change"], r["score_change"]) for r in rows.collect()}
    assert ("Cy", "Physics", 0, 2, 2, 0.7) in listed and ("Flat", "Physics", 1, 1, 0, 0.0) in listed
    assert not [x for x in listed if x[0] == "No"]

    people = {r["name"]: r for r in M.entities(rows).collect()}
    ada = people["Ada"]
    assert (ada["subjects"], ada["papers_2"], ada["paper_change"], ada["score_2"], ada["times_cited"]) == (["Chemistry", "Physics"], 5, 2, 1.1, 30)
    assert (ada["category"], people["Bob"]["category"], people["Bob"]["score_2"]) == ("Cross-Field", "Single Field", 0.8)
    assert people["Flat"]["times_cited"] == 0

    multi = M.changed_multi_field(rows).collect()
    assert [(r["name"], r["total_change"], r["total_score"], r["is_cross_field"]) for r in multi] == [("Ada", 2, 1.1, True)]
    assert [(r["name"], r["field_count"]) for r in M.cross_field(rows).collect()] == [("Ada", 2)]

    kept = sorted((r["name"], r["subject"], r["paper_change"]) for r in M.unique_changes(rows).collect())
    assert kept == [("Ada", "Chemistry", -1), ("Ada", "Physics", 3), ("Bob", "Chemistry", -1)]
    up = M.top_changes(rows, "increase").collect()
    assert [(r["name"], r["paper_change"], r["total_score"], r["category"], r["in_cross_field_list"]) for r in up] == [("Ada", 3, 1.1, "Cross-Field", True)]
    down = M.top_changes(rows, "decrease").orderBy("name").collect()
    assert [(r["name"], r["total_score"], r["category"]) for r in down] == [("Ada", 1.1, "Cross-Field"), ("Bob", 0.4, "Single Field")]


def test_marts_per_sheet(fields):
    both = fields.unionByName(fields.withColumn("sheet_type", F.lit("incites_researchers")))
    roles = M.Roles(by=("sheet_type",))
    rows = M.entries(C.compare(both, SPEC13), roles)
    up = M.top_changes(rows, "increase", ("sheet_type",)).collect()
    assert {(r["sheet_type"], r["name"]) for r in up} == {("highly_cited_only", "Ada"), ("incites_researchers", "Ada")}


def test_growth_and_executive_summary(fields):
    summary = C.summarise(C.compare(fields, SPEC13), SPEC13)
    growth = {r["subject"]: r for r in M.subject_growth(summary).collect()}
    assert (growth["physics"]["growth_rate"], growth["physics"]["status"], growth["physics"]["retention_rate"]) == (66.7, "High Growth", 100.0)
    assert growth["chemistry"]["status"] == "Moderate"
    total = M.executive_summary(summary).first()
    assert (total["total_1"], total["total_2"], total["total_subjects"], total["change_rate"]) == (5, 7, 2, 80.0)


def test_flow(spark, fields):
    result = plan.run(fields, SPEC13, analysed=R.ANALYSED)
    assert result.changes.count() == 4 and result.only_in_2.count() == 2 and result.unchanged.count() == 1
    assert result.only_in_1.count() == 0 and result.duplicates is None
    assert result.outliers is not None
    views = plan.dashboard(result.compared, result.summary, M.Roles())
    assert views["cross_field_counts"].first()["cross_field"] == 1
    assert {k: v.count() >= 1 for k, v in views.items()} == dict.fromkeys(views, True)


def test_relative_change_from_zero(spark, canon):
    df = canon(spark, rows_of("a", "feb", ("Ada", "f", 0, 0.0, 0, 0)) + rows_of("a", "july", ("Ada", "f", 3, 0.0, 0, 0)))
    row = C.compare(df, SPEC13).first()
    assert math.isinf(row["highly_cited_papers_relative"]) and row["hot_papers_relative"] == 0.0


def test_unnamed_rows_on_both_paths(spark):
    """One row per pair, whatever the payload, and they do not enter the join."""
    rows = [("x", "p1", None, 1, "t"), ("x", "p1", None, 2, "u"), ("x", "p2", None, 3, None), ("x", "p1", "a", 1, "t"), ("x", "p2", "a", 1, "t")]
    df = spark.createDataFrame(rows, "subject string, period string, name string, n int, label string")
    plain = CompareSpec((Metric("n"),), ("p1", "p2"), pair_by=("subject",), assume_unique=True)
    found = []
    for spec in (plain, replace(plain, carry=("label",)), replace(plain, assume_unique=False, order_by=("n",))):
        compared = C.compare(df, spec)
        found.append(sorted((r["name"] or "", r["status"], r["rows_1"], r["rows_2"], r["n_1"]) for r in compared.collect()))
        if spec.carry:
            plan = compared._jdf.queryExecution().optimizedPlan().toString()
            assert "FullOuter" in plan and plan.count("isnotnull(name") >= 2
    assert found[0] == [("", "unnamed", 2, 1, None), ("a", "unchanged", 1, 1, 1)]
    assert found[0] == found[1] == found[2]


def test_broken_promise_of_unique_entities(spark):
    df = spark.createDataFrame([("x", "p1", "a", 1), ("x", "p1", "a", 2)], "subject string, period string, name string, n int")
    spec = CompareSpec((Metric("n"),), ("p1", "p2"), pair_by=("subject",), assume_unique=True)
    with pytest.raises(Exception, match="assumes it is unique"):
        C.compare(df, spec).collect()


def test_fanout_with_null_metrics(spark):
    rows = [("x", "p1", "a", None), ("x", "p1", "a", 2), ("x", "p2", "a", 5)]
    df = spark.createDataFrame(rows, "subject string, period string, name string, n int")
    spec = CompareSpec((Metric("n"),), ("p1", "p2"), pair_by=("subject",))
    out = C.fanout_totals(df, spec).first()
    assert (out["matched"], out["total_n_change"], out["avg_n_change"]) == (2, 3, 3.0)


@pytest.mark.parametrize("carry", [(), ("label",)])
def test_a_repeated_entity_fails_whatever_is_read(spark, carry):
    """With and without text, and when the counts of rows are not among the columns that are read."""
    spec = CompareSpec((Metric("n"),), ("p1", "p2"), pair_by=("subject",), assume_unique=True, carry=carry)
    rows = [("a", "s", "p1", 1, "x"), ("a", "s", "p1", 2, "y"), ("b", None, "p2", 1, "x"), ("b", None, "p1", 1, "x"), (None, "s", "p1", 1, "x"), (None, "s", "p1", 1, "x")]
    df = spark.createDataFrame(rows, "name string, subject string, period string, n int, label string")
    for read in (lambda c: c.select("name", "n_1").collect(), lambda c: c.count(), lambda c: C.summarise(c, spec).collect()):
        with pytest.raises(Exception, match="assumes it is unique"):
            read(C.compare(df, spec))
    fine = {(r["name"], r["subject"]): (r["status"], r["rows_1"], r["rows_2"]) for r in C.compare(df.filter("n < 2"), spec).collect()}
    assert fine == {("a", "s"): ("only_in_1", 1, 0), ("b", None): ("unchanged", 1, 1), (None, "s"): ("unnamed", 2, 0)}


def test_joined_sides_shuffle_once_each(spark, sf_dir):
    """Counting the rows of an entity takes no shuffle besides those of the join."""
    one = materialise(snapshots(spark, sf_dir).withColumn("label", F.lit("x")))
    spec = replace(SHORT_SPEC, carry=("label",))
    plan_text = C.compare(one.filter("name IS NOT NULL"), spec)._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Exchange hashpartitioning(_pair") == 2 and plan_text.count("Window") >= 2


def test_stored_buckets_are_compared_without_a_shuffle(spark, sf_dir, tmp_path):
    rows = snapshots(spark, sf_dir).withColumn("sheet_type", F.lit("s"))
    store = Store(spark, "bucketed", str(tmp_path / "bucketed"))
    store.load(rows, {"t": "name STRING, papers BIGINT, hot BIGINT, cited BIGINT, score DOUBLE"}, buckets=4)
    spec = replace(SHORT_SPEC, pair_by=("subject", "sheet_type"))
    compared = C.compare(store.read("t"), spec)
    assert "Exchange" not in compared._jdf.queryExecution().executedPlan().toString()
    plain = C.compare(materialise(rows), spec)
    counts = lambda df: sorted(map(tuple, df.groupBy("subject", "status").count().collect()))
    assert counts(compared) == counts(plain)


def test_first_rows_are_sorted_by_a_hash_of_their_keys(spark):
    """Subjects and names share their first bytes, so that sorting by them compares whole keys."""
    rows = [("s", f"Customer#{i % 7}", p, i, 10 * i) for i in range(20) for p in ("p1", "p2")]
    df = spark.createDataFrame(rows, "subject string, name string, period string, seq int, price int")
    spec = CompareSpec(metrics=(Metric("price"),), periods=("p1", "p2"), pair_by=("subject",), order_by=("seq",))
    out = C.compare(df, spec)
    assert sorted((r["name"], r["rows_1"], r["seq_1"], r["price_2"]) for r in out.collect()) == [
        (f"Customer#{i}", 3 if i < 6 else 2, i, 10 * i) for i in range(7)
    ]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_hash#" in plan and "_hash" not in out.columns
