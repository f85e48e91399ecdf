"""Folders, tables and reports."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tidemark import presets as R
from tidemark.operators import compare as C
from tidemark.operators import filters
from tidemark.operators.contents import snapshot_contents
from tidemark.operators.marts import Roles
from tidemark.plans import comparison as plan
from tidemark.plans import preparation
from tidemark.sources import reports, snapshots as S
from tidemark.sources.pages import NameIndex, Pages
from tidemark.sources.store import LoadFailed, Store

HEADER = "Name,Times Cited,ESI Field,Extra\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "Feb 2025"
    write(f"{root}/Highly Cited only/space science.csv", HEADER + "Ada,10,physics,x\nnan,1,physics,x\n  ,1,physics,x\nNone,3,,\n")
    write(f"{root}/Highly Cited only/physics/part-0.csv", HEADER + "Bob,20,Physics,x\n")
    write(f"{root}/Highly Cited only/physics/part-1.csv", HEADER + "Cy,30,Physics,x\n")
    write(f"{root}/Highly Cited only/~$physics.csv", HEADER + "Ghost,20,Physics,x\n")
    write(f"{root}/Notes/other.csv", "a,b\n1,2\n")
    return str(root)


def test_read_period(spark, folder):
    df = S.read_period(spark, folder, "Feb", R.SHEETS, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA)
    got = sorted((r["subject"], r["sheet_type"], r["period"], r["name"], r["times_cited"], r["rank"]) for r in df.collect())
    assert got == [
        ("physics", "highly_cited_only", "feb", "Bob", "20", 0),
        ("physics", "highly_cited_only", "feb", "Cy", "30", 0),
        ("space_science", "highly_cited_only", "feb", "Ada", "10", 0),
    ]
    meta = {r["subject"]: (r["row_count"], r["table_name"]) for r in S.extraction_metadata(df).collect()}
    assert meta["space_science"] == (1, "space_science_feb_highly_cited_only")
    assert meta["physics"][0] == 2
    S.require_rows(df)
    with pytest.raises(S.NothingExtracted):
        S.require_rows(df.filter("false"))


def test_read_nothing(spark, folder):
    with pytest.raises(S.NothingExtracted):
        S.read_period(spark, folder, "feb", ["Incites Researchers"], R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA)
    with pytest.raises(ValueError):
        S.read_sheet(spark, folder, "xlsx")


def test_headers_must_agree(spark, tmp_path):
    write(f"{tmp_path}/s/a.csv", "Name,Times Cited\nAda,1\n")
    write(f"{tmp_path}/s/b.csv", "Times Cited,Name\n2,Bob\n")
    with pytest.raises(Exception):
        S.read_sheet(spark, f"{tmp_path}/s").collect()


def test_two_periods(spark, tmp_path):
    for period, n in (("feb", 1), ("july", 2)):
        write(f"{tmp_path}/{period}/Highly Cited only/physics.json", json.dumps({"Name": "Ada", "Times Cited": n}) + "\n")
    folders = {p: f"{tmp_path}/{p}" for p in ("feb", "july")}
    df = S.read_periods(spark, folders, R.SHEETS, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA, "json")
    assert {(r["period"], r["times_cited"]) for r in df.collect()} == {("feb", "1"), ("july", "2")}


@pytest.fixture
def snaps(spark):
    rows = [
        ("physics", s, p, f"n{i}", i, float(i))
        for s in ("highly_cited_only", "incites_researchers")
        for p in ("feb", "july")
        for i in range(4)
    ]
    return spark.createDataFrame(rows, "subject string, sheet_type string, period string, name string, papers bigint, score double")


SCHEMA = "name STRING, papers INT, score DOUBLE"


def test_store(spark, snaps, tmp_path):
    store = Store(spark, "one", str(tmp_path / "one"))
    assert store.load(snaps, {"snapshots": SCHEMA}).tables == ["snapshots"]
    assert store.tables() == ["snapshots"] and store.exists("snapshots") and not store.exists("nope")
    assert store.count("snapshots") == 16
    assert store.schema("snapshots")["papers"] == "int"
    assert store.sample("snapshots", 3).count() == 3
    assert store.sample_values("snapshots", "name", 2).count() == 2
    assert store.sample_per_snapshot("snapshots", ["name"], 1).count() == 4
    assert {r["row_count"] for r in store.profile("snapshots").collect()} == {4}
    assert [tuple(r) for r in store.summary().collect()] == [("snapshots", 16, 6)]
    assert store.sql("SELECT count(*) AS n FROM snapshots WHERE name = ?", ["n1"]).first()["n"] == 4
    assert store.sql("SELECT count(*) AS n FROM snapshots WHERE name = :who", {"who": "n1"}).first()["n"] == 4
    checks = store.validate("snapshots", ["name", "papers"], non_negative=["papers"])
    assert {r["violations"] for r in checks.collect()} == {0}
    with pytest.raises(LoadFailed):
        store.validate("snapshots", ["orcid"])
    pruned = store.read("snapshots").filter("sheet_type = 'highly_cited_only'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sheet_type" in pruned
    store.export("SELECT name, papers FROM snapshots WHERE papers > 2", str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 4
    store.clear()
    assert store.tables() == []


def test_store_schemas_and_failures(spark, snaps, tmp_path):
    store = Store(spark, "two", str(tmp_path / "two"))
    by_sheet = {"highly_cited_only": "a", "incites_researchers": "b"}
    loaded = store.load(snaps, {"a": SCHEMA, "b": "name STRING, orcid STRING"}, by_sheet, default_schema="a")
    assert loaded.tables == ["a"] and "orcid" in loaded.failures["b"]
    assert (loaded.rows_in, loaded.rows_stored) == (16, 8)
    assert store.count("a") == 8
    with pytest.raises(LoadFailed, match="missing critical columns"):
        store.load(snaps, {"b": "orcid STRING"})
    store.create(snaps, "t", "replace")
    store.create(snaps, "t", "append")
    assert store.count("t") == 32
    with pytest.raises(LoadFailed):
        store.create(snaps, "t", "fail")
    with pytest.raises(ValueError):
        store.create(snaps, "t", "merge")
    with pytest.raises(LoadFailed):
        store.insert(snaps, "nope")
    store.drop("nope")


def test_reconcile(spark, snaps, tmp_path):
    store = Store(spark, "three", str(tmp_path / "three"))
    store.load(snaps.filter("period = 'feb'"), {"snapshots": SCHEMA})
    want = [("highly_cited_only", "feb", "physics", 4), ("incites_researchers", "feb", "physics", 5), ("x", "feb", "physics", 1)]
    out = store.reconcile("snapshots", spark.createDataFrame(want, "sheet_type string, period string, subject string, row_count bigint"))
    assert {(r["sheet_type"], r["verdict"]) for r in out.collect()} == {
        ("highly_cited_only", "ok"),
        ("incites_researchers", "row_count_mismatch"),
        ("x", "missing"),
    }


def test_a_load_may_read_what_it_replaces_and_a_failed_one_changes_nothing(spark, snaps, tmp_path, monkeypatch):
    store = Store(spark, "four", str(tmp_path / "four"))
    store.load(snaps, {"t": SCHEMA, "other": SCHEMA}, {"highly_cited_only": "t"}, "other")
    report = store.load(store.read("t").filter("papers > 1"), {"t": SCHEMA}, counters={"papers": F.sum("papers")})
    assert (report.rows_in, report.rows_stored, report.counted) == (4, 4, {"t": {"papers": 10}})
    assert store.tables() == ["t"] and store.count("t") == 4  # ``other`` was cleared
    with pytest.raises(LoadFailed):
        store.load(snaps, {"t": "name STRING, orcid STRING"})
    with pytest.raises(LoadFailed):
        store.load(snaps.filter("false"), {"t": SCHEMA})
    assert store.count("t") == 4 and len(os.listdir(tmp_path / "four")) == 1
    # Broken off between the two renames, the former table comes back.
    rename, calls = Store._rename, []

    def once(self, old, new):
        calls.append(old)
        if len(calls) == 2:
            raise KeyboardInterrupt
        rename(self, old, new)

    monkeypatch.setattr(Store, "_rename", once)
    with pytest.raises(KeyboardInterrupt):
        store.create(snaps, "t")
    monkeypatch.undo()
    assert not store.exists("t")
    assert Store(spark, "four").count("t") == 4


def test_files_of_others_stay(spark, snaps, tmp_path):
    """A table that somebody else put into the database is dropped without its files."""
    snaps.write.parquet(str(tmp_path / "theirs"))
    store = Store(spark, "six", str(tmp_path / "six"))
    spark.sql(f"CREATE TABLE six.theirs USING parquet LOCATION '{tmp_path}/theirs'")
    store.create(snaps, "ours")
    assert store.tables() == ["ours", "theirs"]
    store.clear()
    assert store.tables() == [] and os.listdir(tmp_path / "six") == [] and len(os.listdir(tmp_path / "theirs")) > 1


UNTIDY = """Name,Papers,Cited
Ada,1,2
b,1
c,3,4,EXTRA
"two
lines",5,6
"q""x, y",7,8
d,9,10,, ,
e,,,
,,,,
f,1,"unclosed
"""


def test_records_that_cannot_be_read_are_reported(spark, tmp_path):
    write(f"{tmp_path}/s/a.csv", UNTIDY)
    checked = S.read_checked(spark, f"{tmp_path}/s")
    kept = {r["Name"]: (r["Papers"], r["Cited"]) for r in S.kept_rows(checked).collect()}
    assert kept["Ada"] == ("1", "2") and kept["two\nlines"] == ("5", "6") and kept["d"] == ("9", "10") and kept["e"] == (None, None)
    assert "b" not in kept and "c" not in kept
    rejects = {r[S.RAW].strip(): r[S.REASON] for r in S.rejected_rows(checked).collect()}
    assert rejects["b,1"] == "missing fields" and rejects["c,3,4,EXTRA"] == "surplus fields"
    counts = S.file_outcomes(checked).first()
    assert counts["repaired"] == 3 and counts["good"] + counts["rejected"] == 6
    # Line by line, a broken record is rejected, not read as two.
    lines = S.read_checked(spark, f"{tmp_path}/s", multiline=False)
    assert not {"two", "lines"} & {r["Name"] for r in S.kept_rows(lines).collect()}
    everything = S.read_rejects(spark, {"feb": str(tmp_path)}, ["s", "none"])
    assert {(r["sheet_type"], r["period"], r["subject"]) for r in everything.collect()} == {("s", "feb", "a")}


def test_json_lines_that_cannot_be_read_are_reported(spark, tmp_path):
    write(f"{tmp_path}/s/a.json", json.dumps({"Name": "Ada", "Papers": 1}) + "\n{broken\n")
    for schema in (None, "Name STRING, Papers STRING"):
        checked = S.read_checked(spark, f"{tmp_path}/s", "json", schema)
        assert [r["Name"] for r in S.kept_rows(checked).collect()] == ["Ada"]
        assert [(r[S.REASON], r[S.RAW]) for r in S.rejected_rows(checked).collect()] == [("unreadable", "{broken")]


def entity(name, papers=1):
    return {"name": name, "esi_field": "Physics", "highly_cited_papers": papers, "indicative_cross_field_score": 0.5, "hot_papers": 0, "times_cited": 9}


def document(cid):
    values = {"highly_cited_papers": 1, "indicative_cross_field_score": 0.5, "hot_papers": 0, "times_cited": 9}
    change = {
        "name": "Ada", "esi_field": "Physics", "highly_cited_papers_change": 2, "cross_field_score_change": 0.1, "hot_papers_change": 0,
        "times_cited_change": 0, "feb_values": values, "july_values": values | {"highly_cited_papers": 3},
        "percentage_changes": {"highly_cited_papers": float("inf")},
    }
    return {
        "comparison_id": cid,
        "summary_statistics": {"dataset_1_total": 3},
        "researcher_changes": [change],
        "researchers_unchanged": [entity("Bob")],
        "researchers_only_in_dataset_1": [entity("Cy")],
        "researchers_only_in_dataset_2": [entity("Dee"), entity("Eve")],
    }


def test_nested_documents(spark, tmp_path):
    folder = f"{tmp_path}/highly_cited_only"
    write(f"{folder}/space_science_highly_cited_only_comparison_report.json", json.dumps(document("space_science_highly_cited_only"), indent=2))
    bad = document("x")
    del bad["summary_statistics"]
    write(f"{folder}/bad_comparison_report.json", json.dumps(bad))
    write(f"{folder}/broken_comparison_report.json", "{not json")
    write(f"{folder}/readme.json", "{}")
    docs = reports.read_documents(spark, str(tmp_path))
    good = reports.valid_documents(docs)
    row = reports.document_counts(good).first()
    assert (row["subject"], row["sheet_type"], row["entity_count"]) == ("space_science", "highly_cited_only", 5)
    assert (row["display_subject"], row["dataset_type"]) == ("Space Science", "highly_cited_only")
    rejected = {os.path.basename(r["source_file"]): r["missing"] for r in reports.rejected_documents(docs).collect()}
    assert rejected["bad_comparison_report.json"] == "summary_statistics"
    assert "broken_comparison_report.json" in rejected and len(rejected) == 2
    flat = {r["name"]: r for r in reports.document_entities(good).collect()}
    assert flat["Ada"]["status"] == "changed" and flat["Ada"]["highly_cited_papers_change"] == 2
    assert flat["Dee"]["highly_cited_papers_1"] is None and flat["Cy"]["highly_cited_papers_2"] is None
    assert flat["Bob"]["highly_cited_papers_change"] == 0
    infinite = good.select(F.col("researcher_changes")[0]["percentage_changes"]["highly_cited_papers"]).first()[0]
    assert infinite == float("inf")


def test_report_round_trip(spark, canon, tmp_path):
    rows = [
        ("space science", "highly_cited_only", p, n, "Physics", papers, 0.5, 0, 9)
        for p, n, papers in [("feb", "Ada", 0), ("july", "Ada", 2), ("feb", "Bob", 1), ("july", "Bob", 1), ("feb", "Cy", 1), ("july", "Dee", 1)]
    ]
    result = plan.run(canon(spark, rows), R.researcher_spec())
    root = str(tmp_path / "reports")
    plan.save(result, root, date="2025-07-01T00:00:00")
    back = reports.read_entities(spark, root, "name STRING, status STRING, highly_cited_papers_relative DOUBLE")
    got = {r["name"]: r for r in back.collect()}
    assert {n: r["section"] for n, r in got.items()} == {
        "Ada": "researcher_changes",
        "Bob": "researchers_unchanged",
        "Cy": "researchers_only_in_dataset_1",
        "Dee": "researchers_only_in_dataset_2",
    }
    assert got["Ada"]["highly_cited_papers_relative"] == float("inf")
    assert got["Ada"]["comparison_id"] == "space_science_highly_cited_only"
    doc = spark.read.json(f"{root}/summaries").first()
    assert doc["summary_statistics"]["total_researchers_compared"] == 2
    assert doc["dataset_1_info"]["table_name"] == "space_science_feb_highly_cited_only"
    assert doc["comparison_date"] == "2025-07-01T00:00:00"
    assert json.loads(doc["comparison_config"])["periods"] == ["feb", "july"]
    run = spark.read.json(f"{root}/comparison_summary").first()
    assert (run["successful_comparisons"], run["dataset_2_period"]) == (1, "july")


def test_ids_in_report_rows(spark, canon):
    rows = [("a b", "t", "feb", "Ada", "f", 1, 0.5, 0, 9), ("a b", "t", "july", "Ada", "f", 1, 0.5, 0, 9)]
    spec = R.researcher_spec()
    out = reports.report_rows(C.compare(canon(spark, rows), spec), spec).first()
    assert (out["comparison_id"], out["sheet_type"], out["section"]) == ("a_b_t", "t", "researchers_unchanged")


def test_from_files_to_reports(spark, tmp_path):
    """Folders are read, prepared, stored, compared and reported."""
    header = "Name,Times Cited,Highly Cited Papers,ESI Field,Hot Papers,Indicative Cross-Field Score\n"
    feb = "Ada,100,2,physics,0,0.4\nBob,200,3, Physics ,1,0.5\nCy,90,1,physics,,0.3\n"
    july = "Ada,150.0,4,PHYSICS,1,0.6\nBob,200,3,physics,1,0.5\nDee,80,1,physics,0,0.2\n"
    write(f"{tmp_path}/feb/Highly Cited only/physics.csv", header + feb)
    write(f"{tmp_path}/july/Highly Cited only/physics.csv", header + july)
    write(f"{tmp_path}/feb/Highly Cited only/space science.csv", header + "Ada,1,1,space science,0,0.5\n")
    write(f"{tmp_path}/july/Highly Cited only/space science.csv", header + "Ada,1,2,space science,0,0.5\n")
    write(f"{tmp_path}/feb/Highly Cited only/lonely.csv", header + "Zed,1,1,physics,0,0.1\n")

    folders = {p: f"{tmp_path}/{p}" for p in R.PERIODS}
    raw = S.read_periods(spark, folders, R.SHEETS, R.COLUMN_MAPPING, R.SNAPSHOT_SCHEMA)
    assert raw.count() == 9
    prepared = preparation.light_transform(raw, R.researcher_transform(), mapped=True)
    store = Store(spark, "flow", str(tmp_path / "tables"))
    store.load(prepared, {"snapshots": R.STORED_SCHEMA})
    verdicts = store.reconcile("snapshots", S.extraction_metadata(raw)).select("verdict").distinct().collect()
    assert [r["verdict"] for r in verdicts] == ["ok"]

    stored = store.read("snapshots")
    assert {f.name: f.dataType.simpleString() for f in stored.schema.fields}["times_cited"] == "int"
    result = plan.run(stored, R.researcher_spec(), analysed=R.ANALYSED)
    status = {(r["subject"], r["name"]): r["status"] for r in result.compared.collect()}
    assert status == {
        ("physics", "Ada"): "changed",
        ("physics", "Bob"): "unchanged",
        ("physics", "Cy"): "only_in_1",
        ("physics", "Dee"): "only_in_2",
        ("space_science", "Ada"): "changed",
    }
    missing = result.coverage.filter("NOT is_complete").first()
    assert (missing["subject"], missing["missing_period"]) == ("lonely", "july")
    assert result.duplicates.agg(F.sum("current_duplicates")).first()[0] == 0

    views = plan.dashboard(result.compared, result.summary, Roles(by=("sheet_type",)))
    top = views["top_increases"].first()
    assert (top["name"], top["paper_change"], top["total_score"], top["category"]) == ("Ada", 2, 1.1, "Cross-Field")
    plan.save(result, f"{tmp_path}/reports")
    docs = spark.read.json(f"{tmp_path}/reports/summaries")
    assert {r[0] for r in docs.select("comparison_id").collect()} == {"physics_highly_cited_only", "space_science_highly_cited_only"}
    assert "outlier_analysis" in docs.columns and "duplicate_analysis" in docs.columns


def test_contents_do_not_depend_on_order_and_notice_everything_else(spark):
    rows = [("a", None, 1.0), ("b", 2, 0.0), ("b", 2, 0.0), (None, 2, float("nan"))]
    schema = "name string, n int, x double"
    contents = lambda rows: snapshot_contents(spark.createDataFrame(rows, schema).repartition(3), []).first()["content_hash"]
    want = contents(rows)
    assert contents(rows[::-1]) == want and contents([*rows[:3], (None, 2, float("nan"))]) == want
    for other in (rows[:3], [*rows, rows[1]], [("a", 1, 1.0), *rows[1:]], [(None, None, 1.0), *rows[1:]], [("a", None, 1.0), ("b", 2, 0.0), (None, 2, float("nan")), (None, 2, float("nan"))]):
        assert contents(other) != want


def test_counters_come_from_the_write(spark, snaps, tmp_path):
    """Every row passes once while a table is loaded and counted."""
    passed = spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            passed.add(len(b))
            yield b

    store = Store(spark, "five", str(tmp_path / "five"))
    rows = snaps.mapInPandas(through, snaps.schema)
    report = store.load(rows, {"t": SCHEMA}, counters={"papers": F.sum("papers"), "n": F.count(F.lit(1))})
    assert (report.rows_in, report.rows_stored, report.counted["t"]) == (16, 16, {"papers": 24, "n": 16}) and passed.value == 16


def test_pages_skip_the_files_of_others(spark, tmp_path):
    rows = [(f"N{i:04d}" if i % 50 else None, i % 7, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "name string, n int, id int")
    keys = {"k1": -F.col("n"), "k2": F.lower("name"), "k3": F.col("id")}
    pages = Pages.write(df, str(tmp_path / "pages"), keys, ranges=8, lookup=["name"])
    want = sorted(rows, key=lambda r: (-r[1], r[0] is not None, (r[0] or "").lower(), r[2]))
    got, after = [], None
    while page := pages.page(90, after).collect():
        got += [(r["name"], r["n"], r["id"]) for r in page]
        after = tuple(page[-1][k] for k in keys)
    assert got == want
    second = pages.page(90, tuple(pages.page(90).collect()[-1][k] for k in keys))
    plan_text = second._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_range#" in plan_text
    read = {r["f"] for r in second.select(F.input_file_name().alias("f")).collect()}
    files = {r["f"] for r in pages.rows().select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) >= 8 and len(read) <= 2


def test_names_are_found_by_trigrams(spark, tmp_path):
    names = ["Ada Lovelace", "ADA", "ad", "Bob", None, "", "Cada", "\u00c4da \u00df", "lovelace lovelace", "a%b_c"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate([*names, *names])], "name string, i int")
    index = NameIndex.write(df, str(tmp_path / "names"))
    for text in ("ada", "LACE", "ad", "", "love", "lovelace l", "\u00e4DA", "%b_", "zzz", "adada"):
        found = sorted(r["i"] for r in index.search(df, text).collect())
        assert found == sorted(r["i"] for r in filters.search(df, text).collect()), text
    plan_text = index.names("lovelace")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan_text) and "In(gram, " in plan_text
