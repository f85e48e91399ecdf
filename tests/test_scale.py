"""The paths for large tables give the same rows as the small ones."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import duplicates, scale, stats
from tidemark.operators.duplicates import flag_duplicates
from tidemark.operators.stats import profile, with_outliers
from tidemark.session import CHECKPOINT_KEY, materialise, scratch_dir, scratch_scope, store


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, some keys are null."""
    rng = random.Random(7)
    keys = ["hot"] * 400 + [None] * 50 + [f"k{rng.randrange(200)}" for _ in range(750)]
    rng.shuffle(keys)
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string").repartition(6)


@pytest.mark.parametrize("limit, heavy", [(1 << 30, 5), (0, 5), (0, 1), (0, 1000)])
@pytest.mark.parametrize("null_safe", [(), ("k",)])
def test_attach(spark, skewed, limit, heavy, null_safe):
    counts = store(skewed.groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("first")))
    out = scale.attach(skewed, counts, ["k"], "n", null_safe, limit, heavy).collect()
    assert len(out) == 1200
    first = {}
    for r in skewed.collect():
        first[r["k"]] = min(first.get(r["k"], 10**9), r["i"])
    for r in out:
        want = first[r["k"]] if r["k"] is not None or null_safe else None
        assert r["first"] == want


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_keep_matching(spark, skewed, limit):
    keys = store(spark.createDataFrame([("hot", 400), ("k1", 4), ("absent", 1)], "k string, n int"))
    out = scale.keep_matching(skewed, keys, ["k"], "n", broadcast_bytes=limit, parts=2)
    assert Counter(r["k"] for r in out.collect()) == Counter(
        r["k"] for r in skewed.collect() if r["k"] in ("hot", "k1")
    )


@pytest.mark.parametrize("group_limit", [None, 0])
def test_running_totals(spark, group_limit):
    rng = random.Random(3)
    rows = [(g, v, rng.randrange(1, 9)) for g in ("a", "b", None) for v in rng.sample(range(10_000), 300)]
    df = spark.createDataFrame(rows, "g string, v int, n bigint").repartition(5)
    out = scale.running_totals(store(df), ["g"], ["v"], "n", {"s": F.col("n") * F.col("v")}, group_limit).collect()
    assert len(out) == len(rows)
    for r in out:
        mine = [(v, n) for g, v, n in rows if g == r["g"]]
        assert r["before"] == sum(n for v, n in mine if v < r["v"])
        assert r["total"] == sum(n for _, n in mine)
        assert r["s"] == sum(n * v for v, n in mine)



def test_large_paths_match(spark, sf_dir, monkeypatch):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    small = with_outliers(events, ["value"], ["event_type"]).orderBy("event_id").collect()
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    flagged = flag_duplicates(parts, ["p_name", "p_brand"]).orderBy("p_partkey").collect()
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 0)
    monkeypatch.setattr("tidemark.operators.stats.BROADCAST_BYTES", 0)
    monkeypatch.setattr(scale, "GROUP_LIMIT", 0)
    assert profile(events, ["value"], ["event_type"]).count() == 5
    big = with_outliers(events, ["value"], ["event_type"]).orderBy("event_id").collect()
    assert [(r["event_id"], round(r["value_percentile"], 9), r["value_outlier_flag"]) for r in big] == [
        (r["event_id"], round(r["value_percentile"], 9), r["value_outlier_flag"]) for r in small
    ]
    assert flag_duplicates(parts, ["p_name", "p_brand"]).orderBy("p_partkey").collect() == flagged


def test_heavy_and_null_keys_are_spread(spark, skewed):
    """The shuffled join sends rows of the heavy key to several partitions."""
    counts = store(skewed.groupBy("k").agg(F.count("*").alias("n"), F.min("i").alias("first")))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        out = scale.attach(skewed, counts, ["k"], "n", (), 0, 4).withColumn("p", F.spark_partition_id())
        assert "hashpartitioning(k#" in out._jdf.queryExecution().executedPlan().toString()
        sizes = out.groupBy("k", "p").agg(F.count("*").alias("n")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [r["n"] for r in sizes if r["k"] == "hot"]
    assert sum(hot) == 400 and max(hot) < 300
    assert len([r for r in sizes if r["k"] is None]) > 1


def test_wide_heavy_keys_are_fewer(spark, skewed, monkeypatch):
    monkeypatch.setattr(scale, "HEAVY_BYTES", 100)
    counts = store(skewed.groupBy("k").agg(F.count("*").alias("n"), F.lit("x" * 30).alias("wide")))
    assert 0 < scale._heaviest(counts.df, ["k"], "n", 50).count() < 3
    assert scale.attach(skewed, counts, ["k"], "n", ("k",), 0, 50).filter("wide IS NULL").isEmpty()


def test_attach_casts_and_zeros(spark):
    """Equal keys meet in the large path whatever their type or sign of zero."""
    rows = spark.createDataFrame([(1, -0.0), (2, 0.0), (3, 1.5)], "i int, v double")
    values = store(spark.createDataFrame([(0.0, 2, "zero"), (1.5, 1, "more")], "v double, n bigint, label string"))
    out = scale.attach(rows, values, ["v"], "n", (), 0, 1)
    assert {r["i"]: r["label"] for r in out.collect()} == {1: "zero", 2: "zero", 3: "more"}
    ints = spark.createDataFrame([(1, 7)], "i int, k int")
    longs = store(spark.createDataFrame([(7, 1, "a"), (8, 2, "b"), (9, 3, "c")], "k bigint, n bigint, label string"))
    assert scale.attach(ints, longs, ["k"], "n", (), 0, 1).first()["label"] == "a"


def test_quartiles_of_tiny_groups(spark):
    df = spark.createDataFrame([("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None)], "g string, v double")
    stats = {r["g"]: r for r in profile(df, ["v"], ["g"]).collect()}
    assert (stats["one"]["q1"], stats["one"]["q3"], stats["one"]["std"], stats["one"]["std_pop"]) == (5.0, 5.0, None, 0.0)
    assert (stats["two"]["q1"], stats["two"]["q3"]) == (1.25, 1.75)
    assert "none" not in stats
    rows = with_outliers(df, ["v"], ["g"]).collect()
    assert {(r["g"], r["v_z_score"], r["v_percentile"], r["v_outlier_flag"]) for r in rows if r["g"] != "two"} == {
        ("one", 0.0, 0.0, "None"),
        ("none", 0.0, 0.0, "None"),
    }


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("a", float("nan"))], "g string, v double")
    stats = profile(df, ["v"], ["g"]).first()
    assert (stats["n"], stats["mean"], stats["max"]) == (9, 4.0, 8.0)
    odd = [r for r in with_outliers(df, ["v"], ["g"]).collect() if r["v"] != r["v"]]
    assert (odd[0]["v_z_score"], odd[0]["v_percentile"], odd[0]["v_outlier_flag"]) == (0.0, 0.0, "None")


def test_scratch_folder(spark):
    assert scratch_dir(spark) == spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    df = spark.range(10).toDF("x")
    assert materialise(df).count() == 10
    stored = store(spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int"))
    assert (stored.rows, stored.nbytes) == (2, 2 * 32 + 2 * 8 + 3)


class Elsewhere:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = self
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"

    def get(self, key, default=None):
        return self.folder if key == CHECKPOINT_KEY else default

    def getConf(self):
        return self


def test_scratch_folder_of_other_sessions():
    assert scratch_dir(Elsewhere("spark://host", "hdfs:///scratch/")) == "hdfs:///scratch"
    for master in ("local[2]", "spark://host"):
        with pytest.raises(RuntimeError, match=CHECKPOINT_KEY):
            scratch_dir(Elsewhere(master))


def test_keep_first_and_first_rows(spark, skewed):
    rows = skewed.withColumn("j", F.col("i") % 3)
    kept = {r["k"]: (r["j"], r["i"]) for r in scale.keep_first(rows, ["k"], ["j"]).collect()}
    want = {}
    for r in rows.collect():
        want[r["k"]] = min(want.get(r["k"], (9, 10**9)), (r["j"], r["i"]))
    assert kept == want
    top = scale.first_rows(skewed, ["k"], ["i"], 2).groupBy("k").count().collect()
    assert max(r["count"] for r in top) == 2


def test_a_flow_leaves_nothing_but_its_outputs(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    with scratch_scope(spark):
        stored = materialise(df)
        made = stored.inputFiles()[0].removeprefix("file://")
        stored.groupBy("k").count().write.parquet(str(tmp_path / "out"))
        assert os.path.exists(made)
    assert not os.path.exists(made)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_wide_rows_move_once_for_all_ranks(spark, monkeypatch):
    """Beyond the broadcast limit, only one shuffle carries the other columns, however many fields are ranked."""
    rows = [(i % 3, float(i % 17), float(i % 5) if i % 4 else None, float("nan") if i % 6 == 0 else -float(i), f"wide {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, payload string")
    key = ["g", "payload"]
    fields = ["a", "b", "c"]
    want = sorted(map(tuple, stats.with_outliers(df, fields, ["g"]).select(*key, *stats.statistics_columns(fields)).collect()))
    monkeypatch.setattr(stats, "BROADCAST_BYTES", 0)
    out = stats.with_outliers(df, fields, ["g"])
    plan_text = out._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan_text.splitlines() if re.search(r"Scan parquet.*payload", line)]
    assert len(wide) == 1 and len(re.findall(r"Exchange hashpartitioning\(_row", plan_text)) <= 2
    got = sorted(map(tuple, out.select(*key, *stats.statistics_columns(fields)).collect()))
    assert [[pytest.approx(x) if isinstance(x, float) else x for x in r] for r in want] == [list(r) for r in got]


@pytest.mark.parametrize("accuracy", [10_000, 50, 4])
def test_quartiles_from_brackets_are_exact(spark, monkeypatch, accuracy):
    """Also where the sketch is so coarse that brackets miss: the margin is none, and a group gets its whole range."""
    monkeypatch.setattr(stats, "ACCURACY", accuracy)
    if accuracy == 4:
        monkeypatch.setattr(stats, "MARGIN", 0.001)
    rng = np.random.default_rng(7)
    columns = {0: rng.normal(size=3001), 1: np.round(rng.normal(size=2000), 1), 2: np.full(500, 3.5), 3: rng.exponential(size=7), 4: np.repeat([1.0, 9.0], [900, 300])}
    rows = [(g, float(v)) for g, vs in columns.items() for v in vs] + [(5, None)]
    found = {r["g"]: r for r in stats.profile(spark.createDataFrame(rows, "g int, v double"), ["v"], ["g"]).collect()}
    assert sorted(found) == [0, 1, 2, 3, 4]
    for g, vs in columns.items():
        assert (found[g]["q1"], found[g]["q3"]) == (pytest.approx(np.quantile(vs, 0.25), abs=1e-12), pytest.approx(np.quantile(vs, 0.75), abs=1e-12))
        assert (found[g]["n"], found[g]["min"], found[g]["max"]) == (len(vs), vs.min(), vs.max())
        assert found[g]["std"] == pytest.approx(np.std(vs, ddof=1)) and found[g]["std_pop"] == pytest.approx(np.std(vs))


def test_brackets_keep_few_values(spark):
    """Of 60,000 different values, the second pass counts a small part."""
    df = spark.range(60_000).select(F.col("id").cast("double").alias("v"))
    moments = stats._moments(df, ["v"], [])
    row = moments.df.first()
    inside = sum(row[hi] - row[lo] + 1 for lo, hi in (stats.EDGES[:2], stats.EDGES[2:]))
    assert inside < 600
    assert stats.profile(df, ["v"]).first()["q1"] == 14_999.75


def test_duplicate_numbers_compare_beginnings_first(spark, monkeypatch):
    """Long keys with equal beginnings, zeros of both signs, and groups in slices keep their numbers."""
    texts = ["b" * 70 + "2", "b" * 70 + "1", "a", "b" * 70 + "1", "b" * 70 + "2", "c", "a"]
    df = spark.createDataFrame([(t, 1) for t in texts], "t string, n int")
    want = {"a": "DUP_0001", "b" * 70 + "1": "DUP_0002", "b" * 70 + "2": "DUP_0003", "c": ""}
    for limit in (duplicates.BEGINNING, 0):
        monkeypatch.setattr(scale, "GROUP_BYTES", 64 * 1024 * 1024 if limit else 1)
        assert {r["t"]: r["duplicate_group_id"] for r in duplicates.flag_duplicates(df, ["t"]).collect()} == want
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 1), (float("nan"), 1), (float("nan"), 1), (2.0, 1)], "x double, n int")
    assert [r["is_duplicate"] for r in duplicates.flag_duplicates(zeros, ["x"]).orderBy("x").collect()] == [True, True, False, True, True]
    assert sorted(r["n_rows"] for r in duplicates.duplicate_groups(zeros, ["x"]).collect()) == [2, 2]


def test_duplicate_keys_are_read_again_only_where_beginnings_are_shared(spark, monkeypatch):
    read = []

    def spied(rows, keys, on, *args, **kwargs):
        read.append((list(on), keys.rows))
        return scale.keep_matching(rows, keys, on, *args, **kwargs)

    monkeypatch.setattr(duplicates, "keep_matching", spied)
    short = spark.createDataFrame([("y", "b"), ("x", "a"), ("x", " A"), ("x", "c"), ("x", None), ("x", None), ("y", "B")], "g string, t string")
    found = {(r["g"], r["t"]): r["duplicate_group_id"] for r in duplicates.flag_duplicates(short, ["t"], ["g"]).collect()}
    assert found == {("y", "b"): "DUP_0001", ("y", "B"): "DUP_0001", ("x", "a"): "DUP_0002", ("x", " A"): "DUP_0002", ("x", "c"): "", ("x", None): "DUP_0001"}
    assert not read
    # 64 characters may be a whole key or the beginning of longer ones; two keys share a first key.
    texts = [t for t in ("a", "b" * 64, "b" * 65, "c" * 70, "d") for _ in range(2)]
    found = {r["t"]: r["duplicate_group_id"] for r in duplicates.flag_duplicates(spark.createDataFrame([(t,) for t in texts], "t string"), ["t"]).collect()}
    assert found == {t: f"DUP_{i:04d}" for i, t in enumerate(dict.fromkeys(texts), 1)}
    assert read == [(["_begin"], 1), (["_digest"], 2)]
    read.clear()
    pairs = [("a", "z"), ("a", None), ("b", "y"), ("c", "x")]
    df = spark.createDataFrame(pairs * 2, "t string, u string")
    found = {(r["t"], r["u"]): r["duplicate_group_id"] for r in duplicates.flag_duplicates(df, ["t", "u"]).collect()}
    assert found == {("a", None): "DUP_0001", ("a", "z"): "DUP_0002", ("b", "y"): "DUP_0003", ("c", "x"): "DUP_0004"}
    assert read == [(["_begin"], 1), (["_digest"], 2)]
