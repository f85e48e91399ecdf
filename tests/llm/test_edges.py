"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, operator by operator."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, exact, langid, lexical, mixing, near, packing, quality, scoring, substrings, trie, urls, warc

DOCS = "doc_id bigint, text string, lang string, source string, n bigint, kept boolean, _row string"
LONG = " ".join(f"w{i}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ROWS = [
    (1, None, None, None, 1, None, "x"),
    (2, "", "en", "a", None, True, None),
    (None, "some text of a row without an id " + PASSAGE, "en", None, 3, None, None),
    (None, None, None, "b", 3, None, None),
    (4, LONG, "en", "a", 4, None, None),
    (5, LONG, "en", "b", 4, None, None),
    (6, "Repeated Row " + PASSAGE, "de", "a", 5, False, "y"),
    (6, "Repeated Row " + PASSAGE, "de", "a", 5, False, "y"),
    (7, "repeated row " + PASSAGE, "de", "a", 6, False, "z"),
    (8, " \t\n\x0b\f\r ", "de", "a", 6, False, "z"),
    (9, "\u00a0 ünï \U0001f600 #*$ 12", "fr", "a", 6, False, "z"),
]


@pytest.fixture(scope="module", params=["rows", "no rows"])
def docs(request, spark):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], DOCS).repartition(3)


def test_quality(docs):
    rows = quality.apply_policy(quality.ledger(docs), quality.FULL)
    found = {r["doc_id"]: r for r in rows.collect()}
    assert rows.count() == docs.count()
    assert {r["rule"]: r["only_this"] for r in quality.ablations(rows, quality.FULL).collect()}.keys() <= {r.name for r in quality.RULES}
    if found:
        assert (found[1]["n_words"], found[1]["word_chars"], found[1]["n_repeat_words"], found[1]["kept"]) == (0, 0, 0, False)
        assert (found[4]["n_words"], found[4]["kept"]) == (30_000, True)
        assert (found[9]["n_words"], found[9]["n_symbols"], found[9]["word_chars"]) == (5, 3, 10)
        assert found[8]["n_words"] == 0
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes


def test_exact(docs):
    found = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.copies(docs).collect()), key=str)
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns
    if not docs.isEmpty():
        by = {}
        for i, k, n, kept_row in found:
            by.setdefault(i, []).append((k, n, kept_row))
        assert by[1] == [(2, 3, False)] and by[2] == [(2, 3, True)]
        assert by[4] == [(5, 2, False)] and by[6] == [(7, 3, False)] * 2 and by[7] == [(7, 3, True)]
        assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 5, 7, 8, 9]
    else:
        assert found == [] and kept.isEmpty()


def test_exact_leaves_one_of_repeated_rows(spark):
    rows = [(3, "a"), (3, "a"), (1, "a"), (None, "b"), (None, "b")]
    assert sorted(map(tuple, exact.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str) == [(3, "a"), (None, "b")]


def test_near(docs):
    found = near.classes(docs).collect()
    kept = near.deduplicate(docs)
    assert kept.columns == docs.columns
    assert len(found) == docs.count()
    if found:
        by = {r["id"]: r for r in found if r["id"]}
        assert by[5]["class_id"] == 4 and by[5]["copies"] == 2 and by[5]["n_links"] == 0
        assert by[1]["class_id"] == by[2]["class_id"] == by[8]["class_id"] == 1
        assert by[7]["class_id"] == 6 and by[7]["copies"] == 3
        assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [1, 4, 6, 9] or sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 6, 9]
    else:
        assert kept.isEmpty()


def test_mixing(docs):
    found = mixing.take(docs).collect()
    mixed = mixing.mixed(docs)
    assert len(found) == docs.count() and mixed.columns == docs.columns
    if found:
        sizes, taken, want = {}, {}, {}
        for r in found:
            assert 0 <= r["copies"] <= 3
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
            taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
            want[r["source"]] = r["target"]
        assert all(r["source_size"] == sizes[r["source"]] for r in found)
        assert sum(want.values()) == pytest.approx(sum(sizes.values()))
        assert all(want[s] <= 3 * sizes[s] + 1e-6 for s in sizes)
        assert mixed.count() == sum(r["copies"] for r in found)
    else:
        assert mixed.isEmpty()


def test_packing(docs):
    found = packing.pack(docs, capacity=128, per_source=1).collect()
    bins = {}
    for r in found:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for rows in bins.values():
        assert sum(r["n_words"] for r in rows) == rows[0]["filled"] <= 128
        assert len({r["cluster"] for r in rows}) == len(rows)
        assert len({r["source"] for r in rows}) == len(rows)
    assert len({(r["id"], r["cluster"], r["source"], r["turn"]) for r in found}) == docs.count()
    if found:
        pieces = sorted((r["first_word"], r["n_words"]) for r in found if r["id"] == 4)
        assert sum(n for _, n in pieces) == 30_000 and pieces[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:]))


def test_substrings(docs):
    found = {}
    for r in substrings.remove(docs).collect():
        found.setdefault(r["id"], []).append((r["n_words"], r["n_removed"], r["kept"]))
    assert sum(map(len, found.values())) == docs.count()
    if found:
        assert found[1] == found[2] == [(0, 0, "")]
        assert found[4][0][1] == 0 and found[5] == [(30_000, 30_000, "")]
        assert found[6] == [(62, 0, "Repeated Row " + PASSAGE)] * 2  # no smaller id has the passage
        assert found[7] == [(62, 60, "repeated row")]
        assert (68, 60, "some text of a row without an id") in found[None]


def test_scoring(docs):
    found = scoring.score(docs.withColumn("learn", F.col("doc_id") != 4)).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r["score"] < 0 or r["n_tokens"] == r["n_known"]
    if found:
        by = {r["id"]: r for r in found if r["id"]}
        assert by[1]["n_tokens"] == 1 and by[4]["n_tokens"] == 30_001 and by[1]["n_known"] == 1


def test_language(docs):
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text", "lang")
    model = langid.train(rows)
    found = langid.predict(rows.select("id", "text"), model).collect()
    assert len(found) == docs.count()
    for r in found:
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] == "und") <= (r["score"] == 0)
    if found:
        assert {r["id"]: r["lang_pred"] for r in found}["1"] == "und"
        assert {r["lang_pred"] for r in found} <= {"und", "en", "de", "fr"}


def test_urls(spark):
    rows = [
        (1, None), (None, "x"), (2, "http://A.Example.com:80/en/x?y"), (2, "http://A.Example.com:80/en/x?y"), (3, "://"), (4, "https://www.example.com/en/"),
        (5, "http://com"), (6, "http://b.net/es"), (7, "http://b.net/es/1#z"), (8, "http://a.co.uk/"), (9, "s://h/" + "p" * 100_000),
    ]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id bigint, url string, host string")
    labels = spark.createDataFrame([(8, 0, None, 1), (8, 0, 1, 1), (None, 0, 0, 1), (9, None, None, 1), (6, 1, 0, 1)], "doc_id bigint, quality int, toxic int, n int")
    found = {r["id"]: (r["host"], r["path"][:9], r["rule"], r["verdict"]) for r in urls.judge(pages, urls.outcomes(labels)).collect()}
    # The empty host has no labelled page, so it is judged as all pages are.
    assert found[1] == found[None] == found[3] and found[1][:3] == ("", "", None)
    assert found[2][:3] == ("a.example.com:80", "/en/x", None)
    assert found[4] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert found[5][2] is None and found[6][2] is None and found[7] == ("b.net", "/es/1", "net/es/", "block")
    empty = urls.judge(pages.limit(0), urls.outcomes(labels.limit(0)))
    assert empty.isEmpty()
    assert urls.judge(pages, urls.outcomes(labels.limit(0))).filter("verdict = 'block' AND rule IS NULL").isEmpty()


def test_chat(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, action string, place bigint"
    rows = [
        (1, 0, "user", "hi", "x", 1), (1, 1, None, None, "x", 1), (1, 2, "Assistant ", "a", "x", 1), (1, 2, "Assistant ", "a", "x", 1),
        (None, None, "system", "s", "x", 1), (2, 0, "assistant", "first", "x", 1), (3, 0, "user", "t" * 200_000, "x", 1),
    ]
    found = chat.repair(spark.createDataFrame(rows, schema)).orderBy("conv", "place").collect()
    by = {}
    for r in found:
        by.setdefault(r["conv"], []).append(r)
    assert "".join(r["rendered"] for r in by["2"]) == "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nfirst<|im_end|>\n"
    assert [r["action"] for r in by[None]] == ["keep", "insert", "insert"]
    assert len(by["3"]) == 2 and by["3"][0]["text"] == "t" * 200_000
    assert sum(r["action"] != "insert" for r in found) == len(rows)
    assert chat.repair(spark.createDataFrame([], schema)).isEmpty()


def test_lexical(docs, spark):
    items = spark.createDataFrame(
        [(1, "p1 p2 w7, REPEATED"), (1, "p1"), (None, "some text"), (2, None), (3, ""), (4, " .,- "), (5, LONG)], "item_id bigint, text string"
    )
    found = sorted(((r["item"], r["rank"], r["id"]) for r in lexical.search(docs.withColumn("item", F.lit(1)), items, k=3).collect()), key=str)
    if docs.isEmpty():
        assert found == []
    else:
        # Equal texts tie, the smaller id first; a null id comes last.
        assert [f for f in found if f[0] == 5] == [(5, 1, 4), (5, 2, 5)]
        assert [f for f in found if f[0] == 1] == [(1, 1, 6), (1, 1, 6), (1, 2, 6), (1, 2, 6), (1, 3, 7), (1, 3, 7)]
        assert (None, 1, None) in found and {f[0] for f in found} == {1, 5, None}
    assert lexical.search(docs, items.limit(0)).isEmpty()


def test_warc(spark, tmp_path):
    schema = "page_id bigint, url string, html string, digest string, record string, of int"
    rows = [
        (3, "http://a/", "same", None, "x", 1), (3, "http://a/", "same", None, "x", 1), (5, None, "same", None, None, None), (None, "u", "same", None, None, None),
        (1, "u", None, None, None, None), (2, "u", "", None, None, None), (None, "u", "alone", None, None, None), (None, "u", "alone", None, None, None),
        ((1 << 53) + 1, "http://ü/ ", "l\u00f6ng " * 200_000, None, None, None), ((1 << 53) + 3, "u", "l\u00f6ng " * 200_000, None, None, None),
    ]
    warc.write(spark.createDataFrame(rows, schema), f"{tmp_path}/some")
    found = sorted(((r["record"], r["type"], r["refers_to"], r["bytes"]) for r in warc.records(spark, f"{tmp_path}/some").collect()), key=str)
    big = (1 << 53) + 1
    assert found == sorted(
        [
            (3, "response", None, 4), (3, "response", None, 4), (5, "revisit", 3, 4), (None, "revisit", 3, 4), (1, "response", None, 0), (2, "revisit", 1, 0),
            (None, "response", None, 5), (None, "response", None, 5), (big, "response", None, 1_200_000), (big + 2, "revisit", big, 1_200_000),
        ], key=str,
    )
    warc.write(spark.createDataFrame([], schema), f"{tmp_path}/none")
    assert warc.records(spark, f"{tmp_path}/none").isEmpty()


def test_trie(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, depth int, conv string, pa bigint"
    rows = [
        (1, 0, "user", "hi", 9, "x", 1), (1, None, None, None, 9, "x", 1), (1, 1, "user", "hi", 9, "x", 1), (1, 1, "user", "hi", 9, "x", 1),
        (2, None, "", "", None, None, None), (2, 0, "user", "hi", 1, None, 1), (3, 4, "user", "t" * 200_000, 1, None, 1), (None, 0, "user", "hi", 1, None, 1),
        (None, None, None, None, None, None, None),
    ]
    turns = trie.sequences(spark.createDataFrame(rows, schema))
    found = trie.nodes(turns, turns.select("conv").distinct()).collect()
    by = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in found}
    # The turn without a number comes first; the turn that is there twice counts twice.
    assert by == {
        (1, 0): (None, 3, 2, 2, 2), (1, 1): (1, 2, 1, 1, 2), (1, 2): (1, 2, 1, 1, 2), (1, 3): (1, 1, 1, 1, 0), (1, 4): (1, 1, 0, 1, 0),
        (3, 1): (1, 1, 0, 1, 0),
    }
    none = trie.sequences(spark.createDataFrame([], schema))
    assert trie.nodes(none, none.select("conv").distinct()).isEmpty()
    # Conversations without turns are members of the root alone.
    alone = trie.nodes(none, spark.createDataFrame([(4,), (5,)], "conv bigint")).collect()
    assert [tuple(r)[:7] for r in alone] == [(4, 0, None, 2, 0, 1, 0)] and alone[0]["ends_sha256"] == trie.ends_hash([4, 5])


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pipeline_of_untidy_tables(spark, tmp_path, rows):
    """Nulls, repeated rows, clashing names and no rows at all go through every stage."""
    import corpus_pipeline

    long = [(100 + i, " ".join(f"x{i}y{k}" for k in range(80)) + f". End {i}.", "en", "ab"[i % 2], 1, None, "z") for i in range(6 if rows else 0)]
    spark.createDataFrame([*rows, *long], DOCS).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(found) == bool(rows)
    assert all(r["n_words"] <= packing.CAPACITY for r in found)
