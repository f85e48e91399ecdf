"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps what was
measured and one bit for each rule that failed. A policy is a set of rules
with a version; it only reads the bits, so a new version needs no second pass
over the texts, and ablations are sums over the distinct bit patterns.

Everything is a native expression of one row: no shuffle, no Python.

Defined cases: a null or empty text has no words and measures 0 everywhere; a
rule whose denominator is 0 does not fail, but ``few_words`` does. Null ids,
repeated rows and extra columns are carried along as they are. An empty table
gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, table, whole, words
from tidemark.llm.registry import query
from tidemark.session import materialise

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition on the measurements."""

    name: str
    failed: str


# Limits in the manner of published web-text filters, as whole-number arithmetic. Half of the lines, not less, must
# repeat: a document of three lines with one line as header and footer is a clean one.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_words", "n_words > 100000"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 3 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """The rules that reject a document, by name."""

    version: str
    rules: tuple[str, ...]


BASE = Policy("base", ("few_words", "repeated_words"))
FULL = Policy("full-1", tuple(r.name for r in RULES))


def measurements(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words."""
    t = whole(text)
    filled = F.filter(F.split(t, "\n", -1), lambda line: F.translate(line, SPACES, "") != "")
    lines = let(filled, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("different")))
    counted = let(words(text), lambda w: F.struct(F.size(w).alias("n"), _repeated(w).alias("repeated")))
    return {
        "_words": counted,
        "_lines": lines,
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }


def _repeated(w: Column) -> Column:
    """Number of words inside three-word windows that occur at least twice.

    Windows are sorted by a 64-bit hash with their places; equal neighbours
    repeat. A window covers the words up to the next repeated window, three at
    most. In a text of 20,000 words two different windows share a hash with a
    chance of one in 10**11.
    """
    windows = F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
    )

    def same(s: Column, x: Column, j: Column) -> Column:
        return F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))

    repeats = let(F.array_sort(windows), lambda s: F.filter(s, lambda x, j: same(s, x, j - 1) | same(s, x, j + 1)))
    covered = let(
        F.array_sort(F.transform(repeats, lambda x: x["i"])),
        lambda p: F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))),
    )
    return F.aggregate(covered, F.lit(0).cast("long"), lambda total, x: total + x)


def ledger(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``; bit i belongs to ``rules[i]``.

    Columns of ``docs`` with the name of a measurement are replaced.
    """
    found = measurements(F.col(f"`{text}`"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (*MEASURES, "failed_bits", "_words", "_lines")]
    measured = docs.select(*rest, *[e.alias(n) for n, e in found.items()]).select(
        *rest,
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.n").cast("long").alias("n_lines"),
        (F.col("_lines.n") - F.col("_lines.different")).cast("long").alias("n_dup_lines"),
        F.col("_words.repeated").alias("n_repeat_words"),
    )
    bits = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failed_bits", bits)


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    place = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << place[name] for name in policy.rules)


def fails(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with ``kept`` and the version of the policy that decided."""
    return rows.withColumns({"kept": ~fails(policy, rules), "policy": F.lit(policy.version)})


def ablations(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents it fails, and those only it rejects.

    Rows are first summed by bit pattern, which leaves at most 2**rules rows.
    """
    used = mask(policy, rules)
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(used).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    place = {r.name: i for i, r in enumerate(rules)}
    one = F.explode(
        F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << place[n]).cast("long").alias("bit")) for n in policy.rules])
    )
    return (
        patterns.select("bits", "n", one.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this"),
        )
        .withColumn("policy", F.lit(policy.version))
    )


def accepted(docs: DataFrame, policy: Policy = FULL, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns."""
    columns = [f"`{c}`" for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("_row"), F.col(f"`{text}`").alias("_text"))
    return apply_policy(ledger(packed, "_text"), policy).filter("kept").select("_row.*")


_WS = r"[\x20\x09-\x0D]"
SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{r"[^\x20\x09-\x0D]+"}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{r"[^\x20\x09-\x0D]"}')) AS lines
  FROM t
),
g AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
),
twice AS (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n
  FROM g JOIN twice USING (doc_id, g), (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
),
b AS (
  SELECT *, {" + ".join(f"CASE WHEN {r.failed} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))} AS bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & {mask(BASE)} <> 0 AS base_failed, bits & {mask(FULL)} = 0 AS kept,
       n_lines, CAST(bits AS BIGINT) AS failed_bits
FROM b"""


@query(SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), FULL)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        fails(BASE).alias("base_failed"), "kept", "n_lines", "failed_bits",
    )


def _ablation_sql(policy: Policy) -> str:
    place = {r.name: i for i, r in enumerate(RULES)}
    used = mask(policy)
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE bits & {1 << place[n]} <> 0) AS failed, count(*) FILTER (WHERE bits & {used} = {1 << place[n]}) AS only_this, '{policy.version}' AS policy FROM b"
        for n in policy.rules
    )


@query(SQL.rsplit("SELECT doc_id, n_words, word_chars", 1)[0] + f"{_ablation_sql(BASE)} UNION ALL {_ablation_sql(FULL)}")
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of two policies rejects, and what it alone does, from one ledger."""
    rows = materialise(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")).select("failed_bits"), "ledger")
    return ablations(rows, BASE).unionByName(ablations(rows, FULL))
