"""URL filter by host reputation, with explicit rules on top.

Labelled pages count as good or bad outcomes. Counts are summed by host,
registered domain and suffix, and each level is shrunk towards the one above:
the mean of a suffix towards the mean of all pages, a domain towards its
suffix, a host towards its domain. How strongly is learned for each level from
how far its groups spread (the moment estimate of a beta-binomial). A host is
blocked if even the lower posterior bound of its bad share is above a limit.

Rules decide before reputation: a rule fits its host and all subdomains where
the path starts with the rule's path; the longest fitting rule wins.

All native. Outcomes are summed before they are shuffled, so a host with a
third of all pages is one row per task; reputations are attached to pages by
a join that spreads heavy hosts.

Defined cases: a url that is null or has no "://" has an empty host and path,
and the reputation of the empty host. A host of one label is its own domain
and suffix. Labels that are null on both sides, pages without labels and hosts
without labelled pages add nothing; such a host has the posterior of its
domain. Several labels of a page all count. Repeated rows are judged alike.
Without any labels nothing is blocked by reputation. An address in numbers is its
own domain and suffix. An empty table gives no rows. Very long urls are judged by their
host like others. Other columns of pages and labels are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, joined, table
from tidemark.llm.registry import query
from tidemark.operators.scale import attach
from tidemark.session import materialise, store

MOST_BAD = 0.3
SIGMAS = 1.645  # a one-sided bound of 95 %
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.5
# Second-level labels that countries use as public suffixes (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    """``place`` is host and path, as in ``example.com/en/``."""

    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.place.partition("/")[2]


RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


# An address has no domains above it.
ADDRESS = r"^([0-9]{1,3}([.][0-9]{1,3}){3}|\[.*\])(:[0-9]*)?$"


def suffix_labels(host: Column) -> Column:
    """Number of labels of the public suffix by rule; an address is all suffix."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    second = (F.length(F.element_at(labels, -1)) == 2) & F.coalesce(F.try_element_at(labels, F.lit(-2)), F.lit("")).isin(*SECOND_LEVEL)
    return F.when(host.rlike(ADDRESS), n).when((n > 2) & second, 2).otherwise(1)


def with_suffix_labels(hosts: DataFrame, suffixes: DataFrame | None) -> DataFrame:
    """``hosts`` with ``labels``, how many the public suffix has: the longest in ``suffixes`` (suffix), else by rule."""
    host = F.col("host")
    if suffixes is None:
        return hosts.withColumn("labels", suffix_labels(host))
    listed = store(suffixes.select(ascii_lower(F.col("suffix")).alias("_suffix")).distinct(), "suffixes")
    ends = hosts.select("host", F.explode(F.sequence(F.lit(1), F.size(F.split(host, r"\.")))).alias("k"))
    found = joined(ends, listed, _last(host, F.col("k")) == F.col("_suffix")).groupBy(host.alias("_host")).agg(F.max("k").alias("_k"))
    named = hosts.join(found, host.eqNullSafe(F.col("_host")), "left")
    by_list = F.when(~host.rlike(ADDRESS), F.col("_k"))
    return named.withColumn("labels", F.coalesce(by_list, suffix_labels(host))).drop("_host", "_k")


def _last(host: Column, n: Column) -> Column:
    labels = F.split(host, r"\.")
    n = F.least(n, F.size(labels))
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """place and verdict of the longest rule that fits, or null. The rules are a parameter, a list to be read in a glance."""
    ordered = sorted(rules, key=lambda r: (-len(r.place), r.place))
    listed = F.array(
        *[F.struct(F.lit(r.place).alias("place"), F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in ordered]
    )
    fits = F.filter(
        listed,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]),
    )
    return F.get(fits, 0)


def _strength(groups: DataFrame, prior: str) -> float:
    """Pseudo-counts of the prior: the moment estimate of how little groups spread around it."""
    p = F.col("bad") / F.col("n")
    s = groups.filter("n > 0").agg(
        F.sum("n").alias("total"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.count(F.lit(1)).alias("k"),
        F.sum("bad").alias("bad"), F.sum(F.col("n") * (p - F.col(prior)) * (p - F.col(prior))).alias("spread"),
    ).first()
    if not s["total"]:
        return 1 / MOST_SPREAD - 1
    mean = s["bad"] / s["total"]
    room = mean * (1 - mean) * (s["total"] - s["squares"] / s["total"] - (s["k"] - 1))
    gamma = (s["spread"] - mean * (1 - mean) * (s["k"] - 1)) / room if room > 0 else LEAST_SPREAD
    return 1 / min(max(gamma, LEAST_SPREAD), MOST_SPREAD) - 1


def reputations(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` (host, pages, n, bad) with mean, strength and the lower bound of the bad share."""
    h = F.col("host")
    counted = with_suffix_labels(hosts, suffixes)
    named = materialise(counted.withColumns({"domain": _last(h, F.col("labels") + 1), "suffix": _last(h, F.col("labels"))}).drop("labels"), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = named.groupBy("domain", "suffix").agg(*sums)
    tops = domains.groupBy("suffix").agg(*sums)
    whole = tops.agg(*sums).first()
    overall = whole["bad"] / whole["n"] if whole["n"] else 0.0

    def shrunk(groups: DataFrame, name: str) -> tuple[DataFrame, float]:
        strength = _strength(groups, "prior")
        mean = (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)
        return groups.withColumn(name, mean), strength

    suffix_means, _ = shrunk(materialise(tops.withColumn("prior", F.lit(float(overall))), "suffixes"), "prior_d")
    domain_rows = domains.join(suffix_means.select("suffix", F.col("prior_d").alias("prior")), "suffix")
    domain_means, _ = shrunk(materialise(domain_rows, "domains"), "prior_h")
    host_rows = named.join(domain_means.select("domain", F.col("prior_h").alias("prior")), "domain")
    found, strength = shrunk(materialise(host_rows, "hosts"), "bad_share")
    weight = F.col("n") + strength
    error = F.sqrt(F.col("bad_share") * (1 - F.col("bad_share")) / (weight + 1))
    return found.withColumn("bound", F.greatest(F.lit(0.0), F.col("bad_share") - SIGMAS * error))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, most_bad: float = MOST_BAD,
    id: str = "page_id", url: str = "url", suffixes: DataFrame | None = None,
) -> DataFrame:
    """id, host, path, rule, verdict, bad_share and bound of every page.

    ``outcomes``: id, n, bad. ``suffixes`` (suffix) lists public suffixes; without it a rule of thumb finds them.
    """
    u = F.col(f"`{url}`")
    parsed = pages.select(F.col(f"`{id}`").alias("id"), host_of(u).alias("host"), path_of(u).alias("path"))
    labelled = parsed.select("id", "host").join(outcomes, "id")
    counts = labelled.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    every = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    zero = F.lit(0).cast("long")
    hosts = every.join(counts, "host", "left").select("host", "pages", F.coalesce("n", zero).alias("n"), F.coalesce("bad", zero).alias("bad"))
    known = store(reputations(hosts, suffixes).select("host", "pages", "n", "bad", "bad_share", "bound"), "reputations")
    rated = attach(parsed, known, ["host"], "pages").withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    by_reputation = F.when(F.col("bound") > most_bad, "block").otherwise("allow")
    return rated.select(
        "id", "host", "path", F.col("_rule.place").alias("rule"), F.coalesce("_rule.verdict", by_reputation).alias("verdict"),
        F.col("n").alias("host_labelled"), F.col("bad").alias("host_bad"), "bad_share", "bound",
    )


def outcomes(labels: DataFrame) -> DataFrame:
    """id, n, bad: a page is bad if its label says low quality or toxic."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    known = labels.filter(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    return known.groupBy(F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"))


def _level(name: str, groups: str, prior: str) -> str:
    """SQL of one level of shrinkage: rows of ``groups`` with a prior get ``{name}``."""
    return f"""
{name}_s AS (
  SELECT sum(n) AS t, sum(n * n) AS q, count(*) AS k, sum(bad) AS b, sum(n * (bad / n - prior) * (bad / n - prior)) AS s
  FROM {groups} WHERE n > 0
),
{name}_m AS (
  SELECT 1 / least(greatest((s - b / t * (1 - b / t) * (k - 1)) / (b / t * (1 - b / t) * (t - q / t - (k - 1))), {LEAST_SPREAD}), {MOST_SPREAD}) - 1 AS m
  FROM {name}_s
),
{name} AS (SELECT *, (bad + m * prior) / (n + m) AS {prior} FROM {groups}, {name}_m)"""


def _rules_sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r.place), r.place))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    place = " ".join(f"WHEN {f} THEN '{r.place}'" for f, r in zip(fits, ordered))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, ordered))
    return f"CASE {place} END AS rule, CASE {verdict} END AS by_rule"


SQL = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
o AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1
),
h0 AS (
  SELECT host, CAST(coalesce(sum(n), 0) AS BIGINT) AS n, CAST(coalesce(sum(bad), 0) AS BIGINT) AS bad,
         string_split(host, '.') AS l
  FROM p LEFT JOIN o ON page_id = doc_id GROUP BY host
),
h1 AS (
  SELECT host, n, bad, l, CASE WHEN regexp_matches(host, '{ADDRESS}') THEN len(l) WHEN len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN {SECOND_LEVEL} THEN 2 ELSE 1 END AS w FROM h0
),
h AS (
  SELECT host, n, bad, array_to_string(l[greatest(len(l) - w, 1):], '.') AS domain, array_to_string(l[greatest(len(l) - w + 1, 1):], '.') AS suffix FROM h1
),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT sum(bad) / sum(n) FROM h) AS prior FROM d GROUP BY suffix),
{_level("s1", "s", "prior_d")},
d0 AS (SELECT d.*, prior_d AS prior FROM d JOIN s1 USING (suffix)),
{_level("d1", "d0", "prior_h")},
h2 AS (SELECT h.*, prior_h AS prior FROM h JOIN d1 USING (domain)),
{_level("h3", "h2", "bad_share")},
r AS (SELECT host, n, bad, bad_share, greatest(0, bad_share - {SIGMAS} * sqrt(bad_share * (1 - bad_share) / (n + m + 1))) AS bound FROM h3),
j AS (SELECT page_id, p.host, path, n, bad, bad_share, bound, {_rules_sql().replace("(host ", "(p.host ").replace("(host,", "(p.host,")} FROM p JOIN r ON p.host = r.host)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN bound > {MOST_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
       n AS host_labelled, bad AS host_bad, round(bad_share, 6) AS bad_share, round(bound, 6) AS bound
FROM j"""


@query(SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes(table(spark, sf_dir, "labels")))
    return judged.withColumnRenamed("id", "page_id").withColumns({c: F.round(c, 6) for c in ("bad_share", "bound")})
