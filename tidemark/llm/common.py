"""What several operators share: tables, native word expressions, streamed groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import Stored, materialise, store

# Largest table that is sent to every executor, checked by measuring it.
BROADCAST_BYTES = 64 * 1024 * 1024
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    flat = F.trim(F.translate(whole(text), SPACES, " " * len(SPACES)))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(batch: pd.DataFrame, text: str = "text", chars: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """A batch in runs of rows of about so many characters, which bounds what a task holds at a time."""
    sizes = batch[text].str.len().fillna(0).to_numpy().astype(np.int64) + 1
    part = (np.cumsum(sizes) - sizes) // chars
    for a, b in zip(*((x := np.flatnonzero(np.diff(part, prepend=-1))), [*x[1:], len(batch)])):
        yield batch.iloc[a:b]


def streamed_groups(
    df: DataFrame, keys: Sequence[str], f: Callable[[pd.DataFrame], pd.DataFrame], schema: str, order: Sequence[str] = ()
) -> DataFrame:
    """``f`` on the rows of every key, as ``applyInPandas``, for many small groups."""

    def each(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        return pd.concat([f(rows.iloc[a:b]) for a, b in zip(first, [*first[1:], len(rows)])], ignore_index=True)

    return whole_groups(df, keys, each, schema, order)


def whole_groups(
    df: DataFrame,
    keys: Sequence[str],
    f: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame],
    schema: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """``f`` on runs of complete groups and on where each group starts.

    One Arrow stream per task instead of one per group. A task holds one group
    and one batch at a time, so the caller keeps groups bounded. Keys are not
    null.
    """
    keys = list(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            if not len(batch):
                continue
            both = batch if held is None else pd.concat([held, batch], ignore_index=True)
            first = _starts(both, keys)
            if first[-1]:
                yield f(both.iloc[: first[-1]], first[:-1])
            held = both.iloc[first[-1] :].reset_index(drop=True)
        if held is not None:
            yield f(held, np.zeros(1, np.int64))

    dealt = df.repartition(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInPandas(run, schema)


def _starts(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in keys:
        values = rows[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def joined(rows: DataFrame, small: Stored, cond: Column, how: str = "inner") -> DataFrame:
    """A join whose right side is broadcast if it was measured to be small, else shuffled."""
    return rows.join(F.broadcast(small.df) if small.nbytes <= BROADCAST_BYTES else small.df, cond, how)


def components(edges: DataFrame) -> DataFrame:
    """node -> root, the smallest node it is connected to, for the nodes of edges (a, b).

    Large-star and small-star steps in turn. Each step is an aggregate and a
    join by node, so no list of neighbours is gathered anywhere; rows with the
    same node are split by the skew join. Every round is written, which cuts
    the lineage. Rounds go on until one changes nothing; each brings nodes nearer to
    their root, so they end, after about the logarithm of the longest path.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # Stored, so that a large one is joined by two plain shuffles, which the skew join can split.
        least = store(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")), "least")
        return joined(both, least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 24))).first())

    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialise(ordered, "edges")
    before, seen = None, state(now)
    while before != seen:
        now = materialise(small_star(large_star(now)), "edges")
        before, seen = seen, state(now)
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
