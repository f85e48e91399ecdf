"""Best-fit packing under conflicts.

Documents are packed into bins of ``capacity`` words. A bin may not hold two
documents of one duplicate cluster, nor more than ``PER_SOURCE`` documents of
one source. Bins are ordered by what is left in them. Each carries bitmaps of
its sources (one for "at least once", one for "full") and of its clusters.
A document goes, largest first, to the successor of its size in that order;
where the bitmaps say no, the search goes on to the next tightest bin, until
one is compatible or a new bin is opened.

A document longer than the capacity is cut: its full pieces are bins of their
own, the rest is packed. All words of all documents are packed.

Documents are dealt to shards by a hash, a bounded number to each, and every
shard packs its own bins: only ids, sizes, sources and clusters travel, never
texts. A source or cluster with a third of all documents is spread evenly over
the shards. Bits are numbered inside a shard, so every source and cluster has
a bit of its own and no compatible bin is passed over.

Defined cases: null or empty texts have size 0 and take a place in a bin
without filling it; null sources are one source; a null cluster conflicts with
nothing; repeated rows are documents of their own (and, with the same text, of
one cluster); an empty table gives no rows; other columns are left out, under any
name. Results depend neither on the order of the input nor on settings of
the session.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, n_words, streamed_groups, table, whole
from tidemark.llm.registry import query
from tidemark.session import store

CAPACITY = 2048
PER_SOURCE = 2
SHARD_ROWS = 4096
_PLACED = "shard int, id bigint, turn bigint, piece int, first_word bigint, n_words bigint, bin int, filled bigint, source string, cluster bigint"


class Bins:
    """Open bins of a shard, ordered by residual."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.sources: list[list[int]] = []  # per bin, bitmaps of sources seen once, twice ...
        self.clusters: list[int] = []
        self.filled: list[int] = []

    def close(self, size: int) -> int:
        """A bin for one full piece; nothing else fits."""
        self.sources.append([])
        self.clusters.append(0)
        self.filled.append(size)
        return len(self.filled) - 1

    def place(self, size: int, source: int, cluster: int) -> int:
        """``source`` and ``cluster`` are bits; cluster 0 conflicts with nothing."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            left, b = self.order[at]
            if not self.clusters[b] & cluster and not self.sources[b][-1] & source:
                del self.order[at]
                break
            at += 1
        else:
            b, left = len(self.filled), self.capacity
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
            self.filled.append(0)
        for i, seen in enumerate(self.sources[b]):
            if not seen & source:
                self.sources[b][i] = seen | source
                break
        self.clusters[b] |= cluster
        self.filled[b] += size
        insort(self.order, (left - size, b))
        return b


def pack_shard(items: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Where every piece of the items of one shard goes."""
    items = items.sort_values(["size", "id", "source", "cluster", "turn"], ascending=[False, True, True, True, True])
    bins, out = Bins(capacity, per_source), []
    # Only a cluster with two members here can conflict; the others need no bit.
    shared = set(items["cluster"][items["cluster"].duplicated()].dropna())
    numbers: dict[str, dict] = {"source": {}, "cluster": {}}

    def number(kind: str, value) -> int:
        return 1 << numbers[kind].setdefault(value, len(numbers[kind]))

    for shard, id, size, source, cluster, turn in items[["shard", "id", "size", "source", "cluster", "turn"]].itertuples(index=False):
        size, full = int(size), int(size) // capacity
        for piece in range(full):
            out.append((shard, id, turn, piece, piece * capacity, capacity, bins.close(capacity), source, cluster))
        rest = size - full * capacity
        if rest or not full:
            c = number("cluster", cluster) if cluster in shared else 0
            b = bins.place(rest, number("source", source if isinstance(source, str) else None), c)
            out.append((shard, id, turn, full, full * capacity, rest, b, source, cluster))
    placed = pd.DataFrame(out, columns=["shard", "id", "turn", "piece", "first_word", "n_words", "bin", "source", "cluster"])
    placed["filled"] = [bins.filled[b] for b in placed["bin"]]
    return placed[[c.split()[0] for c in _PLACED.split(", ")]]


def cluster_of(text: Column) -> Column:
    """Copies of a text, A to Z in lower case, are one cluster."""
    return F.xxhash64(ascii_lower(whole(text)))


def pack(
    docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS,
    id: str = "doc_id", text: str = "text", source: str = "source", cluster: Column | None = None,
) -> DataFrame:
    """One row per piece: where it starts in its document, its bin and how full the bin is.

    A bin is (shard, bin). ``cluster`` is a 64-bit key of duplicate clusters.
    """
    t = F.col(f"`{text}`")
    items = docs.select(
        F.col(f"`{id}`").cast("long").alias("id"),
        n_words(t).alias("size"),
        F.col(f"`{source}`").cast("string").alias("source"),
        (cluster_of(t) if cluster is None else cluster).alias("cluster"),
    )
    stored = store(items, "items")
    # From the rows alone, so that bins do not depend on how a session is set up.
    shards = max(1, -(-stored.rows // shard_rows))
    # Repeated rows differ in ``turn``, so that they are spread as well.
    many = stored.df.groupBy("id", "size", "source", "cluster").agg(F.count(F.lit(1)).alias("n"))
    turns = many.select("id", "size", "source", "cluster", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("turn"))
    key = F.xxhash64("id", "size", "source", "cluster", "turn")
    # 64-bit columns with nulls would lose digits in pandas: null ids have a negative turn there.
    dealt = turns.select(
        F.pmod(key, F.lit(shards)).cast("int").alias("shard"),
        F.coalesce("id", F.lit(0).cast("long")).alias("id"),
        "size",
        "source",
        F.coalesce("cluster", key).alias("cluster"),
        F.when(F.col("id").isNull(), -F.col("turn")).otherwise(F.col("turn")).alias("turn"),
    )
    placed = streamed_groups(dealt, ["shard"], lambda rows: pack_shard(rows, capacity, per_source), _PLACED)
    return placed.withColumns({"id": F.when(F.col("turn") > 0, F.col("id")), "turn": F.abs("turn")})


def fill(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """How well the bins are filled: n_bins, n_words, n_full (bins without room) and fill, the share of all room that is used."""
    bins = placed.groupBy("shard", "bin").agg(F.max("filled").alias("filled"))
    return bins.agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("filled").alias("n_words"), F.count_if(F.col("filled") == capacity).alias("n_full"),
        F.try_divide(F.sum("filled").cast("double"), F.count(F.lit(1)) * capacity).alias("fill"),
    )


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return placed.withColumnRenamed("id", "doc_id")
