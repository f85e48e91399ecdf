"""Join of near duplicates by the Jaccard similarity of their word n-grams.

MinHash banding finds candidates: a document has ``bands * rows`` minima, and
two documents meet if all rows of a band agree. The numbers are the sharpest
that reach the target recall at the threshold. Band hashes are shuffled, and
in each bucket pairs whose minima agree far too rarely for the threshold are
struck out at once. What remains links documents to candidate clusters; every
document sends its full n-gram set to its cluster, where all pairs are
verified exactly: once if the cluster is one block, else once for each block that it meets.

Documents with equal n-gram sets are one node from the start, so copies are
never paired. Buckets and clusters above a block's size are dealt out as pairs
of blocks. Tasks do not emit pairs: they count the links of each document and
return each document with the smallest one it is connected to inside the task,
so output is linear even where thousands of documents are all alike.

A text with fewer words than n is one n-gram of all its words. Words are
compared with A to Z in lower case.

Defined cases: null counts as empty; texts without words are copies of each
other and link to nothing else. Null ids are carried; a class is named by its
smallest id, null if it has none. Repeated rows are copies. An empty table
gives no rows. ``deduplicate`` carries other columns under any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, joined, pieces, streamed_groups, table, whole, whole_groups
from tidemark.llm.registry import query
from tidemark.llm.tokens import mix, window_hashes, word_hashes
from tidemark.operators.scale import attach
from tidemark.session import materialise, store

N = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 160
BLOCK = 512
BLOCK_GRAMS = 1 << 22  # n-grams of the members of a block, on average
SLACK = 6.0  # standard deviations


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows, so the fewest false candidates, with enough bands for the recall."""
    best = None
    for rows in range(1, most + 1):
        agree = threshold**rows
        bands = 1 if agree >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-agree))
        if bands * rows <= most:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding within so many hashes reaches the recall")
    return best


def shingles(texts, n: int = N) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    h, bounds = word_hashes(texts, lower=True)
    grams, out = window_hashes(h, n, n), []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(window_hashes(h[a:b], int(b - a), int(b - a)) if b > a else grams[:0])
    return out


def _minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """n minima for each set that is not empty."""
    rng = np.random.Generator(np.random.PCG64(7919))
    factors, masks = rng.integers(0, 1 << 64, (2, n), dtype=np.uint64)
    out = np.empty((len(sets), n), np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (size < 1 << 16 or end == at):
            size += len(sets[end])
            end += 1
        x = np.concatenate(sets[at:end])
        first = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        y = np.empty_like(x)
        for i in range(n):
            np.bitwise_xor(x, masks[i], out=y)
            np.multiply(y, factors[i] | np.uint64(1), out=y)
            out[at:end, i] = np.minimum.reduceat(y, first)
        at = end
    return out


_SKETCH = "id bigint, no_id boolean, text_key bigint, digest binary, grams bigint, signature binary, bands array<bigint>"


def _sketches(n: int, bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (p for b in batches for p in pieces(b)):
            sets = shingles(batch["text"], n)
            full = [i for i, s in enumerate(sets) if len(s)]
            signature = [b""] * len(sets)
            banded = [[]] * len(sets)
            digests = [b"\0" * 16] * len(sets)
            if full:
                least = _minima([sets[i] for i in full], bands * rows)
                small = mix(least, 3).astype(np.uint8)
                by_band = least.reshape(len(full), bands, rows)
                keys = np.zeros((len(full), bands), np.uint64)
                for r in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + by_band[:, :, r], r)
                keys = mix(keys + np.arange(bands, dtype=np.uint64), 11).view(np.int64)
                for k, i in enumerate(full):
                    signature[i], banded[i] = small[k].tobytes(), keys[k]
                    s = sets[i]
                    digests[i] = np.array([mix(s, 1).sum(), mix(s, 2).sum()], np.uint64).tobytes()
            yield pd.DataFrame(
                {
                    "id": batch["id"].to_numpy(), "no_id": batch["no_id"].to_numpy(), "text_key": batch["text_key"].to_numpy(),
                    "digest": digests, "grams": [len(s) for s in sets], "signature": signature, "bands": banded,
                }
            )

    return run


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it is connected to by the edges."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _blocks(rows: DataFrame, keys: list[str], count: str, node: str, block: int) -> DataFrame:
    """Adds side and the block pair (low, high): all pairs of a large group meet once, block by block."""
    blocks = F.ceil(F.col(count) / block).cast("int")
    mine = F.pmod(F.xxhash64(node), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    return rows.withColumn("side", mine).withColumn("_other", other).withColumns(
        {"low": F.least("side", "_other"), "high": F.greatest("side", "_other")}
    ).drop("_other")


def _bucket_links(least: float):
    """Links between rows of a bucket whose minima agree often enough."""

    def run(rows: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        digests, node = np.unique(rows["digest"].to_numpy(), return_inverse=True)
        minima = np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(rows), -1)
        side, low, high = (rows[c].to_numpy() for c in ("side", "low", "high"))
        sizes = np.diff(np.append(first, len(rows)))
        ends = np.repeat(first + sizes, sizes)
        a_all, b_all = [], []
        for step in range(1, int(sizes.max())):  # rows against the step-th row after them
            a = np.arange(len(rows) - step)
            a = a[a + step < ends[: len(a)]]
            b = a + step
            # A pair inside one block belongs to that block alone.
            own = (low[a] == high[a]) | (side[a] != side[b])
            a, b = a[own], b[own]
            alike = (minima[a] == minima[b]).mean(axis=1) >= least
            a_all.append(node[a[alike]])
            b_all.append(node[b[alike]])
        a, b = (np.concatenate(x) if x else np.zeros(0, int) for x in (a_all, b_all))
        label = _labels(len(digests), a, b)
        moved = np.flatnonzero(label != np.arange(len(digests)))
        return pd.DataFrame({"a": digests[moved], "b": digests[label[moved]]})

    return run


def _verified(threshold: float):
    """Exact similarity of all pairs of a block pair: links of each row, and the root it is connected to."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("digest")
        sets = [np.frombuffer(s, np.uint64) for s in rows["grams"]]
        sizes = np.array([len(s) for s in sets])
        m = len(sets)
        common = np.zeros((m, m), np.float32)
        _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(m), sizes)
        shared = seen[column] > 1
        owner, column = owner[shared], column[shared]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
        width = max(1, (1 << 22) // max(m, 1))
        for start in range(0, (int(column[-1]) + 1) if len(column) else 0, width):
            a, b = np.searchsorted(column, [start, start + width])
            part = np.zeros((m, width), np.float32)
            part[owner[a:b], column[a:b] - start] = 1
            common += part @ part.T
        linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
        np.fill_diagonal(linked, False)
        side = rows["side"].to_numpy()
        if rows["low"].iloc[0] != rows["high"].iloc[0]:
            linked &= side[:, None] != side[None, :]
        a, b = np.nonzero(linked)
        label = _labels(m, a, b)
        digests = rows["digest"].to_numpy()
        # The smallest digest stands for its group, so that roots agree between tasks where they can.
        return pd.DataFrame({"digest": digests, "links": linked.sum(axis=1).astype(np.int64), "root": digests[label]})

    return run


def _grams(n: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (p for b in batches for p in pieces(b)):
            sets = shingles(batch["text"], n)
            yield pd.DataFrame({"digest": batch["digest"].to_numpy(), "grams": [s.tobytes() for s in sets]})

    return run


def classes(
    docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """id, class_id, n_links, copies of every row.

    ``class_id``: the smallest id among all documents connected by links.
    ``n_links``: documents with another n-gram set and a similarity of at
    least ``threshold``, copies of one set counted once. ``copies``: documents
    with the same n-gram set, this one included.
    """
    bands, rows = bands_and_rows(threshold, recall)
    flat = docs.select(F.col(f"`{id}`").cast("long").alias("id"), whole(F.col(f"`{text}`")).alias("text"))
    keyed = flat.withColumn("text_key", F.xxhash64("text"))
    asked = keyed.select(F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.col("id").isNull().alias("no_id"), "text_key", "text")
    sketch = materialise(asked.mapInPandas(_sketches(n, bands, rows), _SKETCH), "sketches")

    first = F.min(F.struct("no_id", "id", "text_key"))
    nodes = materialise(
        sketch.groupBy("digest").agg(
            F.count(F.lit(1)).alias("copies"), first.alias("first"), F.max("signature").alias("signature"), F.max("grams").alias("size")
        ),
        "nodes",
    )

    banded = sketch.select("digest", F.explode("bands").alias("band")).distinct()
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = banded.join(shared, "band").join(nodes.select("digest", "signature"), "digest")
    spread = math.sqrt(threshold * (1 - threshold) / (bands * rows))
    dealt = _blocks(buckets, ["band"], "n", "digest", 4 * BLOCK)
    candidates = whole_groups(
        dealt, ["band", "low", "high"], _bucket_links(threshold - SLACK * spread), "a binary, b binary"
    )
    clusters = materialise(components(candidates), "clusters")
    placed = materialise(
        clusters.join(nodes, clusters["node"] == nodes["digest"]).select(
            "digest", F.col("root").alias("cluster"), "size",
            F.col("first.text_key").alias("key"), F.when(~F.col("first.no_id"), F.col("first.id")).alias("of"),
        ),
        "placed",
    )
    # Clusters of long texts count as more members, so that a block is bounded in n-grams as well.
    weight = F.greatest(F.count(F.lit(1)), F.ceil(F.sum("size") / F.lit(BLOCK_GRAMS / BLOCK))).alias("n")
    members = store(placed.drop("size").join(placed.groupBy("cluster").agg(weight), "cluster"), "members")
    texts = joined(keyed, members, (F.col("text_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("of"))).select("digest", "text")
    grams = texts.mapInPandas(_grams(n), "digest binary, grams binary")
    sent = joined(grams.alias("g"), members, F.col("g.digest") == members.df["digest"]).select("g.digest", "grams", "cluster", "n")
    verified = materialise(
        streamed_groups(
            _blocks(sent, ["cluster"], "n", "digest", BLOCK), ["cluster", "low", "high"], _verified(threshold),
            "digest binary, links bigint, root binary", order=["digest"],
        ),
        "links",
    )

    links = verified.groupBy("digest").agg(F.sum("links").alias("n_links"))
    roots = components(verified.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    named = nodes.join(links, "digest", "left").join(roots.withColumnRenamed("node", "digest"), "digest", "left").select(
        "digest", "copies", F.coalesce("root", "digest").alias("root"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(~F.col("first.no_id"), F.col("first.id")).alias("least"),
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("class_id"))
    found = store(
        named.join(smallest, "root").select("digest", "class_id", "n_links", "copies", F.col("copies").alias("n")), "classes"
    )
    mine = sketch.select(F.when(~F.col("no_id"), F.col("id")).alias("id"), "text_key", "digest")
    return attach(mine, found, ["digest"], "n")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One document of each class, the one with the smallest id, with its own columns."""
    found = classes(docs, id, text, **how)
    # A class is named by an id; classes without any id are named by their n-grams.
    stays = store(
        found.filter(F.col("id").eqNullSafe(F.col("class_id")))
        .groupBy(F.col("id").alias("_id"), F.when(F.col("id").isNull(), F.col("digest")).alias("_digest"))
        .agg(F.min("text_key").alias("_key")),
        "stays",
    )
    packed = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"),
        F.col(f"`{id}`").cast("long").alias("id"),
        F.xxhash64(whole(F.col(f"`{text}`"))).alias("text_key"),
    )
    kept = joined(packed, stays, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    # Repeated rows leave one, the smallest by its other columns.
    times = kept.groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("_n"))
    again = store(times.filter("_n > 1").select(F.col("id").alias("_again"), F.col("text_key").alias("_again_key")), "again")
    cond = F.col("id").eqNullSafe(F.col("_again")) & (F.col("text_key") == F.col("_again_key"))
    repeated = joined(kept, again, cond).groupBy("id", "text_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return joined(kept, again, cond, "left_anti").select("_row").unionByName(repeated.select("_row")).select("_row.*")


@query()
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "copies")
