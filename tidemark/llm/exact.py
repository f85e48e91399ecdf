"""Exact dedup over a sharded index of cuckoo filters.

A text is reduced to the SHA-256 digest of its normalised form. Digests are
dealt to shards by a hash. A shard holds a cuckoo filter (16-bit
fingerprints, four to a bucket) and, bucket by bucket, the full digests that
are live. A digest that the filter does not know is new. A hit is verified
against the digests of its bucket; only an equal digest is a copy, anything
else is a false positive and inserted. When an insertion finds no free place,
the filter doubles and is filled again from the stored digests. Deletion takes
a count off a digest and removes it, with its fingerprint, at zero.

Copies are summed per task before they are dealt out, so a text that fills a
third of the table sends one row per task. A shard gets a bounded number of
digests: an index that has outgrown its shards deals the stored digests out to
more of them and fills their filters again.

Ids are longs with a flag for null on all paths; a column with nulls would pass
through pandas as floats, which do not hold every long.

Defined cases: null text counts as empty, so empty and null texts are copies.
Texts of any length travel as digests only. A null id is smaller than any other. Repeated rows (same id and text) are
copies of each other: all have ``kept``, and ``deduplicate`` leaves one, the
smallest by its other columns. An empty table gives no rows. Other columns are
carried by ``deduplicate`` under any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, partitions, table, whole
from tidemark.llm.registry import query
from tidemark.operators.scale import attach
from tidemark.session import Stored, materialise, store

SLOTS = 4
KICKS = 200
SHARD_ROWS = 200_000
_STATE = "shard int, digest binary, keep_id bigint, no_id boolean, n bigint, buckets int, fingerprints binary"


class CuckooFilter:
    """Fingerprints of digests in two possible buckets each."""

    def __init__(self, buckets: int, table: bytes | None = None) -> None:
        self.buckets = buckets  # a power of two
        n = buckets * SLOTS
        self.table = np.frombuffer(table, np.uint16).tolist() if table else [0] * n
        self.turn = 0

    def place(self, digest: bytes) -> tuple[int, int, int]:
        fingerprint = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[10:18], "big") & (self.buckets - 1)
        return fingerprint, first, self.other(first, fingerprint)

    def other(self, bucket: int, fingerprint: int) -> int:
        return bucket ^ (fingerprint * 0x5BD1E995 & (self.buckets - 1))

    def __contains__(self, digest: bytes) -> bool:
        f, a, b = self.place(digest)
        return f in self.table[a * SLOTS : a * SLOTS + SLOTS] or f in self.table[b * SLOTS : b * SLOTS + SLOTS]

    def _put(self, bucket: int, fingerprint: int) -> bool:
        for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.table[i]:
                self.table[i] = fingerprint
                return True
        return False

    def add(self, digest: bytes) -> bool:
        """False if the filter is full; it must then be rebuilt, as a fingerprint has lost its place."""
        f, a, b = self.place(digest)
        if self._put(a, f) or self._put(b, f):
            return True
        bucket = b
        for _ in range(KICKS):
            self.turn += 1
            i = bucket * SLOTS + self.turn % SLOTS
            f, self.table[i] = self.table[i], f
            bucket = self.other(bucket, f)
            if self._put(bucket, f):
                return True
        return False

    def remove(self, digest: bytes) -> None:
        f, a, b = self.place(digest)
        for bucket in (a, b):
            for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.table[i] == f:
                    self.table[i] = 0
                    return

    def packed(self) -> bytes:
        return np.array(self.table, np.uint16).tobytes()


class Shard:
    """A filter and the live digests behind it, bucket by bucket."""

    def __init__(self, buckets: int = 16, fingerprints: bytes | None = None) -> None:
        self.filter = CuckooFilter(buckets, fingerprints)
        self.content: dict[int, dict[bytes, list]] = {}

    def bucket(self, digest: bytes) -> dict[bytes, list]:
        return self.content.setdefault(self.filter.place(digest)[1], {})

    def find(self, digest: bytes) -> list | None:
        """The entry of a live digest: a hit of the filter, verified in its bucket."""
        return self.bucket(digest).get(digest) if digest in self.filter else None

    def insert(self, digest: bytes, keep: int | None, n: int) -> None:
        entry = self.find(digest)
        if entry is not None:
            entry[0] = keep if entry[0] is None else entry[0] if keep is None else max(entry[0], keep)
            entry[1] += n
            return
        self.bucket(digest)[digest] = [keep, n]
        if not self.filter.add(digest):
            self.resize()

    def delete(self, digest: bytes, n: int) -> None:
        entry = self.find(digest)
        if entry is None:
            return
        entry[1] -= n
        if entry[1] <= 0:
            del self.bucket(digest)[digest]
            self.filter.remove(digest)

    def resize(self) -> None:
        """Double the filter until all stored digests fit."""
        live = {d: e for b in self.content.values() for d, e in b.items()}
        buckets = self.filter.buckets * 2
        while True:
            self.filter, self.content = CuckooFilter(buckets), {}
            if all(self.filter.add(d) for d in live):
                break
            buckets *= 2
        for d, e in live.items():
            self.bucket(d)[d] = e

    def rows(self, shard: int) -> pd.DataFrame:
        """The live digests, and one row without a digest for the filter."""
        live = [(d, e[0], e[1]) for b in self.content.values() for d, e in b.items()]
        return pd.DataFrame(
            {
                "shard": shard,
                "digest": [d for d, _, _ in live] + [None],
                "keep_id": np.array([k or 0 for _, k, _ in live] + [0], np.int64),
                "no_id": [k is None for _, k, _ in live] + [True],
                "n": np.array([n for _, _, n in live] + [0], np.int64),
                "buckets": np.array([0] * len(live) + [self.filter.buckets], np.int32),
                "fingerprints": [None] * len(live) + [self.filter.packed()],
            }
        )


def _entries(rows: pd.DataFrame) -> list[tuple[bytes, int | None, int]]:
    ids = [None if no else int(k) for k, no in zip(rows["keep_id"], rows["no_id"])]
    return list(zip(rows["digest"], ids, rows["n"].astype(int)))


def _load(shard_rows: pd.DataFrame) -> Shard:
    """A shard as it was stored; without a stored filter, one that is filled from the digests."""
    head = shard_rows[shard_rows["digest"].isna()]
    live = _entries(shard_rows[shard_rows["digest"].notna()])
    if len(head):
        shard = Shard(int(head["buckets"].iloc[0]), head["fingerprints"].iloc[0])
        for d, k, n in live:
            shard.bucket(d)[d] = [k, n]
    else:
        shard = Shard()
        for d, k, n in live:
            shard.insert(d, k, n)
    return shard


def _updated(insert: bool):
    def run(old: pd.DataFrame, batch: pd.DataFrame) -> pd.DataFrame:
        shard = _load(old)
        for d, k, n in _entries(batch):
            if insert:
                shard.insert(d, k, n)
            else:
                shard.delete(d, n)
        return shard.rows(int((old if len(old) else batch)["shard"].iloc[0]))

    return run


@dataclass(frozen=True)
class DigestIndex:
    """Live digests with the largest id seen and the number of copies, in shards.

    ``state`` is a stored table; every update writes a new one, so a lost
    executor costs a re-read and an earlier version stays usable.
    """

    state: DataFrame
    shards: int

    @staticmethod
    def empty(spark: SparkSession, rows: int) -> DigestIndex:
        """An index for about so many digests; with more it grows."""
        return DigestIndex(spark.createDataFrame([], _STATE), DigestIndex._shards(spark, rows))

    @staticmethod
    def _shards(spark: SparkSession, rows: int) -> int:
        return max(2 * partitions(spark), -(-rows // SHARD_ROWS))

    def _dealt(self, batch: DataFrame) -> DataFrame:
        """One row per digest, summed in each task before the shuffle."""
        number = F.col("id").cast("long")
        summed = batch.groupBy("digest").agg(F.max(number).alias("most"), F.count(F.lit(1)).alias("n"))
        return summed.select(
            self._shard(), "digest", F.coalesce("most", F.lit(0).cast("long")).alias("keep_id"),
            F.col("most").isNull().alias("no_id"), "n",
        )

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def _update(self, batch: DataFrame, insert: bool) -> DigestIndex:
        """``batch`` has digest (32 bytes) and id."""
        both = self.state.groupBy("shard").cogroup(self._dealt(batch).groupBy("shard"))
        stored = store(both.applyInPandas(_updated(insert), _STATE), "digests")
        return DigestIndex(stored.df, self.shards)._grown(stored.rows)

    def _grown(self, rows: int) -> DigestIndex:
        """The same digests in more shards, if these have become too large."""
        if rows <= 2 * self.shards * SHARD_ROWS:
            return self
        wider = DigestIndex(self.state, self._shards(self.state.sparkSession, rows))
        live = self.state.filter(F.col("digest").isNotNull()).withColumn("shard", wider._shard())
        # Without their filters: a shard fills a new one from its digests.
        return DigestIndex(materialise(live.select(self.state.columns), "digests"), wider.shards)

    def insert(self, batch: DataFrame) -> DigestIndex:
        return self._update(batch, True)

    def delete(self, batch: DataFrame) -> DigestIndex:
        """Take each row of the batch off its digest; ``keep_id`` stays while copies are live."""
        return self._update(batch, False)

    def live(self) -> DataFrame:
        """digest, keep_id, n of every live digest."""
        keep = F.when(~F.col("no_id"), F.col("keep_id")).alias("keep_id")
        return self.state.filter(F.col("digest").isNotNull()).select("digest", keep, "n")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(ascii_lower(whole(text)), "UTF-8"), 256))


def _groups(digests: Stored) -> Stored:
    """Digests with copies: digest, keep_id, group_size, and n as their weight."""
    index = DigestIndex.empty(digests.df.sparkSession, digests.rows).insert(digests.df)
    return store(index.live().filter("n > 1").withColumn("group_size", F.col("n")), "copies")


def copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """digest, id, keep_id, group_size and kept of every row."""
    seen = store(docs.select(F.col(f"`{id}`").cast("long").alias("id"), digest(F.col(f"`{text}`")).alias("digest")), "sha")
    # A digest without copies needs no partner.
    alone = F.col("group_size").isNull()
    return (
        attach(seen.df, _groups(seen), ["digest"], "n")
        .select(
            "digest",
            "id",
            F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(alone, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"),
        )
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the largest id of each group of copies, with its own columns."""
    flat = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"),
        F.col(f"`{id}`").cast("long").alias("id"),
        digest(F.col(f"`{text}`")).alias("digest"),
    )
    seen = store(flat.select("id", "digest"), "sha")
    marked = attach(flat, _groups(seen), ["digest"], "n")
    alone = marked.filter(F.col("group_size").isNull()).select("_row")
    # Only rows with the id that stays; several if that id repeats.
    stays = marked.filter(F.col("group_size").isNotNull() & F.col("id").eqNullSafe(F.col("keep_id")))
    one = stays.groupBy("digest").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return alone.unionByName(one).select("_row.*")


@query(
    """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY h)
SELECT t.doc_id, g.keep_id, g.n AS group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, h AS text_sha256
FROM t JOIN g USING (h)"""
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
