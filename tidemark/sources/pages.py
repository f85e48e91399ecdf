"""Sorted tables that are read page by page, and an index to search names in.

A view of millions of rows is written once, range partitioned and sorted by its
keys. A manifest has the first and last key of each range. A page starts behind
the last key of the page before; the ranges it needs follow from the manifest
and become a partition filter, so the other files are not opened.

Names are searched through trigrams. A name that contains a text contains all of the
text's trigrams, so only names that are listed under each of them are looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.scale import keep_matching
from tidemark.session import store

RANGE = "_range"
POSTING_PARTS = 64
GRAM = 3


@dataclass(frozen=True)
class Pages:
    """A table below ``path`` that is sorted by the columns ``keys``."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    @staticmethod
    def write(df: DataFrame, path: str, keys: dict[str, Column], ranges: int | None = None, lookup: Sequence[str] = ()) -> Pages:
        """Store ``df`` sorted by the expressions in ``keys``, which become columns.

        Keys ascend; a number that is to descend is negated. They should tell rows apart, as a page goes on behind
        its last key. ``lookup`` columns get a bloom filter.
        """
        spark = df.sparkSession
        ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        sorted_rows = df.withColumns(keys).repartitionByRange(ranges, *keys).withColumn(RANGE, F.spark_partition_id())
        writer = sorted_rows.sortWithinPartitions(RANGE, *keys).write.mode("overwrite").partitionBy(RANGE)
        for c in lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(f"{path}/rows")
        key = F.struct(*keys)
        # One row per range, from its key columns alone.
        manifest = spark.read.parquet(f"{path}/rows").groupBy(RANGE).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
        manifest.write.mode("overwrite").parquet(f"{path}/manifest")
        return Pages(spark, path, tuple(keys))

    def _behind(self, key: Column, after: Sequence | None) -> Column:
        if after is None:
            return F.lit(True)
        kinds = {f.name: f.dataType for f in self.rows().schema.fields}
        return key > F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in zip(self.keys, after)])

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def page(self, n: int, after: Sequence | None = None) -> DataFrame:
        """The ``n`` rows behind the key ``after``, in order; the first page without it."""
        manifest = self.spark.read.parquet(f"{self.path}/manifest").filter(self._behind(F.col("last"), after))
        # Every range that is left has a row, so n of them are enough.
        wanted, rows = [], 0
        for r in manifest.orderBy(RANGE).limit(n).collect():
            wanted.append(r[RANGE])
            rows += r["n"] if len(wanted) > 1 or after is None else 1
            if rows >= n:
                break
        mine = self.rows().filter(F.col(RANGE).isin(wanted) if wanted else F.lit(False))
        return mine.filter(self._behind(F.struct(*self.keys), after)).orderBy(*self.keys).limit(n).drop(RANGE)


def _part(gram: str) -> int:
    return zlib.crc32(gram.encode()) % POSTING_PARTS


@dataclass(frozen=True)
class NameIndex:
    """Trigram postings of the lower-case names below ``path``."""

    spark: SparkSession
    path: str

    @staticmethod
    def write(df: DataFrame, path: str, name: str = "name") -> NameIndex:
        """Index the distinct names of ``df`` with the number of their rows."""
        names = df.filter(F.col(name).isNotNull()).groupBy(F.lower(F.col(name)).alias("name")).agg(F.count(F.lit(1)).alias("n"))
        names.write.mode("overwrite").parquet(f"{path}/names")
        stored = df.sparkSession.read.parquet(f"{path}/names")
        starts = F.sequence(F.lit(1), F.length("name") - (GRAM - 1))
        grams = F.when(F.length("name") >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring("name", i, F.lit(GRAM)))))
        postings = stored.select(F.explode(grams).alias("gram"), "name", "n").withColumn("part", (F.crc32(F.col("gram").cast("binary")) % POSTING_PARTS).cast("int"))
        # Sorted by trigram, so that files and row groups of other trigrams are passed over.
        dealt = postings.repartitionByRange("part", "gram", "name").sortWithinPartitions("part", "gram", "name")
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
        return NameIndex(df.sparkSession, path)

    def names(self, text: str) -> DataFrame:
        """The lower-case names that contain the text, in any case, with their rows."""
        spark = self.spark
        low = spark.range(1).select(F.lower(F.lit(text)).alias("t")).first()["t"]
        holds = F.contains(F.col("name"), F.lit(low))
        grams = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
        if not grams:  # too short for a trigram
            return spark.read.parquet(f"{self.path}/names").filter(holds)
        postings = spark.read.parquet(f"{self.path}/postings")
        listed = postings.filter(F.col("part").isin(sorted({_part(g) for g in grams})) & F.col("gram").isin(grams))
        every = listed.groupBy("name").agg(F.count(F.lit(1)).alias("grams"), F.max("n").alias("n"))
        return every.filter((F.col("grams") == len(grams)) & holds).select("name", "n")

    def search(self, df: DataFrame, text: str, name: str = "name") -> DataFrame:
        """The rows whose names contain the text."""
        found = store(self.names(text).withColumnRenamed("name", "_low"), "found")
        return keep_matching(df.withColumn("_low", F.lower(F.col(name))), found, ["_low"], "n").drop("_low")
