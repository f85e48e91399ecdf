"""The table store: partitioned tables in the session catalog.

A table that is replaced is staged first: written under a name and in a folder of
its own and checked there. Only then does the catalog entry move, by renaming,
which touches no data. So a load that fails leaves the rows there were, and a
load may read the tables it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import is_blank
from tidemark.operators.contents import snapshot_contents
from tidemark.operators.rules import count_violations
from tidemark.operators.scale import first_rows
from tidemark.operators.shape import column_difference, enforced

PARTITIONS = ("sheet_type", "period", "subject")
# Tables on their way in and out; no table of a user begins so.
_STAGED, _FORMER = "_staged__", "_former__"


class LoadFailed(RuntimeError):
    """Nothing was loaded, or fewer rows than were sent."""


@dataclass(frozen=True)
class Loaded:
    """What a load stored, and what it left out and why.

    ``counted`` holds the counters that were asked for, by table.
    """

    tables: list[str]
    failures: dict[str, str]
    rows_in: int
    rows_stored: int
    counted: dict[str, dict[str, int]] = field(default_factory=dict)


class Store:
    """Snapshots of one database, one table per schema, with one writer at a time.

    ``location`` is a folder all executors reach; without it the session's
    warehouse is used.
    """

    def __init__(self, spark: SparkSession, database: str = "tidemark", location: str | None = None):
        self.spark = spark
        self.database = database
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
        self.recover()

    def _full(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    # -- writing ----------------------------------------------------------

    def create(
        self,
        df: DataFrame,
        table: str,
        if_exists: str = "replace",
        partitions: Sequence[str] = (),
        buckets: int = 0,
        bucket_by: Sequence[str] = ("name",),
    ) -> int:
        """Create a table from a frame; returns the number of rows written.

        Rows are rebalanced by the partition columns first: adaptive execution
        splits a heavy partition over several tasks and files and merges light
        ones, so their number follows the size of the data. With ``buckets``
        the rows of a key in ``bucket_by`` lie together, so that joins and
        aggregates by it need no shuffle.
        """
        if if_exists not in ("replace", "append", "fail"):
            raise ValueError(f"unknown mode: {if_exists}")
        if if_exists == "fail" and self.exists(table):
            raise LoadFailed(f"table {table} exists")
        if if_exists == "append" and self.exists(table):
            return self._write(df, table, partitions, 0, (), "append", None)
        staged = f"{_STAGED}{table}__{uuid.uuid4().hex}"
        n = self._stage(df, staged, partitions, buckets, bucket_by)
        self._switch(staged, table)
        return n

    def _write(self, df, table, partitions, buckets, bucket_by, mode, path) -> int:
        seen = Observation()
        if buckets:
            df = df.repartition(buckets, *bucket_by)
        elif partitions:
            df = df.hint("rebalance", *partitions)
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).format("parquet")
        if partitions:
            writer = writer.partitionBy(*partitions)
        if buckets:
            writer = writer.bucketBy(buckets, *bucket_by)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(self._full(table))
        return seen.get["n"]

    def _stage(self, df, staged, partitions, buckets=0, bucket_by=()) -> int:
        """Write a table beside the others; what is left of one that fails goes."""
        root = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        try:
            return self._write(df, staged, partitions, buckets, bucket_by, "errorifexists", f"{root}/{staged}")
        except BaseException:
            self._remove(staged, f"{root}/{staged}")
            raise

    def _switch(self, staged: str, table: str) -> None:
        """Give the staged table its name; the former one goes afterwards."""
        former = f"{_FORMER}{table}"
        if self.exists(table):
            self._rename(table, former)
        self._rename(staged, table)
        if self.exists(former):
            self._remove(former)

    def _rename(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._full(old)} RENAME TO {self._full(new)}")
        self.spark.catalog.refreshTable(self._full(new))

    def recover(self) -> None:
        """Finish a switch that was broken off: a former table gets its name back unless the new one has it."""
        for t in self._names():
            if t.startswith(_FORMER):
                table = t.removeprefix(_FORMER)
                if self.exists(table):
                    self._remove(t)
                else:
                    self._rename(t, table)

    def _remove(self, table: str, path: str | None = None) -> None:
        """Drop a table; its files go with it if this store wrote them, into a folder of their own."""
        root = self.spark.catalog.getDatabase(self.database).locationUri.rstrip("/")
        if self.exists(table):
            place = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._full(table)}").filter("col_name = 'Location'").first()
            path = path or (place["data_type"] if place else None)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._full(table)}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path or root)
        own = folder.getName().startswith(_STAGED) and folder.getParent().toUri().getPath() == self.spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath()
        if own:
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def insert(self, df: DataFrame, table: str) -> None:
        """Append by position, as the table's columns are ordered."""
        if not self.exists(table):
            raise LoadFailed(f"table {table} does not exist")
        df.write.insertInto(self._full(table))

    def load(
        self,
        df: DataFrame,
        schemas: dict[str, str | T.StructType],
        schema_of: dict[str, str] | None = None,
        default_schema: str | None = None,
        clear: bool = True,
        counters: dict[str, Column] | None = None,
        buckets: int = 0,
    ) -> Loaded:
        """Load a consolidated frame: one table per schema, all staged, then switched.

        ``schema_of`` maps a sheet type to a schema name, ``default_schema``
        serves the others and rows without a sheet type. A table that fails is
        named with the reason and keeps the rows it had; if none is loaded the call
        fails and nothing has changed. With ``clear`` tables that are no schema go. Each
        table is written in one pass, in which its rows and the aggregates in
        ``counters`` are counted before they are cast; what was stored is checked against that.
        """
        schema_of = schema_of or {}
        default_schema = default_schema or next(iter(schemas))
        target = F.lit(default_schema)
        for sheet, name in schema_of.items():
            target = F.when(F.col("sheet_type") == sheet, F.lit(name)).otherwise(target)
        measures = {"_rows": F.count(F.lit(1)), **(counters or {})}
        staged, failures, counted = {}, {}, {}
        rows_in = 0
        for name, schema in schemas.items():
            mine = df if not schema_of and name == default_schema else df.filter(target == name)
            seen = Observation()
            place = f"{_STAGED}{name}__{uuid.uuid4().hex}"
            try:
                taken = mine.observe(seen, *[m.alias(n) for n, m in measures.items()])
                stored = self._stage(enforced(taken, schema, keep=PARTITIONS), place, PARTITIONS, buckets, ("name",))
                counted[name] = seen.get
                expected = counted[name].pop("_rows")
                rows_in += expected
                if not expected or stored != expected or self.count(place) != expected:
                    self._remove(place)
                    raise LoadFailed(f"{expected} rows expected, {stored} stored" if expected else "no rows to load")
                staged[name] = place
            except (PySparkException, LoadFailed, ValueError) as e:
                failures[name] = str(e)
                if name not in counted:
                    rows_in += mine.count()
        if not staged:
            raise LoadFailed("; ".join(f"{n}: {e}" for n, e in failures.items()))
        total = sum(self.count(place) for place in staged.values())
        for name, place in staged.items():
            self._switch(place, name)
        if clear:
            for t in set(self.tables()) - set(schemas):
                self.drop(t)
        return Loaded(list(staged), failures, rows_in, total, {n: c for n, c in counted.items() if n in staged and counters})

    def drop(self, table: str, if_exists: bool = True) -> None:
        if not if_exists and not self.exists(table):
            raise LoadFailed(f"table {table} does not exist")
        self._remove(table)

    def clear(self) -> None:
        for t in self.tables():
            self.drop(t)

    # -- reading ----------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._full(table))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def tables(self) -> list[str]:
        return [t for t in self._names() if not t.startswith((_STAGED, _FORMER))]

    def _names(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def schema(self, table: str) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.read(table).schema.fields}

    def count(self, table: str) -> int:
        return self.read(table).count()

    def sample(self, table: str, n: int = 5) -> DataFrame:
        return self.read(table).limit(n)

    def sample_values(self, table: str, column: str, n: int = 3) -> DataFrame:
        return self.read(table).select(column).filter(F.col(column).isNotNull()).limit(n)

    def sample_per_snapshot(self, table: str, order_by: Sequence[str], n: int = 3) -> DataFrame:
        return first_rows(self.read(table), PARTITIONS, order_by, n)

    def sql(self, text: str, args: Sequence | dict | None = None) -> DataFrame:
        """Ad hoc SQL over the stored tables, with ``?`` or named parameters."""
        self.spark.catalog.setCurrentDatabase(self.database)
        return self.spark.sql(text, args=list(args) if isinstance(args, tuple) else args)

    def export(self, text: str, path: str, args: Sequence | dict | None = None) -> None:
        """Write the result of a query as CSV with a header; null is ``NULL``."""
        self.sql(text, args).write.mode("overwrite").option("header", True).option("nullValue", "NULL").csv(path)

    # -- checking ---------------------------------------------------------

    def profile(self, table: str, by: Sequence[str] = PARTITIONS) -> DataFrame:
        """Rows and columns of every snapshot in a table."""
        df = self.read(table)
        columns = [c for c in df.columns if c not in by]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count")).withColumns(
            {"column_count": F.lit(len(columns)), "columns": F.lit(",".join(columns))}
        )

    def summary(self) -> DataFrame:
        """One row per table: rows and columns."""
        parts = []
        for t in self.tables():
            df = self.read(t)
            parts.append(
                df.agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(t).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
                )
            )
        if not parts:
            return self.spark.createDataFrame([], "table_name STRING, row_count BIGINT, column_count INT")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def contents(self, table: str, by: Sequence[str] = PARTITIONS) -> DataFrame:
        """Rows and content hash of every snapshot in a table."""
        return snapshot_contents(self.read(table), by)

    def reconcile(self, table: str, expected: DataFrame, by: Sequence[str] = PARTITIONS) -> DataFrame:
        """Expected against stored rows per snapshot, with a verdict.

        ``expected`` holds ``by`` and ``row_count``, and may hold ``content_hash``
        (see ``snapshot_contents``), which tells changed values where counts agree. Missing,
        unexpected and empty snapshots, wrong counts and wrong contents are told apart.
        """
        hashed = "content_hash" in expected.columns
        found = self.contents(table, by) if hashed else self.read(table).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
        names = {"row_count": "rows", **({"content_hash": "content"} if hashed else {})}
        sides = [df.select(*by, *[F.col(c).alias(f"{side}_{n}") for c, n in names.items()]) for side, df in (("expected", expected), ("stored", found))]
        # Grouped, not joined, so that snapshots with a null in their name meet as well.
        both = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(*by)
        both = both.agg(*[F.max(f"{side}_{n}").alias(f"{side}_{n}") for n in names.values() for side in ("expected", "stored")])
        verdict = (
            F.when(F.col("expected_rows").isNull(), "unexpected")
            .when(F.col("stored_rows").isNull(), "missing")
            .when(F.col("expected_rows") != F.col("stored_rows"), "row_count_mismatch")
        )
        if hashed:
            verdict = verdict.when(F.col("expected_content") != F.col("stored_content"), "content_mismatch")
        out = both.withColumn("verdict", verdict.otherwise("ok"))
        return out.drop("expected_content", "stored_content")

    def validate(
        self, table: str, critical: Sequence[str], name: str = "name", non_negative: Sequence[str] = ()
    ) -> DataFrame:
        """Critical columns exist, names are filled, numbers are not negative."""
        df = self.read(table)
        missing, _ = column_difference(df, critical)
        if missing:
            raise LoadFailed(f"table {table} misses critical columns: {missing}")
        predicates = {("empty_name", name): is_blank(F.col(name))}
        predicates |= {("negative", c): F.col(c) < 0 for c in non_negative}
        return count_violations(df, predicates, PARTITIONS)
