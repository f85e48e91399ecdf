"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Bytes a row of a broadcast table needs beside its values.
ROW_OVERHEAD = 32


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and NaN-safe defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, shared by all executors.

    The session names it in ``spark.checkpoint.dir``; there is no other place.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    return named.rstrip("/")


_scopes: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    folder = _scopes[-1] if _scopes else f"{scratch_dir(spark)}/tidemark"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end, when the results are written."""
    folder = f"{scratch_dir(spark)}/tidemark/scope-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield
    finally:
        _scopes.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Stored:
    """A table in the shared folder with its rows and in-memory size."""

    df: DataFrame
    rows: int
    nbytes: int


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a result must not be computed a second time with another
    physical layout, and to cut lineage so a lost executor costs one re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store(df: DataFrame, label: str = "stage") -> Stored:
    """Like ``materialise``, measuring the table while it is written."""
    seen = Observation()
    stored = materialise(df.observe(seen, *_measures(df)), label)
    return _stored(stored, seen.get)


def measure(df: DataFrame) -> Stored:
    """Measure a part of a stored table."""
    return _stored(df, df.agg(*_measures(df)).first().asDict())


def _stored(df: DataFrame, found: dict) -> Stored:
    return Stored(df, found["n"], found["n"] * ROW_OVERHEAD + (found["width"] or 0))


def _measures(df: DataFrame) -> list[Column]:
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _width(F.col(f"`{f.name}`"), f.dataType)
    return [F.count(F.lit(1)).alias("n"), F.sum(width).alias("width")]


def _width(c: Column, kind: T.DataType) -> Column:
    """Bytes of a value: text by its length, everything fixed as 8."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if isinstance(kind, T.StructType):
        total = F.lit(0).cast("long")
        for f in kind.fields:
            total = total + _width(c[f.name], f.dataType)
        return total
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(8).cast("long")
