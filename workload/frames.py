"""Snapshot frames built from the driver tables, in Spark and in SQL.

An order is a document of a customer. Customers are the entities, order
priorities the subjects, and the orders before and from a day on the periods.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.spec import CompareSpec, Metric

PERIODS = ("p1", "p2")
# Orders before this day make the first period, all others the second.
MIDDLE = "1998-04-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _period(day: Column) -> Column:
    return F.when(day < F.lit(MIDDLE).cast("timestamp"), PERIODS[0]).otherwise(PERIODS[1])


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, subject, period, papers, hot, cited, score: unique by the first three."""
    day = F.col("o_orderdate")
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.col("o_orderpriority").alias("subject"), _period(day).alias("period"))
        .agg(
            F.count(F.lit(1)).alias("papers"),
            F.count_if(F.col("o_orderstatus") == "F").alias("hot"),
            F.sum(F.floor("o_totalprice")).alias("cited"),
        )
    )
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return per_customer.join(names, "o_custkey").select(
        "name", "subject", "period", "papers", "hot", "cited", (F.col("hot") / F.col("papers")).alias("score")
    )


SNAPSHOTS_SQL = f"""
snap AS (
  SELECT c.c_name AS name, o.o_orderpriority AS subject,
         CASE WHEN o.o_orderdate < TIMESTAMP '{MIDDLE}' THEN 'p1' ELSE 'p2' END AS period,
         count(*) AS papers,
         count(*) FILTER (WHERE o.o_orderstatus = 'F') AS hot,
         CAST(sum(CAST(floor(o.o_totalprice) AS BIGINT)) AS BIGINT) AS cited,
         CAST(count(*) FILTER (WHERE o.o_orderstatus = 'F') AS DOUBLE) / count(*) AS score
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY ALL
)"""

SPEC = CompareSpec(
    metrics=(Metric("papers"), Metric("score", 0.001), Metric("hot"), Metric("cited")),
    periods=PERIODS,
    pair_by=("subject",),
    assume_unique=True,
)
# Without the sum of prices, most repeated customers of a subject keep their
# numbers, so that every class has members.
SHORT_SPEC = CompareSpec(
    metrics=(Metric("papers"), Metric("hot")),
    periods=PERIODS,
    pair_by=("subject",),
    carry=("score", "cited"),
    assume_unique=True,
)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: customers repeat inside a snapshot."""
    day = F.col("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return orders.join(names, "o_custkey").select(
        "name",
        F.col("o_orderpriority").alias("subject"),
        _period(day).alias("period"),
        F.col("o_orderkey").alias("seq"),
        F.floor("o_totalprice").alias("price"),
    )


RAW_ORDERS_SQL = f"""
raw AS (
  SELECT c.c_name AS name, o.o_orderpriority AS subject,
         CASE WHEN o.o_orderdate < TIMESTAMP '{MIDDLE}' THEN 'p1' ELSE 'p2' END AS period,
         o.o_orderkey AS seq, CAST(floor(o.o_totalprice) AS BIGINT) AS price
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

RAW_SPEC = CompareSpec(
    metrics=(Metric("price"),),
    periods=PERIODS,
    pair_by=("subject",),
    order_by=("seq",),
)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
