"""From documents to packed training sequences.

quality rules -> exact dedup -> near duplicates -> source mix -> packing.

Every stage gets the rows that its predecessor wrote and returns rows with the
columns of ``documents``; the last returns where each piece is packed. Stages
work on whole tables and whole texts and take any columns besides. What each
does with nulls, empty texts, repeated rows and empty tables is stated in its
operator's module. After the mix, a document is there as often as it is taken;
its copies are one cluster, so packing puts them into different bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, mixing, near, packing, quality
from tidemark.session import materialise

# SQL cannot express the near-duplicate, mixing and packing stages.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each text stays."""
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return near.deduplicate(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its bin."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
