"""Comparison reports as JSON.

A report of any size is a folder: one small document per comparison with its
totals, and the entities as JSON lines, partitioned by sheet type, comparison
and section. Nested documents that hold everything in one file can be read,
but are not written: one pair may be a large share of all data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import comparison_id, dataset_type, display_subject, snake_case
from tidemark.operators.compare import CHANGED, ONLY_1, ONLY_2, UNCHANGED, UNCLASSIFIED, UNNAMED
from tidemark.sources.snapshots import decoded
from tidemark.spec import CompareSpec

# File names and field names of the report format.
PATTERN = "*_comparison_report.json"
SECTIONS = {
    ONLY_1: "researchers_only_in_dataset_1",
    ONLY_2: "researchers_only_in_dataset_2",
    CHANGED: "researcher_changes",
    UNCHANGED: "researchers_unchanged",
}
# Sections of our own, so that no entity is left out of a report.
WRITTEN = SECTIONS | {UNCLASSIFIED: "researchers_unclassified", UNNAMED: "rows_without_name"}
REQUIRED = ("comparison_id", "summary_statistics", "researcher_changes")

_VALUES = (
    "highly_cited_papers: BIGINT, indicative_cross_field_score: DOUBLE, hot_papers: BIGINT, times_cited: BIGINT"
)
_ENTITY = f"name: STRING, esi_field: STRING, {_VALUES}"
_CHANGE = (
    "name: STRING, esi_field: STRING, highly_cited_papers_change: BIGINT, cross_field_score_change: DOUBLE, "
    f"hot_papers_change: BIGINT, times_cited_change: BIGINT, feb_values: STRUCT<{_VALUES}>, "
    f"july_values: STRUCT<{_VALUES}>, percentage_changes: STRUCT<highly_cited_papers: DOUBLE, "
    "indicative_cross_field_score: DOUBLE, hot_papers: DOUBLE, times_cited: DOUBLE>"
)
# The parts of a nested report that are read.
DOCUMENT_SCHEMA = (
    "comparison_id STRING, comparison_date STRING, "
    "summary_statistics STRUCT<dataset_1_total: BIGINT, dataset_2_total: BIGINT, total_researchers_compared: BIGINT, "
    "researchers_only_in_dataset_1: BIGINT, researchers_only_in_dataset_2: BIGINT, researchers_with_changes: BIGINT, "
    "researchers_unchanged: BIGINT, match_rate: DOUBLE, change_rate: DOUBLE>, "
    f"researchers_only_in_dataset_1 ARRAY<STRUCT<{_ENTITY}>>, researchers_only_in_dataset_2 ARRAY<STRUCT<{_ENTITY}>>, "
    f"researcher_changes ARRAY<STRUCT<{_CHANGE}>>, researchers_unchanged ARRAY<STRUCT<{_ENTITY}>>, "
    "_corrupt_record STRING"
)


def _parent(path: Column) -> Column:
    return snake_case(F.regexp_extract(path, "([^/]+)/[^/]+$", 1))


def _subject(path: Column, sheet: Column) -> Column:
    stem = F.regexp_replace(F.regexp_extract(path, "([^/=]+)$", 1), r"\.json$", "")
    base = F.regexp_replace(stem, "_comparison_report$", "")
    suffix = F.concat(F.lit("_"), sheet)
    bare = F.substring(base, F.lit(1), F.length(base) - F.length(suffix))
    return F.when(F.endswith(base, suffix), bare).otherwise(base)


def read_documents(spark: SparkSession, root: str, pattern: str = PATTERN, lines: bool = False) -> DataFrame:
    """Nested reports one folder below ``root``, one row per document.

    A file holds one document. With ``lines`` it holds one per line and is read
    in parts; what the pattern names may then be a folder of such files, as
    Spark writes them, and counts as the source.
    """
    docs = (
        spark.read.schema(DOCUMENT_SCHEMA)
        .options(multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
        .json(f"{root}/*/{pattern}")
    )
    path = decoded(F.col("_metadata.file_path"))
    source = F.regexp_replace(path, r"\.json/[^/]*$", ".json") if lines else path
    with_path = docs.select("*", source.alias("source_file"))
    sheet = _parent(F.col("source_file"))
    return with_path.withColumn("sheet_type", sheet).withColumn(
        "subject", _subject(F.col("source_file"), F.col("sheet_type"))
    )


def _complete(docs: DataFrame) -> Column:
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    return ok & F.col("_corrupt_record").isNull() if "_corrupt_record" in docs.columns else ok


def valid_documents(docs: DataFrame) -> DataFrame:
    return docs.filter(_complete(docs)).drop("_corrupt_record")


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Files that are no JSON or lack a required field, with what is missing."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    return docs.filter(~_complete(docs)).select("source_file", F.array_join(missing, ",").alias("missing"))


def document_counts(docs: DataFrame) -> DataFrame:
    """Entities per report: the sizes of its four lists."""
    total = sum((F.coalesce(F.size(c), F.lit(0)) for c in list(SECTIONS.values())[1:]), F.coalesce(F.size(SECTIONS[ONLY_1]), F.lit(0)))
    kind = dataset_type(F.col("comparison_id"))
    return docs.select(
        "comparison_id", "sheet_type", "subject", kind.alias("dataset_type"),
        display_subject(F.col("comparison_id")).alias("display_subject"), total.alias("entity_count"),
    )


def document_entities(docs: DataFrame) -> DataFrame:
    """The four lists as flat rows of a comparison, ready for the marts."""

    def value(side: str, m: str) -> Column:
        return F.col(f"e.{side}_values.{m}")

    metrics = ("highly_cited_papers", "indicative_cross_field_score", "hot_papers", "times_cited")
    delta = {m: f"{m}_change" for m in metrics} | {"indicative_cross_field_score": "cross_field_score_change"}
    keys = ["comparison_id", "sheet_type", "subject"]
    parts = []
    for status, section in SECTIONS.items():
        rows = docs.select(*keys, F.explode(section).alias("e"))
        columns = [*keys, F.col("e.name").alias("name"), F.col("e.esi_field").alias("esi_field_2"), F.lit(status).alias("status")]
        for m in metrics:
            if status == CHANGED:
                first, second, change = value("feb", m), value("july", m), F.col(f"e.{delta[m]}")
            else:
                own = F.col(f"e.{m}")
                none = F.lit(None).cast("double" if "score" in m else "bigint")
                first = none if status == ONLY_2 else own
                second = none if status == ONLY_1 else own
                change = own - own if status == UNCHANGED else none
            columns += [first.alias(f"{m}_1"), second.alias(f"{m}_2"), change.alias(f"{m}_change")]
        parts.append(rows.select(*columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report_rows(compared: DataFrame, spec: CompareSpec, sheet: str = "sheet_type") -> DataFrame:
    """The classified entities with their comparison id and section."""
    section = F.lit(None).cast("string")
    for status, name in WRITTEN.items():
        section = F.when(F.col("status") == status, name).otherwise(section)
    subject = [c for c in spec.pair_by if c != sheet]
    ids = comparison_id(F.concat_ws("_", *subject), F.col(sheet)) if sheet in spec.pair_by else F.concat_ws("_", *subject)
    kind = F.col(sheet) if sheet in spec.pair_by else F.lit("general_research")
    return compared.filter(section.isNotNull()).select(
        *[c for c in compared.columns if c != sheet],
        snake_case(ids).alias("comparison_id"),
        kind.alias(sheet),
        section.alias("section"),
    )


def write_entities(compared: DataFrame, spec: CompareSpec, root: str) -> None:
    """The entity lists as JSON lines, one folder per comparison and section.

    Rebalancing splits a heavy section over several files and keeps a light
    one in one.
    """
    rows = report_rows(compared, spec)
    folders = ["sheet_type", "comparison_id", "section"]
    (
        rows.hint("rebalance", *folders)
        .write.mode("overwrite")
        .partitionBy(*folders)
        .option("ignoreNullFields", False)
        .json(f"{root}/entities")
    )


def read_entities(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The written entity lists; ``schema`` names the columns to read."""
    folders = "sheet_type STRING, comparison_id STRING, section STRING"
    return spark.read.schema(f"{schema}, {folders}").json(f"{root}/entities")


def entity_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sheet_type", "comparison_id").agg(F.count(F.lit(1)).alias("entity_count"))


def documents(
    summary: DataFrame,
    spec: CompareSpec,
    date: str | None = None,
    duplicates: DataFrame | None = None,
    outliers: DataFrame | None = None,
    sheet: str = "sheet_type",
    columns: Sequence[str] = (),
) -> DataFrame:
    """One nested document per comparison: everything but the entity lists.

    ``duplicates`` and ``outliers`` are the per-pair status summaries;
    ``columns`` are those of the compared tables.
    """
    pair = list(spec.pair_by)
    subject = [c for c in pair if c != sheet]
    has_sheet = sheet in pair
    ids = F.concat_ws("_", *subject, sheet) if has_sheet else F.concat_ws("_", *subject)
    aggregates = F.struct(*[c for m in spec.metric_names for c in (f"total_{m}_change", f"avg_{m}_change")])
    stats = F.struct(
        F.col("total_1").alias("dataset_1_total"),
        F.col("total_2").alias("dataset_2_total"),
        F.col("matched").alias("total_researchers_compared"),
        F.col("only_in_1").alias("researchers_only_in_dataset_1"),
        F.col("only_in_2").alias("researchers_only_in_dataset_2"),
        F.col("changed").alias("researchers_with_changes"),
        F.col("unchanged").alias("researchers_unchanged"),
        "match_rate",
        "change_rate",
        aggregates.alias("aggregate_changes"),
    )

    listed = list(columns) or [spec.entity, *spec.payload]

    def info(i: int) -> Column:
        parts = [F.concat_ws("_", *subject), F.lit(spec.periods[i - 1])] + ([F.col(sheet)] if has_sheet else [])
        return F.struct(
            snake_case(F.concat_ws("_", *parts)).alias("table_name"),
            F.lit(spec.periods[i - 1]).alias("period"),
            F.col(f"total_{i}").alias("row_count"),
            F.lit(len(listed)).alias("column_count"),
            F.array(*[F.lit(c) for c in listed]).cast("array<string>").alias("columns"),
        )

    out = summary
    nested = [
        snake_case(ids).alias("comparison_id"),
        (F.lit(date) if date else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).alias("comparison_date"),
        (F.col(sheet) if has_sheet else F.lit("general_research")).alias(sheet),
        info(1).alias("dataset_1_info"),
        info(2).alias("dataset_2_info"),
        stats.alias("summary_statistics"),
        F.lit(json.dumps(asdict(spec))).alias("comparison_config"),
    ]
    for label, extra in (("duplicate_analysis", duplicates), ("outlier_analysis", outliers)):
        if extra is not None:
            packed = F.struct(*[c for c in extra.columns if c not in pair]).alias(label)
            # One row per pair on both sides.
            out = out.join(extra.select(*pair, packed), pair, "left")
            nested.append(F.col(label))
    return out.select(*nested)


def write_documents(docs: DataFrame, root: str) -> None:
    docs.write.mode("overwrite").partitionBy("sheet_type").json(f"{root}/summaries")


def run_document(
    coverage: DataFrame, spec: CompareSpec, errors: Sequence[str] = (), date: str | None = None
) -> DataFrame:
    """One row about the run: comparisons made, pairs left out, settings."""
    return coverage.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.count_if("is_complete").alias("successful_comparisons"),
        F.count_if(~F.col("is_complete")).alias("incomplete_pairs"),
    ).withColumns(
        {
            "generation_date": F.lit(date) if date else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
            "dataset_1_period": F.lit(spec.periods[0]),
            "dataset_2_period": F.lit(spec.periods[1]),
            "errors": F.array(*[F.lit(e) for e in errors]).cast("array<string>"),
            "config_used": F.lit(json.dumps(asdict(spec))),
        }
    )


def write_run(run: DataFrame, root: str) -> None:
    run.write.mode("overwrite").json(f"{root}/comparison_summary")
