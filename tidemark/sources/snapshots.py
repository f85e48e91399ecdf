"""Reading snapshot folders.

Layout: one folder per period, in it one per sheet, in it one file or one folder
of files per subject (``<sheet>/<subject>.csv`` or ``<sheet>/<subject>/*.csv``,
also ``subject=<subject>``). All files of a sheet share a header. Formats are
those Spark reads in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import snake_case, table_name
from tidemark.operators.filters import with_valid_names
from tidemark.operators.shape import clean_headers, map_headers, snake

KEYS = ("subject", "sheet_type", "period")
SOURCE = "source_file"
FORMATS = ("csv", "json", "parquet", "orc")
# What became of a record, why, and its text in the file.
OUTCOME, REASON, RAW = "_outcome", "_reason", "_raw"
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class NothingExtracted(ValueError):
    """No folder, file or row to work on."""


def read_sheet(
    spark: SparkSession, path: str, fmt: str = "csv", schema: str | T.StructType | None = None, multiline: bool = True
) -> DataFrame | None:
    """The rows of all files of one sheet with their subject, or None if there are no files.

    Records that cannot be read are left out; ``read_checked`` has them.
    """
    checked = read_checked(spark, path, fmt, schema, multiline)
    return None if checked is None else kept_rows(checked)


def read_checked(
    spark: SparkSession, path: str, fmt: str = "csv", schema: str | T.StructType | None = None, multiline: bool = True
) -> DataFrame | None:
    """All records of one sheet, with what became of each, or None if there are no files.

    The subject is the name below the sheet folder, without extension. Temporary
    files (``~...``) are skipped. Without a schema, CSV columns are text, which takes
    the header line only and no pass over the data; JSON columns are found by one,
    which a schema saves.

    ``outcome`` is ``good``, ``repaired`` (surplus fields, all of them blank, were
    cut) or ``rejected``, ``reason`` says why, and ``raw`` is the record as it
    stands in the file. With ``multiline`` quoted fields may hold line
    breaks, and a CSV file is read by one task; without it, a record that is broken over
    lines is rejected line by line.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format: {fmt}")
    reader = spark.read.format(fmt).options(pathGlobFilter=f"[!~]*.{fmt}", recursiveFileLookup=True)
    if fmt in ("csv", "json"):
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
    if fmt == "csv":
        # A file with another header is an error, not silently shifted columns.
        reader = reader.options(header=True, enforceSchema=False, multiLine=multiline)
    if fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    if fmt == "json":
        reader = reader.option("primitivesAsString", True)
    try:
        if schema is None and fmt == "csv":
            schema = T.StructType([T.StructField(c, T.StringType()) for c in reader.load(path).columns if c != RAW])
        if schema is not None:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            noted = [T.StructField(RAW, T.StringType())] if fmt in ("csv", "json") else []
            reader = reader.schema(T.StructType([*schema.fields, *noted]))
        df = reader.load(path)
    except AnalysisException as e:
        if any(c in (e.getCondition() or "") for c in _NOTHING_THERE):
            return None
        raise
    names = [c for c in df.columns if c != RAW]
    file = F.col("_metadata.file_path")
    placed = df.select(_subject(file, path).alias("subject"), decoded(file).alias(SOURCE), *[F.col(f"`{c}`") for c in df.columns])
    if RAW in df.columns and names:
        # Spark reads the text of a record only beside one of its fields; this always holds and needs one.
        placed = placed.withColumn(RAW, F.when(F.hash(F.col(f"`{names[0]}`")) <= F.lit((1 << 31) - 1), F.col(RAW)))
    if fmt == "csv":
        placed = _mended(placed, schema)
    else:
        bad = F.col(RAW).isNotNull() if RAW in df.columns else F.lit(False)
        raw = F.col(RAW) if RAW in df.columns else F.lit(None).cast("string")
        placed = placed.withColumns(
            {OUTCOME: F.when(bad, "rejected").otherwise("good"), REASON: F.when(bad, "unreadable"), RAW: raw}
        )
    return clean_headers(placed.select("subject", SOURCE, OUTCOME, REASON, RAW, *[F.col(f"`{c}`") for c in names]))


def _mended(df: DataFrame, schema: T.StructType) -> DataFrame:
    """CSV records with their outcome; those with blank surplus fields are read again without them."""
    raw = F.col(RAW)
    separators = lambda c: F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))
    unquoted = F.regexp_replace(raw, r'"(?:[^"\\]|\\.|"")*"', "")
    surplus = separators(unquoted) + 1 - F.lit(len(schema.fields))
    blank = F.regexp_extract(raw, r"((?:,[ \t]*)+)$", 1)
    shorter = F.concat(F.left(raw, F.length(raw) - F.length(blank)), F.repeat(F.lit(","), (separators(blank) - surplus).cast("int")))
    again = ", ".join("`{}` {}".format(n.replace("`", "``"), t) for n, t in [*((f.name, f.dataType.simpleString()) for f in schema.fields), (RAW, "string")])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    mended = F.from_csv(F.when(raw.isNotNull() & (surplus > 0) & (separators(blank) >= surplus), shorter), again, options)
    parsed = df.withColumn("_mended", mended)
    repaired = F.col("_mended").isNotNull() & F.col("_mended")[RAW].isNull()
    values = {f.name: F.when(repaired, F.col("_mended")[f.name]).otherwise(F.col(f"`{f.name}`")) for f in schema.fields}
    reason = F.when(surplus > 0, "surplus fields").when(surplus < 0, "missing fields").otherwise("unreadable")
    return parsed.withColumns(
        {
            OUTCOME: F.when(raw.isNull(), "good").when(repaired, "repaired").otherwise("rejected"),
            REASON: F.when(raw.isNotNull(), reason),
            **values,
        }
    ).drop("_mended")


def kept_rows(checked: DataFrame) -> DataFrame:
    """The good and the repaired rows."""
    return checked.filter(F.col(OUTCOME) != "rejected").drop(OUTCOME, REASON, RAW)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Subject, file, reason and text of each record that was left out."""
    return checked.filter(F.col(OUTCOME) == "rejected").select("subject", SOURCE, REASON, RAW)


def file_outcomes(checked: DataFrame) -> DataFrame:
    """Good, repaired and rejected records of each file."""
    return checked.groupBy("subject", SOURCE).agg(*[F.count_if(F.col(OUTCOME) == o).alias(o) for o in ("good", "repaired", "rejected")])


def read_rejects(
    spark: SparkSession, folders: dict[str, str], sheets: Sequence[str], fmt: str = "csv",
    source_schema: str | T.StructType | None = None, multiline: bool = True,
) -> DataFrame:
    """What was left out of every sheet of every period."""
    parts = []
    for period, folder in folders.items():
        for sheet in sheets:
            checked = read_checked(spark, f"{folder}/{sheet}", fmt, source_schema, multiline)
            if checked is not None:
                named = {"subject": snake_case(F.col("subject")), "sheet_type": F.lit(snake(sheet)), "period": F.lit(snake(period))}
                parts.append(rejected_rows(checked).withColumns(named))
    if not parts:
        raise NothingExtracted(f"no {fmt} files for sheets {list(sheets)}")
    return union_all(parts)


def decoded(path: Column) -> Column:
    """A file path as text; a plus sign is not an encoded blank here."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _subject(file_path: Column, sheet_path: str) -> Column:
    sheet = sheet_path.rstrip("/").rsplit("/", 1)[-1]
    below = F.substring_index(decoded(file_path), f"/{sheet}/", -1)
    folder = F.regexp_replace(F.substring_index(below, "/", 1), "^subject=", "")
    return F.when(F.contains(below, F.lit("/")), folder).otherwise(F.regexp_replace(below, r"\.[^.]*$", ""))


def read_period(
    spark: SparkSession,
    folder: str,
    period: str,
    sheets: Sequence[str],
    mapping: dict[str, str],
    schema: str | T.StructType,
    fmt: str = "csv",
    name: str = "name",
    source_schema: str | T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """The configured sheets of one period, on canonical columns.

    Rows without a valid name are dropped, as are records that cannot be read
    (``read_rejects`` has these). Values keep their source type.
    """
    parts = []
    for sheet in sheets:
        raw = read_sheet(spark, f"{folder}/{sheet}", fmt, source_schema, multiline)
        if raw is None:
            continue
        mapped = map_headers(raw, mapping, schema, keep=("subject", SOURCE))
        parts.append(
            with_valid_names(mapped, name).withColumns(
                {
                    "subject": snake_case(F.col("subject")),
                    "sheet_type": F.lit(snake(sheet)),
                    "period": F.lit(snake(period)),
                }
            )
        )
    if not parts:
        raise NothingExtracted(f"no {fmt} files for sheets {list(sheets)} in {folder}")
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_periods(spark: SparkSession, folders: dict[str, str], *args, **kwargs) -> DataFrame:
    """Both periods as one frame; ``folders`` maps a period to its folder."""
    return union_all([read_period(spark, folder, period, *args, **kwargs) for period, folder in folders.items()])


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise NothingExtracted("no rows were extracted")
    return df


def extraction_metadata(df: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Rows, source files (the first, and how many) and table name of each extracted snapshot.

    A snapshot without rows is not listed.
    """
    found = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(SOURCE).alias(SOURCE) if SOURCE in df.columns else F.lit(None).cast("string").alias(SOURCE),
        F.count_distinct(SOURCE).alias("source_files") if SOURCE in df.columns else F.lit(0).cast("bigint").alias("source_files"),
    )
    return found.withColumn("table_name", table_name(F.col("subject"), F.col("period"), F.col("sheet_type")))
