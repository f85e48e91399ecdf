"""From raw snapshots to comparable ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import canonical, category_lookup, settle_category
from tidemark.operators import duplicates, nulls, rules, shape
from tidemark.operators.scale import attach
from tidemark.operators.stats import outlier_report
from tidemark.session import store
from tidemark.sources.store import Store
from tidemark.spec import LightTransform

# Most spellings that are looked up in an expression, which tries one by one.
MAP_LIMIT = 100


def normalise_category(df: DataFrame, settings: LightTransform) -> DataFrame:
    """Canonical spellings: a small map is an expression, a large one a join."""
    c, mapping = settings.category_column, settings.canonical
    if c not in df.columns:
        return df
    how = settings.unknown_category, settings.default_category
    if len(mapping) <= MAP_LIMIT:
        return df.withColumn(c, canonical(F.col(c), mapping, *how))
    rows = [(k, v, 1) for k, v in mapping.items()]
    spellings = store(df.sparkSession.createDataFrame(rows, "_key string, _found string, _n bigint"), "spellings")
    found = attach(df.withColumn("_key", category_lookup(F.col(c))), spellings, ["_key"], "_n")
    return found.withColumn(c, settle_category(F.col(c), F.col("_found"), *how)).select(*df.columns)


def category_changes(df: DataFrame, settings: LightTransform, by: Sequence[str] = ()) -> DataFrame:
    """How many category values the normalisation rewrites."""
    c = settings.category_column
    old = F.coalesce("_old", F.lit(""))
    new = F.col(c)
    return normalise_category(df.withColumn("_old", F.col(c)), settings).groupBy(*by).agg(
        F.count(F.lit(1)).alias("records_processed"), F.count_if(old != new).alias("records_changed")
    )


def light_transform(df: DataFrame, settings: LightTransform, mapped: bool = False) -> DataFrame:
    """Map headers, normalise the category, flag duplicates, fill nulls.

    ``mapped`` says that the headers are canonical already. Validation is a
    report of its own, see ``validate``; with ``fail_on_violation`` it is run
    here and raises.
    """
    if not mapped:
        df = shape.map_headers(df, settings.column_mapping, settings.schema, keep=settings.by)
    df = nulls.nan_to_null(df)
    df = normalise_category(df, settings)
    df = duplicates.flag_duplicates(
        df, settings.duplicate_keys, settings.by, settings.case_sensitive, settings.fail_on_duplicates
    )
    df = nulls.handle_nulls(df, settings.null_strategy, settings.null_defaults, settings.never_null)
    if settings.fail_on_violation:
        rules.enforce(validate(df, settings))
    return df


def validate(
    df: DataFrame, settings: LightTransform, checks: Sequence[str] = rules.CHECKS
) -> DataFrame:
    """The violated checks of prepared snapshots."""
    return rules.run_checks(
        df, checks, settings.critical, settings.numeric, settings.rules, settings.duplicate_keys, settings.by
    )


def transform_counts(raw: DataFrame, prepared: DataFrame, settings: LightTransform) -> DataFrame:
    """Records, rewritten categories, duplicates and groups of each snapshot.

    ``raw`` has canonical headers and is not yet normalised.
    """
    by = list(settings.by)
    spelled = category_changes(raw, settings, by)
    flagged = prepared.groupBy(*by).agg(
        F.count_if("is_duplicate").alias("duplicates_flagged"),
        F.count_distinct(F.when(F.col("is_duplicate"), F.col("duplicate_group_id"))).alias("duplicate_groups"),
    )
    return spelled.join(flagged, by, "left").na.fill(0, ["duplicates_flagged", "duplicate_groups"])


def load_prepared(store_: Store, raw: DataFrame, settings: LightTransform, schemas: dict, **how) -> DataFrame:
    """Transform and load in one flow; the run's counters are seen in the write.

    ``raw`` has canonical headers. One row: records_processed, records_changed,
    duplicates_flagged, rows_in, rows_stored, tables and failures. Nothing is read again for it.
    """
    c = settings.category_column
    prepared = light_transform(raw.withColumn("_old", F.coalesce(F.col(c), F.lit(""))), settings, mapped=True)
    counters = {
        "records_processed": F.count(F.lit(1)),
        "records_changed": F.count_if(F.col("_old") != F.coalesce(F.col(c), F.lit(""))),
        "duplicates_flagged": F.count_if("is_duplicate"),
    }
    done = store_.load(prepared, schemas, counters=counters, **how)
    sums = {n: sum(seen[n] for seen in done.counted.values()) for n in counters}
    row = (*sums.values(), done.rows_in, done.rows_stored, len(done.tables), sorted(done.failures))
    kinds = "rows_in bigint, rows_stored bigint, tables int, failures array<string>"
    return raw.sparkSession.createDataFrame([row], ", ".join(f"{n} bigint" for n in counters) + f", {kinds}")


def clean(
    df: DataFrame,
    settings: LightTransform,
    order_by: Sequence[str],
    null_strategy: str = "fail",
) -> DataFrame:
    """Type, apply the null policy and keep the first row of each key."""
    carried = [c for c in (*settings.by, *order_by) if c in df.columns]
    fields = {f.name for f in shape.as_schema(settings.schema).fields}
    keep = [c for c in dict.fromkeys(carried) if c not in fields]
    strict = nulls.critical_nulls(df, null_strategy, settings.critical)
    typed = shape.typed(strict, settings.schema, keep)
    return duplicates.remove_duplicates(typed, settings.duplicate_keys, order_by, settings.by)


def cleaning_checks(
    df: DataFrame,
    by: Sequence[str],
    name: str,
    category: str,
    papers: str,
    cited: str,
    score: str,
    non_negative: Sequence[str],
    percents: Sequence[str] = (),
) -> DataFrame:
    """Integrity and consistency of cleaned snapshots, in one pass."""
    predicates = rules.integrity_predicates(name, category, non_negative)
    predicates |= rules.consistency_predicates(papers, cited, score, percents)
    return rules.count_violations(df, predicates, by)


def cleaning_outliers(df: DataFrame, fields: Sequence[str], by: Sequence[str]) -> DataFrame:
    return outlier_report(df, fields, by)


def cleaning_summary(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of each snapshot before and after cleaning."""
    old = before.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_before"))
    new = after.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_after"))
    both = old.join(new, list(by), "left").na.fill(0, ["rows_after"])
    return both.withColumns(
        {
            "rows_removed": F.col("rows_before") - F.col("rows_after"),
            "status": F.when(F.col("rows_after") > 0, "cleaned").otherwise("empty"),
        }
    )
