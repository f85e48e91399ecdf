"""From prepared snapshots to reports and dashboards."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compare as C
from tidemark.operators import marts as M
from tidemark.operators.scale import first_rows
from tidemark.operators.stats import with_outliers
from tidemark.session import materialise
from tidemark.sources import reports
from tidemark.spec import CompareSpec


@dataclass(frozen=True)
class Comparison:
    """The results of one run; ``compared`` is stored, the rest derives from it."""

    spec: CompareSpec
    compared: DataFrame
    coverage: DataFrame
    summary: DataFrame
    duplicates: DataFrame | None
    outliers: DataFrame | None

    @property
    def only_in_1(self) -> DataFrame:
        return C.only_in(self.compared, 1, self.spec)

    @property
    def only_in_2(self) -> DataFrame:
        return C.only_in(self.compared, 2, self.spec)

    @property
    def changes(self) -> DataFrame:
        return C.changes(self.compared, self.spec)

    @property
    def unchanged(self) -> DataFrame:
        return C.unchanged(self.compared, self.spec)


def run(
    prepared: DataFrame,
    spec: CompareSpec,
    analysed: Sequence[str] = (),
    threshold: float = 3.0,
) -> Comparison:
    """Enrich, compare and summarise all complete snapshot pairs.

    ``analysed`` fields get outlier statistics per snapshot first. Duplicate
    flags are followed if the snapshots carry them.
    """
    by = (*spec.pair_by, spec.period)
    rows = C.complete_pairs(prepared, spec)
    carry = list(spec.carry)
    flagged = set(C.DUPLICATE_FLAGS) <= set(prepared.columns)
    if flagged:
        carry += [c for c in C.DUPLICATE_FLAGS if c not in carry]
    if analysed:
        rows = with_outliers(rows, analysed, by, threshold, percentiles=False)
        carry += [f"{f}_{s}" for f in analysed for s in ("z_score", "outlier_flag")]
    rows = materialise(rows, "prepared")
    wide = replace(spec, carry=tuple(carry))
    compared = materialise(C.compare(rows, wide), "compared")
    return Comparison(
        spec=spec,
        compared=compared,
        coverage=C.pair_coverage(prepared, spec),
        summary=C.summarise(compared, spec),
        duplicates=C.duplicate_change_summary(compared, rows, wide) if flagged else None,
        outliers=C.outlier_change_summary(compared, rows, wide, analysed) if analysed else None,
    )


def save(result: Comparison, root: str, date: str | None = None) -> None:
    """Write the entity lists, one document per comparison and the run."""
    reports.write_entities(result.compared, result.spec, root)
    docs = reports.documents(result.summary, result.spec, date, result.duplicates, result.outliers)
    reports.write_documents(docs, root)
    reports.write_run(reports.run_document(result.coverage, result.spec, date=date), root)


def dashboard(compared: DataFrame, summary: DataFrame, roles: M.Roles) -> dict[str, DataFrame]:
    """The frames behind each view; entries are stored, as all build on them."""
    by = roles.by
    rows = materialise(M.entries(compared, roles), "entries")
    cross = materialise(M.cross_field(rows, by), "cross")
    moved = materialise(M.unique_changes(rows, by), "changes")
    increases = materialise(M.top_changes(rows, "increase", by, changes=moved), "increases")
    leading = [F.desc("paper_change"), "name", "subject"]
    return {
        "summary": M.executive_summary(summary, by=by),
        "summary_top": first_rows(increases, by, leading, M.TOP_SUMMARY) if by else increases.orderBy(*leading).limit(M.TOP_SUMMARY),
        "entries": rows,
        "entities": M.entities(rows, by),
        "cross_field": cross,
        "cross_field_counts": M.cross_field_counts(cross, by),
        "top_increases": increases,
        "top_decreases": M.top_changes(rows, "decrease", by, changes=moved),
        "subjects": M.subject_growth(summary, by=by),
    }
