"""Labels derived from numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fence factor of the interquartile range and severity bounds.
IQR_FACTOR = 1.5
SEVERITY = (("Extreme", 3.0), ("High", 2.0), ("Moderate", 1.5))
# Total score bounds of entities found in several fields.
SCORE_BANDS = (("Cross-Field", 1.0), ("Near Cross-Field", 0.85), ("Approaching Cross-Field", 0.70))
# Growth bounds in percent.
GROWTH = (("High Growth", 30), ("Growing", 15), ("Expanding", 5), ("Moderate", 0), ("Declining", -10))
# Fixed value: absolute change from which on a change is a major one.
MAJOR_CHANGE = 5


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """0 where there is no value or no spread."""
    return F.when((std > 0) & value.isNotNull(), (value - mean) / std).otherwise(F.lit(0.0))


def outside_fences(value: Column, q1: Column, q3: Column) -> Column:
    margin = IQR_FACTOR * (q3 - q1)
    return (value < q1 - margin) | (value > q3 + margin)


def outlier_flag(value: Column, z: Column, q1: Column, q3: Column, threshold: float = 3.0) -> Column:
    by_z = F.abs(z) > threshold
    by_iqr = outside_fences(value, q1, q3)
    return (
        F.when(value.isNull(), "None")
        .when(by_z & by_iqr, "IQR, Z-Score")
        .when(by_z, "Z-Score")
        .when(by_iqr, "IQR")
        .otherwise("None")
    )


def outlier_severity(zs: Sequence[Column], flags: Sequence[Column]) -> Column:
    """The band of the largest absolute z of a flagged row."""
    flagged = reduce(or_, [f != "None" for f in flags])
    out = F.when(~flagged, "Normal")
    for label, bound in SEVERITY:
        out = out.when(reduce(or_, [F.abs(z) >= bound for z in zs]), label)
    return out.otherwise("Low")


def cross_field_category(field_count: Column, total_score: Column) -> Column:
    out = F.when(field_count <= 1, "Single Field")
    for label, bound in SCORE_BANDS:
        out = out.when(total_score >= bound, label)
    return out.otherwise("Multidisciplinary")


def category_key(category: Column) -> Column:
    """Filter value of a category: ``Near Cross-Field`` to ``nearcrossfield``."""
    return F.lower(F.regexp_replace(category, "[ -]", ""))


def score_band(total_score: Column, label: str) -> Column:
    """True when the score lies in the half-open band of ``label``."""
    bounds = [b for _, b in SCORE_BANDS]
    i = [name for name, _ in SCORE_BANDS].index(label)
    inside = total_score >= bounds[i]
    return inside if i == 0 else inside & (total_score < bounds[i - 1])


def growth_status(growth: Column) -> Column:
    label, bound = GROWTH[0]
    out = F.when(growth >= bound, label)
    for label, bound in GROWTH[1:]:
        out = out.when(growth >= bound, label)
    return out.otherwise("Major Decline")


def change_sign(delta: Column) -> Column:
    return F.when(delta > 0, "positive").when(delta < 0, "negative").otherwise("neutral")


def change_class(delta: Column, wanted: str) -> Column:
    """Filter test for ``increase``, ``decrease``, ``major`` or ``all``."""
    tests = {
        "all": F.lit(True),
        "increase": delta > 0,
        "decrease": delta < 0,
        "major": F.abs(delta) >= MAJOR_CHANGE,
    }
    if wanted not in tests:
        raise ValueError(f"unknown change class: {wanted}")
    return tests[wanted]
