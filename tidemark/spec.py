"""Parameter objects shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Metric:
    """A compared column. Tolerance 0 means any difference is a change."""

    name: str
    tolerance: float = 0.0

    def __post_init__(self):
        if self.tolerance < 0:
            raise ValueError(f"tolerance of {self.name} is negative")


@dataclass(frozen=True)
class CompareSpec:
    """What identifies an entity and what is compared between two periods.

    ``pair_by`` names the columns that pick a snapshot pair (subject, sheet).
    ``carry`` columns travel along but are not compared.
    ``order_by`` says which row is the first one when an entity is repeated
    inside a snapshot. ``assume_unique`` promises there are no repeats, which
    saves Spark a sort.
    """

    metrics: tuple[Metric, ...]
    periods: tuple[str, str]
    entity: str = "name"
    pair_by: tuple[str, ...] = ("subject", "sheet_type")
    period: str = "period"
    carry: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    assume_unique: bool = False

    def __post_init__(self):
        if not self.metrics:
            raise ValueError("at least one metric is needed")
        if len(self.periods) != 2 or self.periods[0] == self.periods[1]:
            raise ValueError("two different periods are needed")
        names = [*self.payload, self.entity, self.period, *self.pair_by]
        repeated = {n for n in names if names.count(n) > 1}
        if repeated:
            raise ValueError(f"columns play two roles: {sorted(repeated)}")

    @property
    def metric_names(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.metrics)

    @property
    def payload(self) -> tuple[str, ...]:
        return (*self.metric_names, *self.carry)

    @property
    def keys(self) -> tuple[str, ...]:
        return (*self.pair_by, self.entity)


@dataclass(frozen=True)
class Rule:
    """Plausibility limits of one column."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    min_length: int | None = None
    required: bool = False

    def __post_init__(self):
        low, high = self.min_value, self.max_value
        if low is not None and high is not None and low > high:
            raise ValueError(f"{self.column}: minimum is above maximum")


@dataclass(frozen=True)
class LightTransform:
    """Settings of the five-step normalisation chain."""

    column_mapping: dict[str, str]
    schema: str
    category_column: str
    canonical: dict[str, str]
    duplicate_keys: tuple[str, ...]
    critical: tuple[str, ...]
    never_null: tuple[str, ...]
    null_defaults: dict[str, object] = field(default_factory=dict)
    null_strategy: str = "default"
    rules: tuple[Rule, ...] = ()
    numeric: tuple[str, ...] = ()
    unknown_category: str = "keep_original"
    default_category: str = "Unknown"
    case_sensitive: bool = False
    fail_on_duplicates: bool = False
    fail_on_violation: bool = False
    by: tuple[str, ...] = ("subject", "sheet_type", "period")
