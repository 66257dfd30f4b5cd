"""Many per-key features as few aggregations."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Spec:
    """One group feature: ``agg`` of column ``on`` per ``key`` columns."""

    key: tuple[str, ...]
    on: str
    agg: str
    where: str | None = None
    alias: str | None = None

    def __post_init__(self):
        key = (self.key,) if isinstance(self.key, str) else tuple(self.key)
        object.__setattr__(self, "key", key)

    def name(self, mark: str = "") -> str:
        return self.alias or f"{mark}{'_'.join(self.key)}_{self.agg}_{self.on}"

    def column(self) -> Column:
        col = F.col(self.on)
        return F.when(F.expr(self.where), col) if self.where else col


# Exact quantiles take a pass of their own (see plans.prefix).
QUANTILES = {"median": 0.5}
AGGREGATES = {
    "count": F.count,
    "mean": F.avg,
    "nunique": F.count_distinct,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
    "std": F.stddev_samp,
    "kurtosis": F.kurtosis,
    # distinct values, a missing value being one more
    "set_size": lambda c: F.count_distinct(c) + F.max(c.isNull().cast("int")),
}


def by_key(specs: Iterable[Spec]) -> dict[tuple[str, ...], list[Spec]]:
    """The specs grouped by key, each key once and each feature once."""
    groups: dict[tuple[str, ...], list[Spec]] = {}
    for spec in specs:
        rest = groups.setdefault(spec.key, [])
        if spec not in rest:
            rest.append(spec)
    return groups
