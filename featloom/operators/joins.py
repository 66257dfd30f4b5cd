"""Keyed joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.plans.skew import keyed_left_join


def _names(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def attach(df: DataFrame, feats: DataFrame, on: str | list[str], default=None, weight: str | None = None) -> DataFrame:
    """Left join of one-row-per-key features; ``default`` fills the new columns only."""
    on = _names(on)
    joined = keyed_left_join(df, feats, on, weight)
    if default is None:
        return joined
    new = [c for c in feats.columns if c not in on and c != weight]
    return joined.withColumns({c: F.coalesce(c, F.lit(default)) for c in new})


def full_merge(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """Full outer join of two one-row-per-key tables."""
    return a.join(b, _names(on), "full")


def flag_in(df: DataFrame, col: str, other: DataFrame, name: str | None = None) -> DataFrame:
    """1 where the value occurs in ``other``, else 0."""
    name = name or f"{col}_in"
    seen = other.select(col).dropna().distinct().withColumn(name, F.lit(1))
    return attach(df, seen, col, default=0)


def keep_in(df: DataFrame, col: str, other: DataFrame, negate: bool = False) -> DataFrame:
    """Rows whose value occurs (or does not occur) in ``other``."""
    flagged = flag_in(df, col, other, "__in")
    return flagged.filter(F.col("__in") == (0 if negate else 1)).drop("__in")


def override(df: DataFrame, lookup: DataFrame, key: str, col: str) -> DataFrame:
    """Replace ``col`` where ``lookup(key, value)`` has an entry."""
    table = lookup.select(key, F.col([c for c in lookup.columns if c != key][0]).alias("__v"))
    joined = attach(df, table, key)
    return joined.withColumn(col, F.coalesce("__v", col)).drop("__v")


def lagged_group_mean(
    df: DataFrame, keys: list[str], date_col: str, y: str, days: int, name: str | None = None
) -> DataFrame:
    """Mean of ``y`` over the same keys ``days`` calendar days earlier."""
    name = name or f"{'_'.join(keys)}_{y}_shift{days}"
    daily = df.groupBy(*keys, date_col).agg(F.avg(y).alias(name), F.count(F.lit(1)).alias("__n"))
    moved = daily.withColumn(date_col, F.date_add(F.col(date_col), days))
    return keyed_left_join(df, moved, [*keys, date_col], weight="__n")


def scalar(df: DataFrame, expr: Column) -> Column:
    """One aggregate over a whole frame, as a scalar subquery."""
    return df.agg(expr.alias("v")).scalar()
