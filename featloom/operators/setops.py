"""Unions, distinct rows, value-set comparison, top values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.operators.ordered import first_per_key, top_k
from featloom.plans.prefix import exact_quantiles


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_by(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, key, order)


def shared_values(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur in both."""
    return a.select(col).intersect(b.select(col))


def only_in(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur in ``a`` only."""
    return a.select(col).subtract(b.select(col))


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent values, smallest value first on ties."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col).limit(n)


def head_by(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_terms(topics: DataFrame, n: int) -> DataFrame:
    """Heaviest ``n`` terms of each topic; ``topics`` is (topic, term, weight)."""
    return top_k(topics, ["topic"], [F.desc("weight"), F.asc("term")], n)


def keep_above_percentile(importance: DataFrame, p: float, col: str = "importance") -> DataFrame:
    """Rows above the given percentile (0-100) of an importance table."""
    limit = exact_quantiles(importance, [], col, {"v": p / 100.0}).scalar()
    return importance.filter(F.col(col) > limit)
