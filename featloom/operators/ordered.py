"""Running features in a stated order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.plans.prefix import running_sums


def occurrence_number(df: DataFrame, key: str, order: list[str], blocks: int | None = None) -> DataFrame:
    """0-based renewal counter per key in ``order``, and whether it is above 0."""
    rows = running_sums(df, [key], order, {"renewed_count": F.lit(1)}, include_current=True, blocks=blocks)
    rows = rows.withColumn("renewed_count", (F.col("renewed_count") - 1).cast("int"))
    return rows.withColumn("is_renewed", (F.col("renewed_count") > 0).cast("int"))


def running_distinct_ratio(
    df: DataFrame, key: str, cols: list[str], order: list[str], blocks: int | None = None
) -> DataFrame:
    """Distinct values so far / rows so far per key, a missing value being a value.

    The first row of every (key, value) is found by an aggregate of the order
    columns; those mark their rows through the (unique) order.
    """
    sums = {"__rows": F.lit(1)}
    for i, c in enumerate(cols):
        firsts = df.groupBy(key, c).agg(F.min(F.struct(*order)).alias("__o"))
        places = {key: F.col(key), **{o: F.col("__o")[o] for o in order}}
        marks = firsts.select(*[e.alias(f"__at_{c}") for c, e in places.items()], F.lit(1).alias(f"__new{i}"))
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__at_{c}")) for c in places])
        df = df.join(marks, same, "left").drop(*[f"__at_{c}" for c in places])
        sums[f"__seen{i}"] = F.coalesce(F.col(f"__new{i}"), F.lit(0))
    rows = running_sums(df, [key], order, sums, blocks=blocks)
    out = {f"{c}_types_ratio": F.try_divide(F.col(f"__seen{i}"), F.col("__rows")) for i, c in enumerate(cols)}
    helper = [f"__new{i}" for i in range(len(cols))] + list(sums)
    return rows.withColumns(out).drop(*helper)


def running_mean(df: DataFrame, col: str, order: list[str], keys: list[str] = (), blocks: int | None = None) -> DataFrame:
    """Mean of the non-negative values up to and including the row."""
    valid = F.when(F.col(col) >= 0, F.col(col))
    sums = {"__s": valid, "__c": valid.isNotNull().cast("int")}
    rows = running_sums(df, list(keys), order, sums, blocks=blocks)
    return rows.withColumn(f"avg_{col}", F.try_divide("__s", "__c")).drop("__s", "__c")


def running_date_mean(df: DataFrame, date_col: str, col: str) -> DataFrame:
    """The same by date: non-negative values of all dates up to each date."""
    valid = F.when(F.col(col) >= 0, F.col(col))
    daily = df.groupBy(date_col).agg(F.sum(valid).alias("s"), F.count(valid).alias("c"))
    rows = running_sums(daily, [], [date_col], {"__s": F.col("s"), "__c": F.col("c")})
    return rows.select(date_col, F.try_divide("__s", "__c").alias(f"avg_{col}"))


def first_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """First row of each key in ``order`` (an aggregate, so partial results combine)."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    lead = F.struct(*order)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), lead).alias("__r"))
    return picked.select(*keys, "__r.*").select(*df.columns)


def top_k(df: DataFrame, group: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows of each group.  Spark limits each group before the shuffle
    (WindowGroupLimit), so a large group sends at most k rows per input task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def row_positions(df: DataFrame, order: list[str], name: str = "row_id", blocks: int | None = None) -> DataFrame:
    """Global 0-based position in ``order``."""
    rows = running_sums(df, [], order, {name: F.lit(1)}, blocks=blocks)
    return rows.withColumn(name, F.col(name) - 1)


