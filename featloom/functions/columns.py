"""Numeric, date and key expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, fn) -> Column:
    """``fn`` of a value computed once per row; an expression that a lambda only
    refers to would be computed again for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def clip(col: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(col.isNotNull(), F.greatest(F.least(col, F.lit(hi)), F.lit(lo)))


def log1p_positive(col: Column) -> Column:
    """log1p where positive, unchanged elsewhere."""
    return F.when(col > 0, F.log1p(col)).otherwise(col)


def powers(col: str, degrees=(2, 3)) -> list[Column]:
    return [F.pow(F.col(col), F.lit(float(d))).alias(f"{col}_pow{d}") for d in degrees]


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def clean_key(col: Column) -> Column:
    """Image code without folder suffix: the part before the first dot."""
    return F.split(col, r"\.")[0]


def binarize(col: Column, threshold: float = 0.5) -> Column:
    return (col > threshold).cast("int")


def three_class(y: Column) -> Column:
    """0 for zero, 2 for one, 1 in between."""
    return F.when(y == 0, 0).when(y == 1, 2).when(y.isNotNull(), 1)


def nearest_bin(y: Column, step: float = 0.125) -> Column:
    """Index of the closest multiple of ``step``."""
    return F.floor(y / step + 0.5).cast("int")


def argmax(arr: Column) -> Column:
    """0-based position of the first largest value."""
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def accept_class(probs: Column, min_prob: float = 0.1) -> Column:
    """Predicted class, or NULL when its probability is too low."""
    return F.when(F.array_max(probs) > min_prob, argmax(probs))


def count_above(cols: list[str], threshold: float) -> Column:
    return reduce(Column.__add__, [F.when(F.col(c) > threshold, 1).otherwise(0) for c in cols])


def date_parts(col: str) -> list[Column]:
    return [
        F.weekday(col).alias("weekday"),
        F.dayofyear(col).alias("day_of_year"),
        F.weekofyear(col).alias("iso_week"),
        F.dayofmonth(col).alias("day_of_month"),
    ]


def durations(activation: str, start: str, end: str) -> list[Column]:
    return [
        F.datediff(start, activation).alias("duration_1"),
        F.datediff(end, activation).alias("duration_2"),
        F.datediff(end, start).alias("duration_3"),
    ]


def interact(cols: list[str], sep: str = "_") -> Column:
    """Joined category; a missing part is written as 'nan', like any other value."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in cols])


def power_mean(a: Column, b: Column, wa: float, wb: float) -> Column:
    """Weighted geometric mean of two predictions."""
    return F.pow(F.pow(a, F.lit(wa)) * F.pow(b, F.lit(wb)), F.lit(1.0 / (wa + wb)))
