"""Registration of check queries and rounding shared by both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.sources.views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Sums of doubles depend on the order of addition in the last digits, so both
# sides are rounded; the nudge keeps exact halves from falling either way.
NUDGE = "1e-9"


def check(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(tables)`` as the query ``name``; ``sql`` is its counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_views(list(views), sql)
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + F.lit(float(NUDGE)), digits) for c in cols})


def R(expr: str, name: str | None = None, digits: int = 6) -> str:
    text = f"round(({expr}) + {NUDGE}, {digits})"
    return f"{text} AS {name}" if name else text


def text_date(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})
