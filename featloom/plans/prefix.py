"""Running totals and ranks whose work is spread even inside one large key.

A window over a key puts all of its rows in one task.  Here the order is cut
into blocks: a window runs inside (key, block), the block totals are summed
per key, and the two are added.  A task sees one block of one key, or the
block totals of one key (at most a few thousand rows).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.plans.selection import values_at
from featloom.plans.sizing import block_count, cut_lineage


def sortable(df: DataFrame, name: str) -> Column:
    """A double that never decreases when the column increases."""
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def add_block(df: DataFrame, order: list[str], blocks: int, name: str = "__block") -> DataFrame:
    """Block number that follows ``order``: the range of all order columns the row falls in.

    A value that fills several ranges by itself is cut by the next order column, and
    strings are compared whole.  The rows are written to the shared folder, so that
    later uses see the same ranges.
    """
    return cut_lineage(df.repartitionByRange(blocks, *order).withColumn(name, F.spark_partition_id().cast("long")))


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, Column],
    include_current: bool = True,
    blocks: int | None = None,
) -> DataFrame:
    """Add, per key and in ``order`` (ascending, must be total), the running sum
    of every expression in ``sums``; ``blocks`` defaults to the shuffle partitions."""
    last = 0 if include_current else -1
    rows = add_block(df, order, blocks or block_count(df))
    inside = Window.partitionBy(*keys, "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, last)
    totals = rows.groupBy(*keys, "__block").agg(*[F.sum(e).alias(f"__t_{n}") for n, e in sums.items()])
    part = [F.col(k) for k in keys] or [F.lit(0)]
    before = Window.partitionBy(*part).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.col("__block").alias("__cb"),
        *[F.sum(f"__t_{n}").over(before).alias(f"__c_{n}") for n in sums],
    )
    rows = rows.select("*", *[F.sum(e).over(inside).alias(f"__i_{n}") for n, e in sums.items()])
    cond = reduce(
        Column.__and__,
        [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys],
        F.col("__block") == F.col("__cb"),
    )
    joined = rows.join(carry, cond, "left")

    def both(n: str) -> Column:
        inner, outer = F.col(f"__i_{n}"), F.col(f"__c_{n}")
        return F.when(inner.isNull(), outer).when(outer.isNull(), inner).otherwise(inner + outer).alias(n)

    return joined.select(*df.columns, *[both(n) for n in sums])


def _ranked_values(df: DataFrame, keys: list[str], col: str, blocks: int | None) -> DataFrame:
    """(keys, value, first rank, last rank, group size) of the non-NULL values.

    Values are counted per (key, value) first; ranks come from running counts.
    """
    counted = (
        df.filter(F.col(col).isNotNull())
        .groupBy(*keys, F.col(col).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    ranked = running_sums(counted, keys, ["__v"], {"__cum": F.col("__n")}, blocks=blocks)
    sizes = counted.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    renamed = sizes.select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__size")
    cond = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys])
    ranked = ranked.join(renamed, cond)
    return ranked.select(
        *keys, "__v", (F.col("__cum") - F.col("__n")).alias("__lo"), (F.col("__cum") - 1).alias("__hi"), "__size"
    )


def quantile_rows(
    df: DataFrame, keys: list[str], col: str, probs: list[float], blocks: int | None = None
) -> DataFrame:
    """(keys, i, value): the interpolated quantile ``probs[i]`` (rank p*(n-1)) per key."""
    if not keys:
        found = values_at(df, probs={col: probs})[col]
        known = [(i, v) for i, v in enumerate(found) if v is not None]
        return df.sparkSession.createDataFrame(known, "i int, value double")
    ranked = _ranked_values(df, keys, col, blocks)
    ranks = F.transform(
        F.array(*[F.lit(float(p)) for p in probs]), lambda p, i: F.struct(i.alias("i"), (p * (F.col("__size") - 1)).alias("r"))
    )

    def covers(r: Column) -> Column:
        return (F.col("__lo") <= r) & (r <= F.col("__hi"))

    hits = F.filter(ranks, lambda t: covers(F.floor(t["r"])) | covers(F.ceil(t["r"])))
    near = ranked.select(*keys, "__v", "__lo", "__hi", F.explode(hits).alias("t"))
    below, above = F.floor(F.col("t.r")), F.ceil(F.col("t.r"))
    ends = near.groupBy(*keys, F.col("t.i").alias("i")).agg(
        F.max(F.when(covers(below), F.col("__v"))).alias("vb"),
        F.max(F.when(covers(above), F.col("__v"))).alias("va"),
        F.max(F.col("t.r") - below).alias("frac"),
    )
    return ends.select(*keys, "i", (F.col("vb") + (F.col("va") - F.col("vb")) * F.col("frac")).alias("value"))


def exact_quantiles(
    df: DataFrame, keys: list[str], col: str, probs: dict[str, float], blocks: int | None = None
) -> DataFrame:
    """The same with one column per named quantile; NULL values are skipped."""
    rows = quantile_rows(df, keys, col, list(probs.values()), blocks)
    return rows.groupBy(*keys).agg(
        *[F.max(F.when(F.col("i") == i, F.col("value"))).alias(name) for i, name in enumerate(probs)]
    )


def sorted_codes(values: DataFrame, col: str, name: str, blocks: int | None = None) -> DataFrame:
    """0-based position of each (distinct) value in sorted order."""
    return running_sums(values, [], [col], {name: F.lit(1)}, blocks=blocks).withColumn(
        name, (F.col(name) - 1).cast("int")
    )
