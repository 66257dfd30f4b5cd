"""Keyed left joins that keep their balance when one key owns much of the table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.plans.sizing import cut_lineage

# A key with more than 1/HEAVY_PARTS of the rows is among the HEAVY_PARTS
# largest keys, so a broadcast of that many feature rows covers all of them.
HEAVY_PARTS = 1000


def largest_keys(df: DataFrame, on: list[str], parts: int | None = None) -> DataFrame:
    """The ``parts`` keys with most rows."""
    sizes = df.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.orderBy(F.col("__n").desc()).limit(parts or HEAVY_PARTS).drop("__n")


def _same_type(df: DataFrame, other: DataFrame, name: str) -> Column:
    """The column in a form that hashes alike on both sides if the values are equal."""
    mine, theirs = df.schema[name].dataType, other.schema[name].dataType
    col = F.col(name)
    if mine != theirs:
        both_numbers = isinstance(mine, T.NumericType) and isinstance(theirs, T.NumericType)
        return col.cast("double") + 0.0 if both_numbers else col.cast("string")
    return col + 0.0 if isinstance(mine, (T.FloatType, T.DoubleType)) else col  # -0.0 equals 0.0


def _split_hot(df: DataFrame, feats: DataFrame, on: list[str], weight: str | None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``feats`` with a key, and those among them of the HEAVY_PARTS largest keys."""
    table = feats.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in on]))
    if weight:
        # true for every row, and keeps the count in both uses of the table, so that Spark aggregates it once
        table = table.where(F.col(weight) > 0)
        return table, table.orderBy(F.col(weight).desc(), *on).limit(HEAVY_PARTS)
    return table, table.join(F.broadcast(largest_keys(df, on)), on, "left_semi")


def keyed_left_join(df: DataFrame, feats: DataFrame, on: list[str], weight: str | None = None) -> DataFrame:
    """Left join of ``feats`` (one row per key) on ``on``; one plan for all sizes.

    The HEAVY_PARTS largest keys take their values from a broadcast of that many
    rows.  All other rows meet in a shuffled join on the keys and a hash of them;
    rows that need nobody there, because they have their values or a NULL key, carry
    a hash of the whole row instead and so are dealt evenly over all partitions.
    ``weight`` names a column of ``feats`` with the rows per key, which saves
    counting them; it is not part of the result.
    """
    values = [c for c in feats.columns if c not in on and c != weight]
    table, hot = _split_hot(df, feats, on, weight)
    hot = hot.select(*on, F.struct(*values).alias("__hot"))
    rows = df.join(F.broadcast(hot), on, "left")
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in on])
    alone = F.col("__hot").isNotNull() | any_null
    keys = F.xxhash64(*[_same_type(df, feats, k) for k in on])
    rows = rows.withColumn("__meet", F.when(alone, F.xxhash64(*df.columns)).otherwise(keys))
    rest = table.select(*on, *values).withColumn("__meet", F.xxhash64(*[_same_type(feats, df, k) for k in on]))
    joined = rows.join(rest, [*on, "__meet"], "left")
    picked = [
        F.when(F.col("__hot").isNotNull(), F.col("__hot").getField(v)).otherwise(F.col(v)).alias(v)
        for v in values
    ]
    return joined.select(*df.columns, *picked)


@dataclass(frozen=True)
class Side:
    """Features of one key: a row for each value of ``on``; ``weight`` as in ``keyed_left_join``."""

    feats: DataFrame
    on: list[str]
    weight: str | None = None

    @property
    def values(self) -> list[str]:
        return [c for c in self.feats.columns if c not in self.on and c != self.weight]

    def numeric(self) -> bool:
        return all(isinstance(self.feats.schema[v].dataType, NARROW) for v in self.values)


# whole numbers travel as longs, others as doubles
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NARROW = (*WHOLE, T.FloatType, T.DoubleType)


def keyed_left_joins(df: DataFrame, sides: list[Side]) -> DataFrame:
    """``keyed_left_join`` with many feature tables at once, without a shuffle of whole rows for each.

    The rows are written once and numbered.  Values of the HEAVY_PARTS largest keys of
    each table are broadcast; what they leave open travels as (row, table, hash of the
    key), meets all tables in one shuffle and comes back by row number.  So exchanges do
    not grow with the tables, and a table whose keys are all broadcast adds no row
    to them.  Keys are compared by 128 bits of hash.  Tables with other than number
    values are joined one by one.
    """
    narrow = [s for s in sides if s.numeric()]
    if len(narrow) < 2:
        for s in sides:
            df = keyed_left_join(df, s.feats, s.on, s.weight)
        return df
    rows = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    base, needs, packs = rows, [], []

    def key(side: Side, mine: DataFrame, other: DataFrame, k: int) -> list[Column]:
        parts = [_same_type(mine, other, c) for c in side.on]
        return [F.lit(k).alias("k"), F.xxhash64(F.lit(1), *parts).alias("h1"), F.xxhash64(*parts, F.lit(2)).alias("h2")]

    for k, side in enumerate(narrow):
        table, hot = _split_hot(base, side.feats, side.on, side.weight)
        rows = rows.join(F.broadcast(hot.select(*side.on, F.struct(*side.values).alias(f"__hot{k}"))), side.on, "left")
        known = reduce(Column.__and__, [F.col(c).isNotNull() for c in side.on])
        needs.append(F.when(F.col(f"__hot{k}").isNull() & known, F.struct(*key(side, base, side.feats, k))))
        whole = [F.col(v).cast("long") for v in side.values if isinstance(side.feats.schema[v].dataType, WHOLE)]
        other = [F.col(v).cast("double") for v in side.values if not isinstance(side.feats.schema[v].dataType, WHOLE)]
        arrays = [F.array(*x).cast(f"array<{t}>").alias(n) for x, t, n in ((whole, "long", "w"), (other, "double", "d"))]
        packs.append(table.select(*key(side, side.feats, base, k), *arrays))
    asks = rows.select("__row", F.explode(F.array_compact(F.array(*needs))).alias("n")).select("__row", "n.*")
    met = asks.join(reduce(DataFrame.unionByName, packs), ["k", "h1", "h2"])
    each = met.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct("w", "d")))).alias("__m"))
    rows = rows.join(each, "__row", "left")
    picked = {}
    for k, side in enumerate(narrow):
        mine, place = F.col("__m")[F.lit(k)], {"w": 0, "d": 0}
        for v in side.values:
            kind = side.feats.schema[v].dataType
            part = "w" if isinstance(kind, WHOLE) else "d"
            far = F.get(mine[part], F.lit(place[part])).cast(kind)
            place[part] += 1
            picked[v] = F.when(F.col(f"__hot{k}").isNotNull(), F.col(f"__hot{k}").getField(v)).otherwise(far).alias(v)
    out = rows.select(*df.columns, *picked.values())
    for side in sides:
        if not side.numeric():
            out = keyed_left_join(out, side.feats, side.on, side.weight)
    return out.select(*df.columns, *[v for side in sides for v in side.values])
