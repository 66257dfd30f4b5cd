"""Exact quantiles of whole columns by narrowing histograms; no row is shuffled or sorted.

Each pass counts the values inside a few intervals in cells of equal width; tasks count,
and only counts with the smallest and largest value of a cell travel.  The cells that hold
a wanted rank are the intervals of the next pass, until each holds a single value.  All
columns and all ranks share the passes; the driver sees at most ``CELLS`` cells in one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 2**16
# order of what is not finite among numbers
KINDS = (-math.inf, None, math.inf, math.nan)


@dataclass
class Interval:
    """Consecutive values of one column: the rank of the first, how many, and the smallest and largest."""

    column: int
    first: int
    count: int
    low: float
    high: float

    def parts(self, cells: list) -> list[Interval]:
        out, first = [], self.first
        for cell in sorted(cells, key=lambda c: c.b):
            out.append(Interval(self.column, first, cell.n, cell.low, cell.high))
            first += cell.n
        return out


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, v): the values of every column, in long form."""
    parts = [F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    return df.select(F.explode(F.array(*parts)).alias("x")).select("x.i", "x.v").filter("v IS NOT NULL")


def values_at(df: DataFrame, ranks: dict[str, list[int]] | None = None, probs: dict[str, list[float]] | None = None) -> dict:
    """{column: values} at 0-based ranks, or interpolated at the ranks p * (n - 1); None where a column has no value."""
    wanted = probs if ranks is None else ranks
    columns = list(wanted)
    rows = _values(df, columns).persist()
    try:
        v = F.col("v")
        kind = F.when(F.isnan(v), 3).when(v == math.inf, 2).when(v == -math.inf, 0).otherwise(1)
        ends = rows.groupBy("i", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        pieces: dict[int, list[Interval]] = {i: [] for i in range(len(columns))}
        for r in sorted(ends.collect(), key=lambda r: (r.i, r.kind)):
            before = pieces[r.i][-1] if pieces[r.i] else Interval(r.i, 0, 0, 0, 0)
            special = KINDS[r.kind]
            low, high = (r.low, r.high) if special is None else (special, special)
            pieces[r.i].append(Interval(r.i, before.first + before.count, r.n, low, high))
        sizes = [p[-1].first + p[-1].count if p else 0 for p in pieces.values()]
        if ranks is None:
            spots = [[p * (n - 1) for p in wanted[c]] if n else [] for c, n in zip(columns, sizes)]
        else:
            spots = [[r for r in wanted[c]] if n else [] for c, n in zip(columns, sizes)]
        need = [sorted({f(s) for s in spot for f in (math.floor, math.ceil)}) for spot in spots]
        found = _narrow(rows.filter(kind == 1), pieces, need)
    finally:
        rows.unpersist()

    def at(i: int, spot: float) -> float:
        low, high = found[i, math.floor(spot)], found[i, math.ceil(spot)]
        return low if low == high else low + (high - low) * (spot - math.floor(spot))

    return {c: [at(i, s) for s in spots[i]] if sizes[i] else [None] * len(wanted[c]) for i, c in enumerate(columns)}


def _narrow(rows: DataFrame, pieces: dict[int, list[Interval]], need: list[list[int]]) -> dict[tuple[int, int], float]:
    """{(column, rank): value}; ``pieces`` cover the ranks, finite ones are narrowed down over ``rows`` (i, v)."""
    spark = rows.sparkSession
    found: dict[tuple[int, int], float] = {}

    def settle(parts: list[Interval]) -> list[Interval]:
        """Notes ranks in parts of one value; gives the parts that still have to be cut."""
        still = []
        for p in parts:
            mine = [r for r in need[p.column] if p.first <= r < p.first + p.count]
            if mine and (p.low == p.high or p.low != p.low):
                found.update({(p.column, r): p.low for r in mine})
            elif mine:
                still.append(p)
        return still

    open_parts = settle([p for parts in pieces.values() for p in parts])
    rows = rows.select("i", "v")
    table = [(p.column, k, p.low, p.high) for k, p in enumerate(open_parts)]
    rows = rows.join(F.broadcast(spark.createDataFrame(table, "i int, k int, low double, high double")), "i") if table else rows
    while open_parts:
        width = max(64, CELLS // len(open_parts))
        # halves where the difference of the ends is beyond all numbers
        half = F.when(F.col("high") - F.col("low") == math.inf, 0.5).otherwise(1.0)
        share = (F.col("v") * half - F.col("low") * half) / (F.col("high") * half - F.col("low") * half)
        cells = rows.withColumn("b", F.least(F.floor(share * width), F.lit(width - 1)).cast("int"))
        counts = cells.groupBy("k", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        by_part: dict[int, list] = {}
        for cell in counts.toPandas().itertuples(index=False):
            by_part.setdefault(cell.k, []).append(cell)
        cut = [(k, c.b, part) for k, p in enumerate(open_parts) for c, part in zip(sorted(by_part[k], key=lambda c: c.b), p.parts(by_part[k]))]
        remain = settle([part for _, _, part in cut])
        names = {id(p): j for j, p in enumerate(remain)}
        table = [(k, int(b), names[id(p)], p.low, p.high) for k, b, p in cut if id(p) in names]
        open_parts = remain
        if table:
            following = spark.createDataFrame(table, "k int, b int, j int, low double, high double")
            rows = cells.drop("low", "high").join(F.broadcast(following), ["k", "b"]).select(F.col("j").alias("k"), "v", "low", "high")
    return found
