"""Target encodings: smoothed, out-of-fold, expanding and topic-weighted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators.clean import collapse_rare
from featloom.operators.encode import quantile_bins
from featloom.plans.prefix import running_sums
from featloom.plans.skew import keyed_left_join


def smooth_encode(
    df: DataFrame,
    cols: list[str],
    y: str,
    smoothing: float = 10.0,
    min_leaf: float = 100.0,
    noise: float = 0.0,
    seed: int | None = None,
    suffix: str = "_te",
) -> DataFrame:
    """prior * (1 - w) + mean * w with w = 1 / (1 + exp(-(n - min_leaf) / smoothing)).

    ``y`` is NULL on rows to be encoded only; unseen and NULL keys get the prior.
    """
    prior = df.agg(F.avg(y)).scalar()
    for i, c in enumerate(cols):
        name = f"{c}{suffix}"
        weight = 1 / (1 + F.exp(-(F.count(y) - min_leaf) / smoothing))
        stats = df.filter(F.col(c).isNotNull()).groupBy(c).agg(
            weight.alias("w"), F.avg(y).alias("m"), F.count(F.lit(1)).alias("__n")
        )
        table = stats.select(
            c, F.when(F.col("m").isNotNull(), prior * (1 - F.col("w")) + F.col("m") * F.col("w")).alias(name), "__n"
        )
        df = keyed_left_join(df, table, [c], weight="__n")
        df = df.withColumn(name, F.coalesce(F.col(name), prior))
        if noise:
            df = add_noise(df, name, noise, None if seed is None else seed + i)
    return df


def add_noise(df: DataFrame, col: str, level: float, seed: int | None = None) -> DataFrame:
    """Multiply by 1 + level * N(0, 1)."""
    draw = F.randn(seed) if seed is not None else F.randn()
    return df.withColumn(col, F.col(col) * (1 + level * draw))


def _stats(n: Column, s: Column, q: Column, prior: Column) -> tuple[Column, Column]:
    """Mean and sample std from count and sums centred at ``prior``; 0 when undefined."""
    mean = F.coalesce(prior + F.try_divide(s, n), F.lit(0.0))
    var = F.greatest(F.try_divide(q - F.try_divide(s * s, n), n - 1), F.lit(0.0))
    std = F.when(n > 1, F.sqrt(var)).otherwise(F.lit(0.0))
    return mean, std


def fold_table(df: DataFrame, col: str, y: str, fold_col: str, train: Column, folds: int) -> DataFrame:
    """Encoding values of one column: a row per (value, fold) with the statistics of
    the other folds, and a row with fold -1 holding the average over all folds.

    Count and centred sums are aggregated once per (value, fold); the sums of
    the other folds are the totals minus the fold's own.
    """
    prior = df.filter(train).agg(F.avg(y)).scalar()
    # the sums are taken over trained rows, the row count over all rows
    rows = df.filter(F.col(col).isNotNull()).withColumn("__prior", prior)
    d = F.when(train, F.col(y) - F.col("__prior"))
    cells = rows.groupBy(col, F.when(train, F.col(fold_col)).alias("__f")).agg(
        F.count(d).alias("n"),
        F.coalesce(F.sum(d), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(d * d), F.lit(0.0)).alias("q"),
        F.count(F.lit(1)).alias("__n"),
    )
    # at most folds + 1 cells per value, so they fit in one array
    packed = cells.groupBy(col).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum("__n").alias("__rows"),
        F.collect_list(F.struct("__f", "n", "s", "q", "__n")).alias("cells"),
    ).withColumn("__prior", prior)
    total = _stats(F.col("n"), F.col("s"), F.col("q"), F.col("__prior"))

    def without(c: Column) -> Column:
        mean, std = _stats(F.col("n") - c["n"], F.col("s") - c["s"], F.col("q") - c["q"], F.col("__prior"))
        return F.struct(c["__f"].cast("int").alias("__f"), mean.alias("mean"), std.alias("std"), c["__n"].alias("__n"))

    trained = F.filter("cells", lambda c: c["__f"].isNotNull())
    held_out = F.transform(trained, without)
    missing = F.lit(folds) - F.size("held_out")
    average = [
        (F.aggregate("held_out", F.lit(0.0), lambda a, c: a + c[k]) + missing * t) / folds
        for k, t in zip(("mean", "std"), total)
    ]
    test = F.struct(
        F.lit(-1).alias("__f"), average[0].alias("mean"), average[1].alias("std"), F.col("__rows").alias("__n")
    )
    rows = packed.withColumn("held_out", held_out)
    return rows.select(col, F.explode(F.concat("held_out", F.array(test))).alias("r")).select(
        col, "r.__f", "r.mean", "r.std", "r.__n"
    )


def oof_encode(
    df: DataFrame,
    cols: list[str],
    y: str,
    fold_col: str = "fold",
    split_col: str = "split",
    stats=("mean", "std"),
    folds: int = 5,
    suffix: str = "_dp",
) -> DataFrame:
    """Out-of-fold mean and std: train rows see the other folds only, test rows the
    average over folds; unseen keys, NULL keys and undefined stds give 0."""
    train = F.col(split_col) == "train"
    for c in cols:
        names = {k: f"{c}{suffix}_{k}_enc" for k in stats}
        table = fold_table(df, c, y, fold_col, train, folds)
        table = table.select(c, "__f", *[F.col(k).alias(v) for k, v in names.items()], "__n")
        rows = df.withColumn("__f", F.when(train, F.col(fold_col)).otherwise(F.lit(-1)).cast("int"))
        df = keyed_left_join(rows, table, [c, "__f"], weight="__n").drop("__f")
        df = df.withColumns({v: F.coalesce(v, F.lit(0.0)) for v in names.values()})
    return df


def user_oof_encode(df: DataFrame, y: str, key: str = "user_id", min_count: int = 30, **options) -> DataFrame:
    """Out-of-fold encoding of frequent users; the others share one group."""
    named = df.withColumn(key, F.col(key).cast("string"))
    collapsed = collapse_rare(named, [key], min_count=min_count, other="others_users")
    return oof_encode(collapsed, [key], y, **options)


def binned_oof_encode(df: DataFrame, col: str, y: str, q: int, **options) -> DataFrame:
    """Out-of-fold encoding of equal-frequency bins of a number."""
    return oof_encode(quantile_bins(df, col, q), [f"{col}_bin"], y, **options)


def expanding_encode(
    df: DataFrame, cols: list[str], y: str, order: list[str], split_col: str = "split", suffix: str = "_exp",
    blocks: int | None = None,
) -> DataFrame:
    """Train: mean of the earlier rows of the group (first row 0); test: mean of all."""
    train = F.col(split_col) == "train"
    target = F.when(train, F.col(y))
    for c in cols:
        name = f"{c}{suffix}"
        known = df.filter(F.col(c).isNotNull())
        full = known.groupBy(c).agg(F.avg(target).alias("__full"), F.count(F.lit(1)).alias("__n"))
        sums = {"__s": target, "__c": target.isNotNull().cast("int")}
        rows = running_sums(df, [c], order, sums, include_current=False, blocks=blocks)
        rows = keyed_left_join(rows, full, [c], weight="__n")
        seen = F.coalesce(F.try_divide("__s", "__c"), F.lit(0.0))
        value = F.when(train & F.col(c).isNotNull(), seen).otherwise(F.coalesce("__full", F.lit(0.0)))
        df = rows.withColumn(name, value).drop("__s", "__c", "__full")
    return df


def topic_stats(df: DataFrame, topic: str, cols: dict[str, list[str]]) -> DataFrame:
    """Per topic: the requested statistics of each column."""
    from featloom.operators.group import group_stats
    from featloom.plans.fusion import Spec

    specs = [Spec((topic,), c, a, None, f"{c}_{a}") for c, aggs in cols.items() for a in aggs]
    return group_stats(df, [topic], specs, weight=None)


def topic_weighted(shares: DataFrame, stats: DataFrame, id_col: str, topic: str, share: str = "share") -> DataFrame:
    """Sum over topics of share * statistic; ``shares`` is (id, topic, share)."""
    names = [c for c in stats.columns if c != topic]
    joined = shares.join(stats, topic, "left")
    return joined.groupBy(id_col).agg(
        *[F.sum(F.col(share) * F.coalesce(F.col(n), F.lit(0.0))).alias(f"weighted_{n}") for n in names]
    )


def topic_weighted_oof(
    shares: DataFrame, rows: DataFrame, id_col: str, topic: str, y: str, fold_col: str = "fold",
    split_col: str = "split", folds: int = 5,
) -> DataFrame:
    """Out-of-fold form: topic statistics of the other folds, weighted by the shares."""
    train = F.col(split_col) == "train"
    table = fold_table(rows, topic, y, fold_col, train, folds)
    keyed = rows.select(id_col, F.when(train, F.col(fold_col)).otherwise(F.lit(-1)).cast("int").alias("__f"))
    joined = shares.join(keyed, id_col).join(table.drop("__n"), [topic, "__f"], "left")
    return joined.groupBy(id_col).agg(
        *[F.sum(F.col("share") * F.coalesce(F.col(k), F.lit(0.0))).alias(f"weighted_{y}_{k}") for k in ("mean", "std")]
    )
