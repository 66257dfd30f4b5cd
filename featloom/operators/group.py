"""Group statistics joined back on rows, activity rollups and table profiles."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.operators.joins import attach
from featloom.plans.fusion import AGGREGATES, QUANTILES, Spec, by_key
from featloom.plans.prefix import exact_quantiles, sortable
from featloom.plans.selection import values_at
from featloom.plans.sizing import cut_lineage
from featloom.plans.skew import Side, keyed_left_join, keyed_left_joins


def null_safe(a_keys: list[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in a_keys])


def merge_groups(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two aggregates of the same keys; a NULL key meets a NULL key."""
    renamed = b.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    return a.join(renamed, null_safe(keys, "__r_"), "left").drop(*[f"__r_{k}" for k in keys])


def group_stats(df: DataFrame, keys: list[str], specs: list[Spec], mark: str = "", weight: str | None = "__n") -> DataFrame:
    """All statistics of one key in one aggregation (plus one per exact quantile column)."""
    plain = [s for s in specs if s.agg not in QUANTILES]
    aggs = [AGGREGATES[s.agg](s.column()).alias(s.name(mark)) for s in plain]
    if weight:
        aggs.append(F.count(F.lit(1)).alias(weight))
    stats = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    for s in specs:
        if s.agg in QUANTILES:
            source = df.filter(F.expr(s.where)) if s.where else df
            q = exact_quantiles(source, keys, s.on, {s.name(mark): QUANTILES[s.agg]})
            stats = merge_groups(stats, q, keys)
    return stats


def group_features(df: DataFrame, specs: list[Spec], source: DataFrame | None = None, mark: str = "") -> DataFrame:
    """Add every feature to the rows of ``df``: one aggregation per distinct key, however many
    features share it, and one join for all keys.

    The rows and the statistics of each key are written, so no plan holds those of all keys.
    """
    origin = cut_lineage(df if source is None else source)
    weight = "__n" if source is None else None
    sides = [Side(cut_lineage(group_stats(origin, list(key), group, mark, weight)), list(key), weight) for key, group in by_key(specs).items()]
    return keyed_left_joins(origin if source is None else df, sides)


# fixed values: the standing feature list of the listing tables
CATEGORY_KEYS = ["region", "city", "parent_category_name", "category_name", "user_type", "param_1", "param_2", "param_3"]
CATEGORY_MEANS = ["price", "image_top_1", "item_seq_number"]
PREDICTIONS = ("price_pred", "price_pred_all", "ridge_preds")
USER_KINDS = ["parent_category_name", "category_name", "param_1", "param_2", "param_3", "activation_date"]
IMAGE_KINDS = ["item_id", "user_id", "category_name", "param_1", "item_seq_number"]


def default_specs(predictions: tuple[str, str, str] = PREDICTIONS) -> list[Spec]:
    """The standing feature list; ``predictions`` names the columns of predicted prices (own rows,
    all rows) and of the first-level model."""
    price, _, first_level = predictions
    specs = [Spec((c,), n, "mean") for c in CATEGORY_KEYS for n in [*CATEGORY_MEANS, *predictions]]
    specs += [Spec(("user_id",), c, "nunique") for c in USER_KINDS]
    specs.append(Spec(("user_id", "activation_date"), "item_id", "count"))
    specs += [Spec(("image_top_1",), c, "nunique") for c in IMAGE_KINDS]
    specs += [Spec(("image_top_1",), c, a) for c, a in ((price, "mean"), (price, "std"), ("item_seq_number", "mean"))]
    specs += [Spec(k, first_level, "mean") for k in (("user_id",), ("user_id", "category_name"), ("user_id", "image_top_1"))]
    specs.append(Spec(("user_id", "category_name"), first_level, "sum"))
    return specs


def category_share(df: DataFrame, key: str, col: str, values: list, prefix: str | None = None) -> DataFrame:
    """Share of each listed value of ``col`` per key."""
    prefix = prefix or f"share_{key}_{col}_"
    shares = [
        F.avg(F.when(F.col(col) == v, 1.0).otherwise(0.0)).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(key).agg(*shares)


def profile_vector(df: DataFrame, key: str, col: str, values: list | None = None) -> DataFrame:
    """One share column per category value (the values of a low-cardinality column)."""
    if values is None:
        found = df.select(col).dropna().distinct().orderBy(col).limit(201).collect()
        if len(found) > 200:
            raise ValueError(f"{col} has more than 200 values; pass the ones to profile")
        values = [r[0] for r in found]
    return category_share(df, key, col, values, f"{col}_")


def activity_rollup(items: DataFrame, periods: DataFrame, medians: bool = False) -> tuple[DataFrame, DataFrame]:
    """(per user, per item) activity: days up and times put up per item, averaged
    over the items of a user, and the number of items of the user.

    An item listed several times counts once.  Items without a period count
    for the number of items only, so no outer join is needed: the rollup is
    taken over the items with their (possibly missing) period sums.
    """
    owners = items.groupBy("item_id").agg(F.min("user_id").alias("user_id"))
    per_item = periods.groupBy("item_id").agg(
        F.sum(F.datediff("date_to", "date_from")).alias("days_up_sum"),
        F.count("date_to").alias("times_put_up"),
    )
    both = owners.join(per_item, "item_id", "full")
    both = cut_lineage(both) if medians else both
    known = both.filter(F.col("user_id").isNotNull())
    users = known.groupBy("user_id").agg(
        F.avg("days_up_sum").alias("avg_days_up_user"),
        F.avg("times_put_up").alias("avg_times_up_user"),
        F.count(F.lit(1)).alias("n_user_items"),
    )
    if medians:
        kinds = {"med_days_up_user": "days_up_sum", "med_times_up_user": "times_put_up"}
        values = [F.struct(F.lit(i).alias("kind"), F.col(c).cast("double").alias("x")) for i, c in enumerate(kinds.values())]
        each = known.select("user_id", F.explode(F.array(*values)).alias("v")).select("user_id", "v.kind", "v.x")
        found = exact_quantiles(each, ["user_id", "kind"], "x", {"m": 0.5}).groupBy("user_id")
        middle = found.agg(*[F.max(F.when(F.col("kind") == i, F.col("m"))).alias(n) for i, n in enumerate(kinds)])
        users = users.join(middle, "user_id", "left")
    with_periods = both.filter(F.col("times_put_up").isNotNull()).select("item_id", "user_id")
    sized = users.withColumn("__n", F.col("n_user_items"))
    per_item_user = keyed_left_join(with_periods, sized, ["user_id"], weight="__n")
    names = [c for c in users.columns if c != "user_id"]
    return users, per_item_user.select("item_id", *[F.col(c).alias(f"{c}_item") for c in names])


def conditional_stats(df: DataFrame, key: list[str], on: str, aggs: list[str], where: str, prefix: str = "") -> DataFrame:
    """Statistics of ``on`` over the rows of a group that satisfy ``where``."""
    specs = [Spec(tuple(key), on, a, where, f"{prefix}{on}_{a}") for a in aggs]
    return group_stats(df, key, specs, weight=None)


def mean_log_price(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """Mean log1p(price) per key over rows with a price."""
    rows = df.filter(F.col(price).isNotNull())
    return rows.groupBy(*keys).agg(F.avg(F.log1p(price)).alias("avg_log_price"))


def per_date_stats(df: DataFrame, date_col: str, cols: list[str], aggs=("mean", "median", "std")) -> DataFrame:
    specs = [Spec((date_col,), c, a, None, f"{c}_{a}") for c in cols for a in aggs]
    return group_stats(df, [date_col], specs, weight=None)


def unique_percent(df: DataFrame, date_col: str, cols: list[str]) -> DataFrame:
    """Distinct values per 100 rows of each date."""
    n = F.count(F.lit(1))
    return df.groupBy(date_col).agg(
        *[F.try_divide(F.count_distinct(c) * 100.0, n).alias(f"{c}_unique_pct") for c in cols]
    )


def cross_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Per ``a``: distinct ``b``; then largest, smallest, std and median of those counts."""
    counts = df.filter(F.col(a).isNotNull()).groupBy(a).agg(F.count_distinct(b).alias("n"))
    spread = counts.agg(
        F.max("n").alias("n_max"), F.min("n").alias("n_min"), F.stddev_samp("n").alias("n_std")
    )
    median = exact_quantiles(counts, [], "n", {"n_median": 0.5}).scalar()
    return spread.withColumn("n_median", median).select(
        F.lit(a).alias("by"), F.lit(b).alias("of"), "n_max", "n_min", "n_std", "n_median"
    )


def frequency_encode(df: DataFrame, cols: list[str], fit_on: Column | None = None, suffix: str = "_cnt") -> DataFrame:
    """Rows per value (over the rows where ``fit_on`` holds); unseen and NULL give 0."""
    for c in cols:
        hit = F.lit(1) if fit_on is None else F.when(fit_on, 1)
        counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(
            F.count(hit).alias(f"{c}{suffix}"), F.count(F.lit(1)).alias("__n")
        )
        df = attach(df, counts, c, default=0, weight="__n")
    return df


def user_stats(df: DataFrame, key: str, num_cols: list[str], cat_cols: list[str], where: str | None = None) -> DataFrame:
    """Mean and std of numbers and number of categories per user, missing as 0."""
    rows = df.filter(where) if where else df
    specs = [Spec((key,), c, a, None, f"{c}_user_{a}") for c in num_cols for a in ("mean", "std")]
    specs += [Spec((key,), c, "set_size", None, f"{c}_user_type_cnt") for c in cat_cols]
    return group_stats(rows, [key], specs, weight=None).fillna(0).fillna(0.0)


def totals_with_default(df: DataFrame, totals: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Attach per-key totals; rows without them get the mean over all keys."""
    joined = attach(df, totals.select(key, *cols), key)
    means = totals.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    rows = joined.withColumn("__m", means)
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("__m")[c]) for c in cols}).drop("__m")


def impute_by_group(df: DataFrame, col: str, key: str, how: str = "mode") -> DataFrame:
    """Fill missing values by the most frequent (smallest on ties) or median value of the group."""
    if how == "mode":
        counts = df.filter(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("n"))
        fill = counts.groupBy(key).agg(
            F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias("__fill"), F.sum("n").alias("__n")
        )
        joined = attach(df, fill, key, weight="__n")
    else:
        joined = attach(df, exact_quantiles(df, [key], col, {"__fill": 0.5}), key)
    return joined.withColumn(col, F.coalesce(col, "__fill")).drop("__fill")


def corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise correlations (rows where both are present), one aggregation."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("corr"))
                     for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing values per column, and rows with any missing value."""
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in cols])
    wide = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols],
        F.count_if(any_null).alias("(any)"),
        F.count(F.lit(1)).alias("__rows"),
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing")) for c in [*cols, "(any)"]])
    return wide.select(F.explode(rows).alias("r"), "__rows").select(
        "r.column", "r.missing", F.try_divide(F.col("r.missing") * 100.0, F.col("__rows")).alias("missing_pct")
    )


def value_counts(df: DataFrame, col: str, min_count: int = 0) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > min_count)


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows per fixed-width bin between the smallest and largest value (top bin closed) of numbers, dates or times."""
    if isinstance(df.schema[col].dataType, T.StringType):
        raise TypeError(f"{col} is a string, which has no width; use value_counts")
    x = F.col("x")
    rows = df.select(sortable(df, col).alias("x")).filter(x.isNotNull())
    ends = rows.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    rows = rows.withColumn("e", ends)
    pos = F.try_divide((x - F.col("e.lo")) * n, F.col("e.hi") - F.col("e.lo"))
    bin_no = F.least(F.floor(F.coalesce(pos, F.lit(0.0))), F.lit(n - 1)).cast("int")
    return rows.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def scalars(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Mean, sample std and exact quantiles of whole columns, long form; the quantiles of all columns share their passes."""
    names = [f"p{round(p * 100)}" for p in probs]
    found = values_at(df, probs={c: list(probs) for c in cols})
    wide = df.agg(*[f(c).alias(f"{c}__{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
            *[F.lit(v).cast("double").alias(n) for n, v in zip(names, found[c])],
        )
        for c in cols
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
