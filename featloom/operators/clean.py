"""Missing values, row filters, splits, category clean-up and column types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.functions.columns import log1p_positive
from featloom.operators.joins import attach
from featloom.plans.prefix import running_sums


def fill_missing(df: DataFrame, values: dict[str, object], flag_suffix: str | None = None) -> DataFrame:
    """Constant per column; with a suffix, 0/1 flags of what was missing."""
    if flag_suffix:
        df = df.withColumns({f"{c}{flag_suffix}": F.col(c).isNull().cast("int") for c in values})
    return df.fillna(values)


def log_columns(df: DataFrame, cols: list[str], kind: str = "log1p", only_positive: bool = True) -> DataFrame:
    """log1p (guarded), 'log' (log(x + 0.001), missing as the mean) or 'expm1'."""
    if kind == "log1p":
        return df.withColumns(
            {c: log1p_positive(F.col(c)) if only_positive else F.log1p(F.col(c)) for c in cols}
        )
    if kind == "expm1":
        return df.withColumns({c: F.expm1(F.col(c)) for c in cols})
    logged = {c: F.log(F.col(c) + 0.001) for c in cols}
    means = {c: df.agg(F.avg(e)).scalar() for c, e in logged.items()}
    return df.withColumns({c: F.coalesce(logged[c], means[c]) for c in cols})


def split_by_date(df: DataFrame, date_col: str, ranges: dict[str, tuple[str, str]], name: str = "part") -> DataFrame:
    """Name of the (inclusive) date range a row falls in; other rows are dropped."""
    label = F.coalesce(
        *[F.when(F.col(date_col).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), part)
          for part, (lo, hi) in ranges.items()]
    )
    return df.withColumn(name, label).filter(F.col(name).isNotNull())


def split_by_fraction(df: DataFrame, order: list[str], fraction: float = 0.7, name: str = "part") -> DataFrame:
    """The first ``int(n * fraction)`` rows in ``order`` are 'train', the rest 'valid'."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = running_sums(df, [], order, {"__pos": F.lit(1)})
    limit = F.floor(total * fraction)
    return ranked.withColumn(name, F.when(F.col("__pos") <= limit, "train").otherwise("valid")).drop("__pos")


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def collapse_rare(
    df: DataFrame,
    cols: list[str],
    split_col: str = "split",
    min_count: int = 0,
    in_splits=("train", "test"),
    other="others",
) -> DataFrame:
    """Keep values with more than ``min_count`` rows that occur in every split;
    the others become ``other``.  A missing value is one more value."""
    for c in cols:
        text = F.coalesce(F.col(c).cast("string"), F.lit("nan"))
        rows = df.withColumn(c, text)
        seen = [F.max(F.when(F.col(split_col) == s, 1).otherwise(0)) for s in in_splits]
        stats = rows.groupBy(c).agg(
            F.count(F.lit(1)).alias("__n"),
            (reduce(lambda a, b: a * b, seen) * (F.count(F.lit(1)) > min_count).cast("int")).alias("__keep"),
        )
        df = (
            attach(rows, stats, c, weight="__n")
            .withColumn(c, F.when(F.col("__keep") == 1, F.col(c)).otherwise(F.lit(other)))
            .drop("__keep")
            .select(*df.columns)
        )
    return df


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 0, buckets: int = 1_000_000) -> DataFrame:
    """Repeatable sample: rows whose hashed key falls in the first buckets."""
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(buckets)) < int(fraction * buckets))


def drop_constant(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns with a single value (NULL counts as one); an empty frame keeps all."""
    rows = F.count(F.lit(1))
    whole = [(rows > 0) & ((F.count(c) == 0) | (F.count(c) == rows)) for c in cols]
    row = df.agg(*[(F.min(c).eqNullSafe(F.max(c)) & w).alias(c) for c, w in zip(cols, whole)]).first()
    return df.drop(*[c for c in cols if row[c]])


def column_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column with its smallest and largest value."""
    wide = df.agg(
        *[F.min(c).cast("double").alias(f"{c}__lo") for c in cols],
        *[F.max(c).cast("double").alias(f"{c}__hi") for c in cols],
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__lo").alias("lo"), F.col(f"{c}__hi").alias("hi"))
                     for c in cols])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


INTEGER_TYPES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63))
FLOAT_LIMIT = 3.4028234663852886e38


def plan_types(df: DataFrame, cols: list[str] | None = None) -> dict[str, str]:
    """Smallest type that holds the observed range of each numeric column."""
    numeric = cols or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    integral = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
    plan = {}
    for row in column_ranges(df, numeric).collect():
        if row.lo is None:
            continue
        if row.column in integral:
            plan[row.column] = next(t for t, lim in INTEGER_TYPES if -lim <= row.lo and row.hi < lim or t == "bigint")
        else:
            fits = abs(row.lo) < FLOAT_LIMIT and abs(row.hi) < FLOAT_LIMIT
            plan[row.column] = "float" if fits else "double"
    return plan


def downcast(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in plan.items()})


