"""Category codes, bins and scaling."""

from __future__ import annotations


from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.plans.prefix import sorted_codes
from featloom.plans.selection import values_at
from featloom.plans.sizing import cut_lineage
from featloom.plans.skew import Side, keyed_left_joins


def label_encode(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Rank of each value among the sorted distinct values ('nan' for missing).

    The rows of several columns are written once, or each column would compute them anew, and meet all codes together.
    """
    rows = cut_lineage(df) if len(cols) > 1 else df
    marks = {c: f"__v{i}" for i, c in enumerate(cols)}
    rows = rows.withColumns({m: F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c, m in marks.items()})
    sides = []
    for m in marks.values():
        values = rows.groupBy(m).agg(F.count(F.lit(1)).alias("__n"))
        sides.append(Side(sorted_codes(values, m, f"{m}_code"), [m], "__n"))
    rows = keyed_left_joins(rows, sides)
    coded = rows.withColumns({f"{c}{suffix}": F.col(f"{m}_code") for c, m in marks.items()})
    return coded.drop(*marks.values(), *[f"{m}_code" for m in marks.values()])


def category_sizes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column (NULL not counted), long form."""
    wide = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in cols])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def split_by_cardinality(df: DataFrame, cols: list[str], threshold: int = 3000) -> tuple[list[str], list[str]]:
    """(high-cardinality columns, the others)."""
    high = {r.column for r in category_sizes(df, cols).filter(F.col("values") > threshold).collect()}
    return [c for c in cols if c in high], [c for c in cols if c not in high]


def one_hot(df: DataFrame, cat_cols: list[str], num_cols: list[str] = (), weight_col: str | None = None) -> DataFrame:
    """Sparse ``features``: indicator per category (times ``weight_col``), then numbers."""
    coded = label_encode(df, cat_cols, "__idx")
    encoder = OneHotEncoder(
        inputCols=[f"{c}__idx" for c in cat_cols],
        outputCols=[f"{c}__vec" for c in cat_cols],
        dropLast=False,
        handleInvalid="keep",
    )
    vecs = encoder.fit(coded).transform(coded)
    parts = [f"{c}__vec" for c in cat_cols]
    if weight_col:
        from pyspark.ml.feature import Interaction

        for c in cat_cols:
            step = Interaction(inputCols=[weight_col, f"{c}__vec"], outputCol=f"{c}__wvec")
            vecs = step.transform(vecs)
        parts = [f"{c}__wvec" for c in cat_cols]
    out = VectorAssembler(inputCols=[*parts, *num_cols], outputCol="features", handleInvalid="error").transform(vecs)
    return out.select(*df.columns, "features")


def bin_edges(df: DataFrame, col: str, q: int) -> DataFrame:
    """One row: sorted distinct edges of ``q`` equal-frequency bins."""
    return df.sparkSession.createDataFrame([(edges_of(df, col, [q])[q],)], "edges array<double>")


def edges_of(df: DataFrame, col: str, sizes: list[int]) -> dict[int, list[float]]:
    """The sorted distinct edges for every number of bins, all from the same passes."""
    steps = sorted({i / q for q in sizes for i in range(q + 1)})
    found = dict(zip(steps, values_at(df, probs={col: steps})[col]))
    return {q: sorted({v for i in range(q + 1) if (v := found[i / q]) is not None}) for q in sizes}


def add_bin(df: DataFrame, x: Column, edges: str, name: str, most: int) -> DataFrame:
    """Right-closed bin number of ``x`` among a sorted array column of at most ``most``
    edges; the lowest edge belongs to bin 0.  Binary search, one projection per halving."""
    out = df.withColumn("__x", x).withColumn("__below", F.lit(0))
    step = 1 << (most.bit_length() - 1)
    while step:
        passed = F.get(edges, F.col("__below") + (step - 1)) < F.col("__x")
        out = out.withColumn("__below", F.when(passed, F.col("__below") + step).otherwise(F.col("__below")))
        step //= 2
    inside = (F.col("__x") >= F.get(edges, F.lit(0))) & (F.col("__x") <= F.element_at(edges, -1))
    return out.withColumn(name, F.when(inside, F.greatest(F.col("__below") - 1, F.lit(0)))).drop("__x", "__below")


def quantile_bins(df: DataFrame, col: str, q: int, fit_on: DataFrame | None = None, exact: bool = True,
                  name: str | None = None) -> DataFrame:
    """Equal-frequency bins with repeated edges dropped."""
    source = df if fit_on is None else fit_on
    if exact:
        edges = bin_edges(source, col, q).scalar()
    else:
        steps = [i / q for i in range(q + 1)]
        approx = source.agg(F.percentile_approx(F.col(col).cast("double"), steps, 100 * q).alias("e"))
        edges = approx.select(F.array_sort(F.array_distinct("e"))).scalar()
    rows = df.withColumn("__edges", edges)
    return add_bin(rows, F.col(col).cast("double"), "__edges", name or f"{col}_bin", q + 1).drop("__edges")


def bin_count_scores(df: DataFrame, col: str, y: str, sizes: list[int]) -> DataFrame:
    """Mean within-bin standard deviation of ``y`` for every bin count."""
    rows = df.select(F.col(col).cast("double").alias("x"), F.col(y).alias("y")).dropna()
    edges = edges_of(rows, "x", sizes)
    per_size = [F.struct(F.lit(q).alias("n_bins"), F.lit(edges[q]).cast("array<double>").alias("edges")) for q in sizes]
    # few candidate sizes: each value is binned once per size
    each = rows.withColumn("s", F.explode(F.array(*per_size))).select("x", "y", "s.n_bins", "s.edges")
    binned = add_bin(each, F.col("x"), "edges", "bin", max(sizes) + 1)
    within = binned.groupBy("n_bins", "bin").agg(F.stddev("y").alias("sd"))
    return within.groupBy("n_bins").agg(F.avg("sd").alias("mean_std"))


def best_bin_count(df: DataFrame, col: str, y: str, sizes: list[int]) -> DataFrame:
    return bin_count_scores(df, col, y, sizes).orderBy("mean_std", "n_bins").limit(1)


def _moments(df: DataFrame, cols: list[str], exprs) -> Column:
    """All per-column aggregates as one struct-valued scalar subquery."""
    aggs = [fn(F.col(c)).alias(f"{c}__{tag}") for c in cols for tag, fn in exprs.items()]
    return df.agg(F.struct(*aggs)).scalar()


def standardize(df: DataFrame, cols: list[str], ddof: int = 0, suffix: str = "") -> DataFrame:
    """(x - mean) / std; missing values are skipped."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    m = _moments(df, cols, {"mean": F.avg, "sd": sd})
    rows = df.withColumn("__m", m)
    out = {f"{c}{suffix}": F.try_divide(F.col(c) - F.col("__m")[f"{c}__mean"], F.col("__m")[f"{c}__sd"]) for c in cols}
    return rows.withColumns(out).drop("__m")


def minmax(df: DataFrame, cols: list[str], only_nonneg: bool = True, negative: float | None = -1.0,
           suffix: str = "") -> DataFrame:
    """Scale to [0,1]; with ``only_nonneg``, negative values become ``negative`` (None keeps them)."""
    pick = (lambda c: F.when(c >= 0, c)) if only_nonneg else (lambda c: c)
    m = _moments(df, cols, {"lo": lambda c: F.min(pick(c)), "hi": lambda c: F.max(pick(c))})
    rows = df.withColumn("__m", m)
    out = {}
    for c in cols:
        lo, hi = F.col("__m")[f"{c}__lo"], F.col("__m")[f"{c}__hi"]
        scaled = F.try_divide(F.col(c) - lo, hi - lo)
        if only_nonneg:
            kept = F.col(c) if negative is None else F.lit(negative)
            scaled = F.when(F.col(c) >= 0, scaled).when(F.col(c) < 0, kept)
        out[f"{c}{suffix}"] = scaled
    return rows.withColumns(out).drop("__m")


def fill_outside(df: DataFrame, cols: list[str]) -> DataFrame:
    """Missing as 1.1 * min when the negative side is longer, else as -max."""
    m = _moments(df, cols, {"lo": F.min, "hi": F.max})
    rows = df.withColumn("__m", m)
    out = {}
    for c in cols:
        lo, hi = F.col("__m")[f"{c}__lo"], F.col("__m")[f"{c}__hi"]
        out[c] = F.coalesce(F.col(c), F.when(F.abs(lo) > F.abs(hi), lo * 1.1).otherwise(-hi))
    return rows.withColumns(out).drop("__m")


def boxcox(x: Column, lam: float) -> Column:
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / lam


def boxcox_apply(df: DataFrame, lambdas: dict[str, float], shift: str = "to_one") -> DataFrame:
    """Box-Cox with given parameters on x - min + 1 (shift 'to_one') or on x ('none')."""
    m = _moments(df, list(lambdas), {"lo": F.min})
    rows = df.withColumn("__m", m)
    base = (lambda c: F.col(c) - F.col("__m")[f"{c}__lo"] + 1) if shift == "to_one" else F.col
    return rows.withColumns({c: boxcox(base(c), lam) for c, lam in lambdas.items()}).drop("__m")


def boxcox_scores(df: DataFrame, col: str, grid: list[float], shift: str = "to_one") -> DataFrame:
    """Log-likelihood of every parameter in ``grid``, from one aggregation."""
    x = F.col(col).cast("double")
    if shift == "to_one":
        x = x - df.agg(F.min(col)).scalar() + 1
    rows = df.filter(F.col(col).isNotNull()).select(x.alias("x"))
    aggs = [F.var_pop(boxcox(F.col("x"), g)).alias(f"v{i}") for i, g in enumerate(grid)]
    sums = rows.agg(F.count("x").alias("n"), F.sum(F.log("x")).alias("slog"), *aggs)
    scored = [
        F.struct(
            F.lit(float(g)).alias("lam"),
            ((g - 1) * F.col("slog") - F.col("n") / 2 * F.log(f"v{i}")).alias("loglik"),
        )
        for i, g in enumerate(grid)
    ]
    return sums.select(F.explode(F.array(*scored)).alias("s")).select("s.*")


def boxcox_lambda(df: DataFrame, col: str, grid: list[float] | None = None, refine: int = 2,
                  shift: str = "to_one") -> float:
    """Maximum-likelihood parameter: coarse grid, then finer grids around the best."""
    grid = grid or [i / 4 for i in range(-8, 9)]
    step = grid[1] - grid[0]
    best = boxcox_scores(df, col, grid, shift).orderBy(F.desc("loglik"), "lam").first().lam
    for _ in range(refine):
        finer = [best + step * (i - 8) / 8 for i in range(17)]
        step /= 8
        best = boxcox_scores(df, col, finer, shift).orderBy(F.desc("loglik"), "lam").first().lam
    return best


def log10_standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """log10(x + 1) with undefined results as 0, then standardised."""
    logged = df.withColumns(
        {c: F.coalesce(F.when(F.col(c) > -1, F.log10(F.col(c) + 1)), F.lit(0.0)) for c in cols}
    )
    return standardize(logged, cols, ddof=0)


