"""Out-of-fold training, stacking, losses and blending."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from math import comb
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import FMRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.functions.columns import accept_class, argmax, clip
from featloom.operators.encode import label_encode
from featloom.operators.joins import attach
from featloom.operators.rowstats import row_stats
from featloom.plans.sizing import cut_lineage, new_folder


def assign_folds(df: DataFrame, key: str, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Reproducible fold of a row id: arithmetic for numbers, a hash for strings."""
    if dict(df.dtypes)[key] == "string":
        value = F.xxhash64(F.lit(seed), F.col(key))
    else:
        value = F.pmod(F.col(key), F.lit(1_000_003)) * 31 + seed
    return df.withColumn(name, F.pmod(value, F.lit(k)).cast("int"))


# ---- learners -----------------------------------------------------------------------


@dataclass(frozen=True)
class Ridge:
    """Squared error + alpha * |w|^2 (the penalty is not divided by the rows)."""

    alpha: float = 1.0
    label: str = "label"

    def fit(self, df: DataFrame):
        n, sd = df.agg(F.count(F.lit(1)), F.stddev_pop(self.label)).first()
        # Spark divides both the error by the rows and the penalty by the label's std
        reg = self.alpha * (sd or 0.0) / max(n, 1)
        return LinearRegression(featuresCol="features", labelCol=self.label, elasticNetParam=0.0, regParam=reg,
                                standardization=False).fit(df)


KINDS = {
    "linear": lambda p: LinearRegression(featuresCol="features", labelCol="label", **p),
    "ridge": lambda p: Ridge(**p),
    "logistic": lambda p: LogisticRegression(featuresCol="features", labelCol="label", **p),
    "gbt": lambda p: GBTRegressor(featuresCol="features", labelCol="label", **p),
    "gbt_class": lambda p: GBTClassifier(featuresCol="features", labelCol="label", **p),
    "gbt_multiclass": lambda p: OneVsRest(classifier=GBTClassifier(**p), featuresCol="features", labelCol="label"),
    "forest": lambda p: RandomForestRegressor(featuresCol="features", labelCol="label", **p),
    "forest_class": lambda p: RandomForestClassifier(featuresCol="features", labelCol="label", **p),
    "fm": lambda p: FMRegressor(featuresCol="features", labelCol="label", **p),
}
CLASSIFIERS = ("logistic", "gbt_multiclass", "forest_class")
# rows that a task of a fit reads; files of features compress so well that one split holds many millions
ROWS = 200_000


def dealt(df: DataFrame) -> DataFrame:
    """Written rows in splits of at most about ``ROWS`` rows; fewer rows stay as they are read."""
    parts = -(-df.count() // ROWS)
    return df.repartition(parts) if parts > df.rdd.getNumPartitions() else df


def make_estimator(kind: str, **params):
    return KINDS[kind](params)


def assemble(df: DataFrame, cols: list[str], y: str) -> DataFrame:
    """``features`` and ``label`` beside the given columns; missing numbers become -1."""
    filled = df.fillna({c: -1 for c in cols})
    out = VectorAssembler(inputCols=cols, outputCol="features").transform(filled)
    return out.withColumn("label", F.col(y).cast("double"))


def _score(model, df: DataFrame, name: str, probability: bool) -> DataFrame:
    """Add the prediction (or the probability of class 1) of one model as ``name``."""
    scored = model.transform(df)
    value = F.get(vector_to_array("probability"), F.lit(1)) if probability else F.col("prediction")
    return scored.withColumn(name, value).select(*df.columns, name)


def fit_folds(
    df: DataFrame, make, folds: int, fold_col: str, split_col: str, parallel: int = 4, early_stopping: bool = False
) -> list:
    """One model per left-out fold, fitted side by side.

    With ``early_stopping`` (boosted trees) the left-out fold is the validation set: no
    tree is added once the error on it stops falling.  For a fold without rows the next one that has rows is left out.
    """
    train = df.filter((F.col(split_col) == "train") & F.col("label").isNotNull())
    some = set()
    if early_stopping:
        some = {int(r[0]) for r in train.filter(F.col(fold_col).between(0, folds - 1)).select(fold_col).distinct().collect()}
        if df.sparkSession.sparkContext.getCheckpointDir() is None:  # the errors of each round depend on those before
            df.sparkSession.sparkContext.setCheckpointDir(new_folder(df.sparkSession, "boosting"))

    def fit(f: int):
        if early_stopping:
            f = next((g % folds for g in range(f, f + folds) if g % folds in some), f)
            held = train.select("features", "label", (F.col(fold_col) == f).alias("held"))
            return make().setValidationIndicatorCol("held").fit(held)
        return make().fit(train.filter(F.col(fold_col) != f).select("features", "label"))

    with ThreadPool(min(parallel, folds)) as pool:
        return pool.map(inheritable_thread_target(df.sparkSession)(fit), range(folds))


def _score_folds(
    scored: DataFrame, models: list, name: str, fold_col: str, split_col: str, probability: bool
) -> tuple[DataFrame, Column]:
    """``scored`` with a column for each fold's model, and the prediction: train rows by
    the model that did not see their fold, others by the average."""
    names = [f"__{name}_{f}" for f in range(len(models))]
    for model, col in zip(models, names):
        scored = _score(model, scored, col, probability)
    own = F.get(F.array(*names), F.col(fold_col).cast("int"))
    mean = reduce(Column.__add__, [F.col(n) for n in names]) / len(models)
    return scored, F.when(F.col(split_col) == "train", own).otherwise(mean)


def oof_predict(
    df: DataFrame, kind: str, id_col: str, fold_col: str = "fold", split_col: str = "split", folds: int = 5,
    seeds=(None,), probability: bool = False, name: str = "pred", models_out: list | None = None,
    early_stopping: bool = False, **params,
) -> DataFrame:
    """(id, split, fold, label, pred): train rows are predicted by the model that did not
    see their fold, test rows by the average of all models; seeds are averaged.

    The rows are written once; all models score them in one pass, so nothing is shuffled or unioned.
    """
    rows = dealt(cut_lineage(df.select(id_col, split_col, fold_col, "label", "features")))
    scored, preds = rows, []
    for i, seed in enumerate(seeds):
        extra = {} if seed is None else {"seed": seed}
        make = lambda: make_estimator(kind, **params, **extra)  # noqa: B023, E731
        models = fit_folds(rows, make, folds, fold_col, split_col, early_stopping=early_stopping)
        if models_out is not None:
            models_out += models
        scored, pred = _score_folds(scored, models, f"p{i}", fold_col, split_col, probability)
        preds.append(pred)
    bagged = reduce(Column.__add__, preds) / len(preds)
    return scored.select(id_col, split_col, fold_col, "label", bagged.alias(name))


def multiclass_oof(
    df: DataFrame, id_col: str, classes: int, folds: int = 5, fold_col: str = "fold", split_col: str = "split",
    early_stopping: bool = False, **params,
) -> DataFrame:
    """(id, split, fold, label, p0 ... , pred): probability of each class ``0 .. classes - 1``
    out of fold, by one boosted model per class and fold, scaled to sum 1, and the likeliest class."""
    rows = dealt(cut_lineage(df.select(id_col, split_col, fold_col, "label", "features")))
    scored, shares = rows, []
    for c in range(classes):
        one = rows.withColumn("label", (F.col("label") == c).cast("double"))
        make = lambda: make_estimator("gbt_class", **params)
        models = fit_folds(one, make, folds, fold_col, split_col, early_stopping=early_stopping)
        scored, share = _score_folds(scored, models, f"c{c}", fold_col, split_col, True)
        shares.append(share)
    scored = scored.select(id_col, split_col, fold_col, "label", F.array(*shares).alias("__all"))
    total = F.aggregate("__all", F.lit(0.0), lambda a, v: a + v)
    parts = {f"p{c}": F.get("__all", F.lit(c)) / total for c in range(classes)}
    return scored.withColumns(parts | {"pred": argmax(F.col("__all"))}).drop("__all")


def importance(models: list, names: list[str], spark) -> DataFrame:
    """(feature, importance) summed over fitted tree models."""
    total = np.sum([m.featureImportances.toArray() for m in models], axis=0)
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, total)], "name string, importance double")


# ---- losses ---------------------------------------------------------------------------


def _grouped(df: DataFrame, by: str | None, value: Column, name: str) -> DataFrame:
    grouped = df.groupBy(by) if by else df
    return grouped.agg(value.alias(name))


def clip_rmse(df: DataFrame, y: str, p: str, by: str | None = None) -> DataFrame:
    err = F.col(y) - clip(F.col(p))
    return _grouped(df, by, F.sqrt(F.avg(err * err)), "rmse")


def log_loss(df: DataFrame, y: str, p: str, by: str | None = None) -> DataFrame:
    q = clip(F.col(p), 1e-15, 1 - 1e-15)
    return _grouped(df, by, -F.avg(F.col(y) * F.log(q) + (1 - F.col(y)) * F.log(1 - q)), "log_loss")


def grid_search(
    df: DataFrame, kind: str, grid: dict[str, list], id_col: str, folds: int = 5, loss: Column | None = None, **fixed
) -> DataFrame:
    """(param, val_loss_mean, val_loss_std) over folds for every parameter combination.

    ``loss`` is an aggregate over ``label`` and ``pred``; clipped RMSE by default.
    """
    err = F.col("label") - clip(F.col("pred"))
    loss = F.sqrt(F.avg(err * err)) if loss is None else loss
    parts = []
    for values in product(*grid.values()):
        params = dict(zip(grid, values))
        scored = oof_predict(df, kind, id_col, folds=folds, **fixed, **params)
        per_fold = scored.filter("split = 'train' AND label IS NOT NULL").groupBy("fold").agg(loss.alias("loss"))
        parts.append(per_fold.agg(F.lit(str(params)).alias("param"), F.avg("loss").alias("val_loss_mean"),
                                  F.stddev_pop("loss").alias("val_loss_std")))
    return reduce(DataFrame.unionByName, parts)


def best_param(results: DataFrame) -> DataFrame:
    return results.orderBy("val_loss_mean", "param").limit(1)


# ---- auxiliary predictions --------------------------------------------------------------


def predict_targets(
    source: DataFrame, target: DataFrame, kinds: dict[str, tuple[str, dict]], cat_cols: list[str], num_cols: list[str], key: str,
    min_prob: float = 0.0,
) -> DataFrame:
    """(key, prediction ``<y>_pred`` of each y of ``kinds``) for every row of ``target``, known or not.

    ``kinds`` names the learner and its parameters for each y, fitted on the rows of
    ``source`` that have it, from the other columns.  Numbers are regressed; with a learner of
    CLASSIFIERS the classes are the sorted codes of y, and one below ``min_prob`` is
    not accepted.  Categories are coded once, over both tables.
    """
    cols = list(dict.fromkeys([key, *cat_cols, *num_cols, *kinds]))
    both = source.select(*cols).withColumn("__src", F.lit(1)).unionByName(target.select(*cols).withColumn("__src", F.lit(0)))
    coded = dealt(cut_lineage(label_encode(both, cat_cols, "__code")))
    scored = coded.filter("__src = 0")
    for y, (kind, params) in kinds.items():
        inputs = [f"{c}__code" for c in cat_cols if c != y] + [c for c in num_cols if c != y]
        known, name, kept = coded.filter((F.col("__src") == 1) & F.col(y).isNotNull()), f"{y}_pred", scored.columns
        if kind not in CLASSIFIERS:
            model = make_estimator(kind, **params).fit(assemble(known, inputs, y))
            scored = model.transform(assemble(scored, inputs, y)).select(*kept, F.col("prediction").alias(name))
            continue
        labelled = dealt(cut_lineage(label_encode(known, [y], "__class")))
        # a forest counts at most 100 classes by itself
        last = labelled.agg(F.max(f"{y}__class")).first()[0] or 0
        classes = {"ml_attr": {"type": "nominal", "name": "label", "num_vals": last + 1}}
        model = make_estimator(kind, **params).fit(assemble(labelled, inputs, f"{y}__class").withMetadata("label", classes))
        codes = labelled.groupBy(F.col(f"{y}__class").alias("__k")).agg(F.first(F.col(y).cast("string")).alias(name))
        if min_prob <= 0:  # the class is the model's own choice, so no row carries a number for each class
            model = model.copy({model.getParam(c): "" for c in ("probabilityCol", "rawPredictionCol") if model.hasParam(c)})
        rows = model.transform(assemble(scored.withColumn("__none", F.lit(None).cast("double")), inputs, "__none"))
        chosen = (accept_class(vector_to_array("probability"), min_prob) if min_prob > 0 else F.col("prediction").cast("int")).alias("__k")
        # written once: the join reads its rows more than once, and each time they would pass all models so far
        scored = attach(cut_lineage(rows.select(*kept, chosen)), codes, "__k").drop("__k")
    return scored.select(key, *[f"{y}_pred" for y in kinds])


def predict_missing(
    source: DataFrame, target: DataFrame, kind: str, y: str, cat_cols: list[str], num_cols: list[str], key: str,
    min_prob: float | None = None, **params,
) -> DataFrame:
    """``predict_targets`` of one column."""
    return predict_targets(source, target, {y: (kind, params)}, cat_cols, num_cols, key, min_prob or 0.0)


# ---- stacking and blending ----------------------------------------------------------------


def meta_table(preds: DataFrame, id_col: str, groups: dict[str, list[str]]) -> DataFrame:
    """Long (id, model, pred) to one float column per model, with statistics per group."""
    models = [m for names in groups.values() for m in names]
    wide = preds.groupBy(id_col).agg(
        *[F.max(F.when(F.col("model") == m, F.col("pred"))).cast("float").alias(m) for m in models]
    )
    for group, names in groups.items():
        wide = row_stats(wide, names, f"{group}_")
    return wide


def bag_seeds(preds: DataFrame, keys: list[str]) -> DataFrame:
    """Average of (id, ..., seed, pred) over seeds."""
    return preds.groupBy(*keys).agg(F.avg("pred").alias("pred"))


def blend(df: DataFrame, weights: dict[str, float], name: str = "pred") -> DataFrame:
    return df.withColumn(name, reduce(Column.__add__, [F.col(c) * float(w) for c, w in weights.items()]))


def weight_grid(spark, cols: list[str], steps: int, smallest: int = 1) -> DataFrame:
    """All weights that are multiples of 1/steps, at least smallest/steps, and sum to 1."""
    k, base = len(cols), steps + 1
    ids = spark.range(base ** (k - 1))
    digits = [F.expr(f"CAST(id DIV {base ** (k - 2 - j)} AS BIGINT) % {base}") for j in range(k - 1)]
    grid = ids.select("id", *[d.alias(f"w{j}") for j, d in enumerate(digits)])
    rest = F.lit(steps) - reduce(Column.__add__, [F.col(f"w{j}") for j in range(k - 1)])
    grid = grid.withColumn(f"w{k - 1}", rest)
    for j in range(k):
        grid = grid.filter(F.col(f"w{j}") >= smallest)
    return grid.select("id", *[(F.col(f"w{j}") / steps).alias(c) for j, c in enumerate(cols)])


def _moments(df: DataFrame, y: str, cols: list[str], flag: Column) -> dict[bool, tuple[float, np.ndarray]]:
    """Per value of ``flag``: rows, and the sums of products of (y, predictions)."""
    names = [y, *cols]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]
    out = {v: (0.0, np.zeros((len(names), len(names)))) for v in (True, False)}
    for row in df.groupBy(flag.alias("flag")).agg(F.count(F.lit(1)), *sums).collect():
        m = np.zeros((len(names), len(names)))
        for (i, j), v in zip(pairs, row[2:]):
            m[i, j] = m[j, i] = v
        out[row[0]] = (float(row[1]), m)
    return out


def _squared_error(m: np.ndarray, cols: list[str]) -> Column:
    """Sum of (y - w.p)^2 as a quadratic in the weight columns."""
    total = F.lit(float(m[0, 0]))
    for i, a in enumerate(cols, 1):
        total = total - F.col(a) * float(2 * m[0, i])
        for j, b in enumerate(cols, 1):
            if j >= i:
                total = total + F.col(a) * F.col(b) * float(m[i, j] * (1 if i == j else 2))
    return total


CHUNK = 20_000


def _clipped_error(df: DataFrame, y: str, cols: list[str], weights: np.ndarray) -> np.ndarray:
    """Clipped squared error of every weight vector; each task returns partial sums."""
    out = np.zeros(len(weights))
    for start in range(0, len(weights), CHUNK):
        part = weights[start : start + CHUNK]

        def partial(batches, part=part):
            total = np.zeros(len(part))
            for b in batches:
                p, t = b[cols].to_numpy(float), b[y].to_numpy(float)
                for at in range(0, len(p), 256):
                    mixed = np.clip(p[at : at + 256] @ part.T, 0.0, 1.0)
                    total += ((t[at : at + 256, None] - mixed) ** 2).sum(0)
            yield pd.DataFrame({"i": np.arange(len(part)), "s": total})

        sums = df.select(y, *cols).mapInPandas(partial, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
        for r in sums.collect():
            out[start + r.i] = r.s
    return out


def _usable(df: DataFrame, y: str, cols: list[str]) -> DataFrame:
    return df.select(y, *cols).dropna()


def blend_scores(df: DataFrame, y: str, cols: list[str], steps: int, smallest: int = 1) -> DataFrame:
    """(weights, clipped RMSE) of every point of a small grid."""
    if comb(steps + len(cols) - 1, len(cols) - 1) > 10 * CHUNK:
        raise ValueError("use blend_search for a grid of this size")
    rows = _usable(df, y, cols).persist()
    grid = weight_grid(df.sparkSession, cols, steps, smallest).orderBy("id").collect()
    weights = np.array([[r[c] for c in cols] for r in grid])
    scores = np.sqrt(_clipped_error(rows, y, cols, weights) / rows.count())
    rows.unpersist()
    data = [(*[float(v) for v in w], float(s)) for w, s in zip(weights, scores)]
    return df.sparkSession.createDataFrame(data, ", ".join(f"{c} double" for c in [*cols, "rmse"]))


def blend_search(df: DataFrame, y: str, cols: list[str], steps: int = 100, smallest: int = 1) -> DataFrame:
    """Best weights on the grid by clipped RMSE (first on ties), without pairing rows and weights.

    Where all predictions lie in [0, 1] a blend needs no clipping, and its error is a
    quadratic in the weights with coefficients from one aggregation.  For the other
    rows zero bounds the clipped error from below, and the unclipped quadratic from above
    if the target lies in [0, 1].  Weights stay a table in the order of their lower
    bound; blocks of ``CHUNK`` are evaluated with clipping, over those rows alone, until
    the next bound passes the best error found.  The driver holds one block.
    """
    rows = _usable(df, y, cols).persist()
    inside = reduce(Column.__and__, [F.col(c).between(0.0, 1.0) for c in cols])
    moments = _moments(rows, y, cols, inside)
    (n_in, m_in), (n_out, m_out) = moments[True], moments[False]
    ends = rows.agg(F.min(y).alias("low"), F.max(y).alias("high")).first()
    grid = weight_grid(df.sparkSession, cols, steps, smallest)
    low = _squared_error(m_in, cols)
    scored = grid.select("id", *cols, low.alias("low"), (low + _squared_error(m_out, cols)).alias("high"))
    # rounding of the quadratic must not lose the best point
    slack = 1e-9 * (float(m_in[0, 0] + m_out[0, 0]) + 1.0)
    if ends.low is not None and 0 <= ends.low and ends.high <= 1:
        scored = scored.filter(F.col("low") <= scored.agg(F.min("high")).scalar() + slack)
    left = cut_lineage(scored.select("id", *cols, "low"))
    outside = rows.filter(~inside)
    best, bound, last = None, float("inf"), None
    while True:
        after = F.lit(True) if last is None else (F.col("low") > last.low) | ((F.col("low") == last.low) & (F.col("id") > last.id))
        block = left.filter(after & (F.col("low") <= bound + slack)).orderBy("low", "id").limit(CHUNK).collect()
        if not block:
            break
        weights = np.array([[r[c] for c in cols] for r in block])
        error = np.array([r.low for r in block])
        if n_out:
            error = error + _clipped_error(outside, y, cols, weights)
        at = min(range(len(block)), key=lambda i: (error[i], block[i].id))
        if best is None or (error[at], block[at].id) < best[:2]:
            best, bound = (error[at], block[at].id, weights[at]), float(error[at])
        last = block[-1]
    rows.unpersist()
    score = float(np.sqrt(max(best[0], 0.0) / max(n_in + n_out, 1)))
    data = [(*[float(v) for v in best[2]], score)]
    return df.sparkSession.createDataFrame(data, ", ".join(f"{c} double" for c in [*cols, "rmse"]))
