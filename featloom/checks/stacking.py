"""Folds, losses, meta tables, blending, and the streamed ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded, text_date
from featloom.functions import columns as fx
from featloom.operators import models as mo
from featloom.operators import setops
from featloom.streaming import daily


@check(
    "fold_assignment_o1",
    "SELECT o_orderkey, CAST(((o_orderkey % 1000003) * 31 + 7) % 10 AS INT) AS fold FROM orders",
)
def _(t):
    return mo.assign_folds(t.orders.select("o_orderkey"), "o_orderkey", 10, seed=7)


def _linear_sql(alpha, digits=5):
    pred = "SUM(CASE WHEN split = 'train' THEN (CASE WHEN m.fold = r.fold THEN a * x + b ELSE 0 END) ELSE (a * x + b) / 5 END)"
    return f"""WITH r AS (SELECT item_id, split, CAST(fold AS INT) AS fold, y, COALESCE(price, -1) AS x FROM items),
    f AS (SELECT unnest([0, 1, 2, 3, 4]) AS fold),
    s AS (SELECT f.fold, AVG(x) AS mx, AVG(y) AS my, covar_pop(y, x) * COUNT(*) AS sxy, var_pop(x) * COUNT(*) AS sxx FROM r JOIN f ON r.fold <> f.fold
      WHERE split = 'train' AND y IS NOT NULL GROUP BY 1),
    m AS (SELECT fold, sxy / (sxx + {alpha}) AS a, my - mx * sxy / (sxx + {alpha}) AS b FROM s)
    SELECT item_id, {R(pred, 'pred', digits) if digits else pred + ' AS pred'}
    FROM r, m GROUP BY item_id"""


def _one_feature(t):
    return mo.assemble(t.items.select("item_id", "split", F.col("fold").cast("int").alias("fold"), "price", "y"), ["price"], "y")


@check("oof_linear_o2_o6", _linear_sql("0"), ("items",))
def _(t):
    return rounded(mo.oof_predict(_one_feature(t), "linear", "item_id").select("item_id", "pred"), "pred", digits=5)


@check("oof_ridge_o3", _linear_sql("1e14"), ("items",))
def _(t):
    out = mo.oof_predict(_one_feature(t), "ridge", "item_id", alpha=1e14)
    return rounded(out.select("item_id", "pred"), "pred", digits=5)


@check(
    "clipped_rmse_o8",
    f"""SELECT CAST(fold AS VARCHAR) AS fold, {R('sqrt(AVG(pow(y - LEAST(GREATEST(3 * p1 - 0.8, 0), 1), 2)))', 'rmse')} FROM preds GROUP BY 1
    UNION ALL SELECT 'all', {R('sqrt(AVG(pow(y - LEAST(GREATEST(3 * p1 - 0.8, 0), 1), 2)))', 'rmse')} FROM preds""",
    ("preds",),
)
def _(t):
    df = t.preds.withColumn("p", F.col("p1") * 3 - 0.8)
    per_fold = mo.clip_rmse(df, "y", "p", "fold").withColumn("fold", F.col("fold").cast("string"))
    overall = mo.clip_rmse(df, "y", "p").withColumn("fold", F.lit("all"))
    return rounded(per_fold.unionByName(overall), "rmse")


@check(
    "accepted_class_o12",
    """WITH a AS (SELECT vec_id, list_transform(embedding[1:12], lambda v: abs(CAST(v AS DOUBLE))) AS f FROM embeddings)
    SELECT vec_id, CAST(CASE WHEN list_max(f) > 0.25 THEN list_position(f, list_max(f)) - 1 END AS INT) AS cls FROM a""",
)
def _(t):
    probs = F.transform(F.slice("embedding", 1, 12), lambda v: F.abs(v.cast("double")))
    return t.embeddings.select("vec_id", fx.accept_class(probs, 0.25).alias("cls"))


@check(
    "meta_table_o13",
    f"""SELECT item_id, {R('m1', 'm1', 4)}, {R('m2', 'm2', 4)}, {R('m3', 'm3', 4)}, {R('(m1 + m2) / 2', 'rg_mean', 4)}, {R('GREATEST(m1, m2)', 'rg_max', 4)}, {R('m3', 'lr_mean', 4)} FROM
    (SELECT item_id, CAST(CAST(p1 AS FLOAT) AS DOUBLE) AS m1, CAST(CAST(p2 AS FLOAT) AS DOUBLE) AS m2, CAST(CAST(p3 AS FLOAT) AS DOUBLE) AS m3 FROM preds)""",
    ("preds",),
)
def _(t):
    long = setops.union_all(
        [t.preds.select("item_id", F.lit(m).alias("model"), F.col(p).alias("pred")) for m, p in (("m1", "p1"), ("m2", "p2"), ("m3", "p3"))]
    )
    out = mo.meta_table(long, "item_id", {"rg": ["m1", "m2"], "lr": ["m3"]})
    keep = ["m1", "m2", "m3", "rg_mean", "rg_max", "lr_mean"]
    return rounded(out.select("item_id", *[F.col(c).cast("double").alias(c) for c in keep]), *keep, digits=4)


ALPHAS = [1e12, 1e14, 1e16]


@check(
    "parameter_grid_o9",
    " UNION ALL ".join(
        f"""SELECT '{{''alpha'': {a}}}' AS param, {R('AVG(loss)', 'val_loss_mean')}, {R('stddev_pop(loss)', 'val_loss_std')} FROM
        (SELECT i.fold, sqrt(AVG(pow(i.y - LEAST(GREATEST(pred, 0), 1), 2))) AS loss FROM ({_linear_sql(a, digits=None)}) p JOIN items i USING (item_id)
        WHERE split = 'train' AND y IS NOT NULL GROUP BY 1)"""
        for a in ALPHAS
    ),
    ("items",),
)
def _(t):
    out = mo.grid_search(_one_feature(t), "ridge", {"alpha": ALPHAS}, "item_id")
    return rounded(out, "val_loss_mean", "val_loss_std")


def _stack_sql(alpha):
    """Ridge over two predictions out of fold, the 2 x 2 normal equations solved in SQL."""
    return f"""WITH r AS (SELECT item_id, CAST(fold AS INT) AS fold, y, p1, p3 FROM preds),
    f AS (SELECT unnest([0, 1, 2, 3, 4]) AS fold),
    s AS (SELECT f.fold, AVG(p1) AS ma, AVG(p3) AS mb, AVG(y) AS my, var_pop(p1) * COUNT(*) + {alpha} AS saa, var_pop(p3) * COUNT(*) + {alpha} AS sbb,
      covar_pop(p1, p3) * COUNT(*) AS sab, covar_pop(p1, y) * COUNT(*) AS say, covar_pop(p3, y) * COUNT(*) AS sby FROM r JOIN f ON r.fold <> f.fold GROUP BY 1),
    m AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS a, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS b FROM s)
    SELECT item_id, {R('my + a * (p1 - ma) + b * (p3 - mb)', 'pred', 5)} FROM r JOIN m USING (fold)"""


@check("second_level_stack_o14", _stack_sql(1.0), ("preds",))
def _(t):
    rows = t.preds.withColumn("split", F.lit("train")).withColumn("fold", F.col("fold").cast("int"))
    stacked = mo.oof_predict(mo.assemble(rows, ["p1", "p3"], "y"), "ridge", "item_id", alpha=1.0)
    return rounded(stacked.select("item_id", "pred"), "pred", digits=5)


@check(
    "seed_bagging_o15",
    f"SELECT item_id, {R('(p1 + p2 + p3) / 3', 'pred')} FROM preds",
    ("preds",),
)
def _(t):
    seeded = setops.union_all([t.preds.select("item_id", F.lit(s).alias("seed"), F.col(p).alias("pred")) for s, p in ((411, "p1"), (519, "p2"), (719, "p3"))])
    return rounded(mo.bag_seeds(seeded, ["item_id"]), "pred")


GRID = """WITH w AS (SELECT a / {n}.0 AS w1, b / {n}.0 AS w2, ({n} - a - b) / {n}.0 AS w3 FROM range(1, {n}) t(a), range(1, {n}) u(b) WHERE a + b < {n}),
s AS (SELECT w1, w2, w3, sqrt(AVG(pow(y - LEAST(GREATEST(w1 * q1 + w2 * q2 + w3 * q3, 0), 1), 2))) AS rmse FROM
  (SELECT y, {k} * p1 - {o} AS q1, {k} * p2 - {o} AS q2, {k} * p3 - {o} AS q3 FROM preds), w GROUP BY 1, 2, 3)"""


@check(
    "weight_grid_scores_j8",
    GRID.format(n=10, k=3, o=0.8) + f" SELECT {R('w1', 'q1')}, {R('w2', 'q2')}, {R('w3', 'q3')}, {R('rmse', 'rmse')} FROM s",
    ("preds",),
)
def _(t):
    df = t.preds.select("y", *[(F.col(f"p{i}") * 3 - 0.8).alias(f"q{i}") for i in (1, 2, 3)])
    return rounded(mo.blend_scores(df, "y", ["q1", "q2", "q3"], 10), "q1", "q2", "q3", "rmse")


@check(
    "blend_search_o16",
    GRID.format(n=50, k=3, o=0.8) + f" SELECT {R('w1', 'q1')}, {R('w2', 'q2')}, {R('w3', 'q3')}, {R('rmse', 'rmse')} FROM s ORDER BY s.rmse, w1, w2 LIMIT 1",
    ("preds",),
)
def _(t):
    df = t.preds.select("y", *[(F.col(f"p{i}") * 3 - 0.8).alias(f"q{i}") for i in (1, 2, 3)])
    return rounded(mo.blend_search(df, "y", ["q1", "q2", "q3"], 50), "q1", "q2", "q3", "rmse")


FIVE = {"q1": "p1", "q2": "p2 * 2 - 0.4", "q3": "p3", "q4": "p1 * p2 * 2", "q5": "1.2 - p3"}


@check(
    "five_model_blend_o16",
    f"""WITH w AS (SELECT a / 20.0 AS w1, b / 20.0 AS w2, c / 20.0 AS w3, d / 20.0 AS w4, (20 - a - b - c - d) / 20.0 AS w5
      FROM range(1, 20) t(a), range(1, 20) u(b), range(1, 20) v(c), range(1, 20) x(d) WHERE a + b + c + d < 20),
    r AS (SELECT y, {', '.join(f'{e} AS {n}' for n, e in FIVE.items())} FROM preds),
    s AS (SELECT w1, w2, w3, w4, w5, sqrt(AVG(pow(y - LEAST(GREATEST(w1 * q1 + w2 * q2 + w3 * q3 + w4 * q4 + w5 * q5, 0), 1), 2))) AS rmse FROM r, w GROUP BY ALL)
    SELECT {', '.join(R(f'w{i}', f'q{i}') for i in range(1, 6))}, {R('rmse', 'rmse')} FROM s ORDER BY s.rmse, w1, w2, w3, w4 LIMIT 1""",
    ("preds",),
)
def _(t):
    df = t.preds.select("y", *[F.expr(e).alias(n) for n, e in FIVE.items()])
    return rounded(mo.blend_search(df, "y", list(FIVE), 20), *FIVE, "rmse")


@check("fixed_blend_o17", f"SELECT item_id, {R('0.5 * p1 + 0.3 * p2 + 0.2 * p3', 'pred')} FROM preds", ("preds",))
def _(t):
    return rounded(mo.blend(t.preds, {"p1": 0.5, "p2": 0.3, "p3": 0.2}).select("item_id", "pred"), "pred")


@check(
    "log_loss_o18",
    f"""SELECT fold, {R('-AVG(b * ln(q) + (1 - b) * ln(1 - q))', 'log_loss')} FROM
    (SELECT fold, CAST(y > 0.5 AS INT) AS b, LEAST(GREATEST(p3, 1e-15), 1 - 1e-15) AS q FROM preds) GROUP BY 1""",
    ("preds",),
)
def _(t):
    df = t.preds.withColumn("b", fx.binarize(F.col("y")))
    return rounded(mo.log_loss(df, "b", "p3", "fold"), "log_loss")


@check(
    "streamed_daily_stats_s1",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS n, {R('AVG(CASE WHEN value >= 0 THEN value END)', 'mean_value', 4)}, MAX(CASE WHEN value >= 0 THEN value END) AS max_value FROM events GROUP BY 1""",
)
def _(t):
    rows = daily.read_files(t.spark, t.folder, t.events.schema, "events.parquet")
    table = daily.stream_stats(t.spark, daily.daily_stats(rows, "ts", "value", "user_id"))
    return rounded(text_date(table, "day"), "mean_value", digits=4)
