"""Neighbours, factorisations, folds, blending and the stream, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.checks import learners, load, registry
from featloom.operators import models as mo
from featloom.operators import neighbors as nb
from featloom.operators import topics
from featloom.streaming import daily


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(240):
        grp = 0 if i % 3 else 1 + i % 5
        centre = (i % 4) * 10
        vec = (rng.normal(size=3) + centre).tolist() if i % 10 else [1.0, 1.0, 1.0]  # a group of copies
        data.append((i, grp, i % 5, "train" if i % 4 else "test", vec, float(i)))
    return spark.createDataFrame(data, "id long, grp int, fold int, split string, v array<double>, x double"), data


def brute(train, queries, k, same_fold=True):
    out = set()
    for q in queries:
        near = sorted(
            (math.dist(q[4], t[4]), t[0]) for t in train if t[1] == q[1] and t[0] != q[0] and (same_fold or t[2] != q[2])
        )[:k]
        out |= {(q[0], r, n, round(d, 9)) for r, (d, n) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("cell_rows,block_rows,max_pivots", [(20_000, 4096, 1024), (10, 7, 1024), (10, 7, 4)])
@pytest.mark.parametrize("fold", [None, "fold"])
def test_knn_equals_brute_force(points, cell_rows, block_rows, max_pivots, fold, monkeypatch):
    monkeypatch.setattr(nb, "MAX_PIVOTS", max_pivots)  # 4 leaves only blocked groups
    df, data = points
    train = [d for d in data if d[3] == "train"]
    out = nb.knn(df.filter("split = 'train'"), df, "id", "v", "grp", 4, True, fold, cell_rows, block_rows)
    got = {(r.query_id, r.rank, r.neighbour_id, round(r.dist, 9)) for r in out.collect()}
    assert got == brute(train, data, 4, same_fold=fold is None)


def test_toy_neighbours(spark):
    """Equal rows: every neighbour mean is a mean over the first ids."""
    rows = [(i, [0.0, 1.0, 2.0], float(i == 1), i % 5) for i in range(5)]
    train = spark.createDataFrame(rows, "id long, v array<double>, y double, fold int")
    query = spark.createDataFrame([(10 + i, [float(i < 1), float(i < 2), float(i < 3)]) for i in range(4)], "id long, v array<double>")
    near = nb.knn(train, query, "id", "v", None, 3)
    feats = {r.query_id: r for r in nb.knn_features(near, train, "id", ["y"], [2, 3]).collect()}
    assert feats[10]["y_2_closest_mean"] == 0.5 and feats[10]["y_3_closest_mean"] == pytest.approx(1 / 3)
    assert feats[10]["2_closest_avg_dist"] == pytest.approx(math.sqrt(2)) and len(feats) == 4


def test_ann_with_all_cells_is_exact(points):
    df, data = points
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    out = nb.ann(df, df, "id", "v", 3, probes=1000, exclude_self=True, cell_rows=40)
    got = {(r.query_id, r.rank): round(r.dist, 6) for r in out.collect()}
    for q in data[:20]:
        want = sorted(1 - float(unit(q[4]) @ unit(t[4])) for t in data if t[0] != q[0])[:3]
        assert [got[(q[0], r)] for r in (1, 2, 3)] == pytest.approx(want, abs=1e-6)


@pytest.fixture(scope="module")
def counts(spark):
    rnd = random.Random(1)
    data = [(d, f"t{t:02d}", float(rnd.randint(1, 5))) for d in range(40) for t in range(15) if rnd.random() < (0.9 if t == 0 else 0.3)]
    return spark.createDataFrame(data, "id long, term string, w double"), data


def dense(data):
    x = np.zeros((40, 15))
    for d, t, w in data:
        x[d, int(t[1:])] = w
    return x


def test_svd_matches_numpy(counts):
    tc, data = counts
    scores, explained = topics.svd_scores(tc, "id", "w", 3)
    got = np.zeros((40, 3))
    for r in scores.collect():
        got[r.id] = r.scores
    u, s, _ = np.linalg.svd(dense(data), full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-6)
    assert len(explained) == 3


def test_svd_of_new_rows(counts, spark):
    """Directions of all rows score a part of them, and rows with unknown terms, as numpy does."""
    tc, data = counts
    terms = topics.svd_fit(tc, "id", "w", 2)
    v = np.zeros((15, 2))
    for r in terms.collect():
        v[int(r.term[1:])] = r.f
    assert v.T @ v == pytest.approx(np.eye(2), abs=1e-9) and all(v[np.abs(v).argmax(0), [0, 1]] > 0)
    some = tc.filter("id < 5").unionByName(spark.createDataFrame([(3, "unknown", 9.0), (99, "unknown", 1.0)], tc.schema))
    got = {r.id: r.scores for r in topics.svd_transform(some, "id", "w", terms, 2, some).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 99} and got[99] == [0.0, 0.0]
    assert np.array([got[i] for i in range(5)]) == pytest.approx(dense(data)[:5] @ v)


def test_svd_of_negative_weights_and_string_ids(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12, 5))
    rows = [(f"d{i:02d}", f"t{j}", float(x[i, j])) for i in range(12) for j in range(5)]
    scores, _ = topics.svd_scores(spark.createDataFrame(rows, "id string, term string, w double"), "id", "w", 5)
    got = np.array([r.scores for r in sorted(scores.collect())])
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.abs(got) == pytest.approx(np.abs(u * s), abs=1e-6)
    assert topics.svd_scores(spark.createDataFrame([], "id string, term string, w double"), "id", "w", 2)[0].count() == 0


def test_sparse_vectors_hold_the_weights(counts):
    tc, data = counts
    vecs, size = topics.to_sparse(tc, "id", "w")
    assert size == 15
    for r in vecs.collect():
        assert r.vec.toArray().tolist() == dense(data)[r.id].tolist()


def test_nmf_objective_never_rises(counts):
    tc, data = counts
    docs, terms, losses = topics.nmf_topics(tc, "id", "w", 3, iters=5)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    w, h = np.zeros((40, 3)), np.zeros((3, 15))
    for r in docs.collect():
        w[r.id] = r.f
    for r in terms.collect():
        h[:, int(r.term[1:])] = r.f
    assert ((dense(data) - w @ h) ** 2).sum() == pytest.approx(losses[-1], rel=1e-6)



def test_pooled_vectors(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["zz"])], "id long, t array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [4.0, 3.0])], "word string, vector array<double>")
    got = {r.id: r.pooled for r in topics.pool_vectors(df, "id", "t", vectors, 2, "std").collect()}
    assert got[1] == pytest.approx(np.std([[1, 0], [4, 3], [1, 0]], axis=0).tolist()) and got[2] == [-1.0, -1.0]


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(2)
    y = rng.random(300)
    p = np.stack([y + rng.normal(size=300) * s for s in (0.2, 0.4, 0.3)], 1)  # many outside [0, 1]
    return spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y, p)], "y double, a double, b double, c double"), y, p


def test_blend_search_equals_brute_force(preds):
    df, y, p = preds
    grid = [(i / 20, j / 20, (20 - i - j) / 20) for i in range(1, 20) for j in range(1, 20) if i + j < 20]
    scores = [math.sqrt(((y - np.clip(p @ np.array(w), 0, 1)) ** 2).mean()) for w in grid]
    best = int(np.argmin(scores))
    got = mo.blend_search(df, "y", ["a", "b", "c"], 20).first()
    assert tuple(got)[:3] == pytest.approx(grid[best]) and got.rmse == pytest.approx(scores[best])
    every = mo.blend_scores(df, "y", ["a", "b", "c"], 20)
    assert every.count() == len(grid) and every.agg(F.min("rmse")).first()[0] == pytest.approx(min(scores))


def test_single_models_on_the_grid_are_not_better(preds):
    df, y, p = preds
    got = mo.blend_search(df, "y", ["a", "b", "c"], 10, smallest=0).first().rmse
    singles = [math.sqrt(((y - np.clip(p[:, i], 0, 1)) ** 2).mean()) for i in range(3)]
    assert got <= min(singles) + 1e-12


def test_ridge_matches_normal_equations(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(80, 2))
    y = x @ [1.5, -2.0] + rng.normal(size=80)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = mo.assemble(spark.createDataFrame(rows, "p double, q double, y double"), ["p", "q"], "y")
    model = mo.make_estimator("ridge", alpha=25.0).fit(df)
    xc = x - x.mean(0)
    want = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(2), xc.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-6)


def test_boosting_beats_the_mean(spark):
    df = spark.range(400).select("id", F.floor(F.col("id") / 10 % 5).cast("int").alias("fold"), F.lit("train").alias("split"),
                                 (F.col("id") % 10).cast("double").alias("x"))
    df = mo.assemble(df.withColumn("y", F.when(F.col("x") > 4, 0.9).otherwise(0.1)), ["x"], "y")
    out = mo.oof_predict(df, "gbt", "id", maxIter=3, maxDepth=2, seed=1)
    assert mo.clip_rmse(out, "label", "pred").first()[0] < 0.2


@pytest.fixture(scope="module")
def classed(spark):
    """Class = x div 4 of x in 0..11, a tenth of the labels NULL, a seventh of the rows test rows."""
    df = spark.range(480).select(
        "id", F.floor(F.col("id") / 12 % 5).cast("int").alias("fold"), F.when(F.col("id") % 7 == 0, "test").otherwise("train").alias("split"),
        (F.col("id") % 12).cast("double").alias("x"), F.when(F.col("id") % 11 != 0, F.floor(F.col("id") % 12 / 4)).alias("y"),
    )
    return mo.assemble(df, ["x"], "y")


def test_class_probabilities_out_of_fold(classed):
    out = mo.multiclass_oof(classed, "id", 3, maxIter=3, maxDepth=2, seed=1).collect()
    assert len(out) == 480
    for r in out:
        assert r.p0 + r.p1 + r.p2 == pytest.approx(1.0)
        assert r.pred == r.id % 12 // 4 == int(np.argmax([r.p0, r.p1, r.p2]))


def test_multiclass_query_cuts_no_rounds_off(spark, monkeypatch):
    """Only the error of the left-out fold ends the boosting; a handful of flat trees is not the whole job."""
    load()
    given: dict = {}
    monkeypatch.setattr(learners, "_features", lambda t, label: None)
    monkeypatch.setattr(mo, "multiclass_oof", lambda *a, **k: given.update(k) or spark.range(1).selectExpr("id item_id", "0d p0", "0d p1", "0d p2", "0 pred"))
    registry.QUERIES["multiclass_boosting_o5"](spark, "")
    assert given["early_stopping"] and given["maxIter"] >= 20_000 and given["maxDepth"] >= 5


def test_early_stopping_with_a_fold_without_rows(classed):
    models: list = []
    rows = classed.filter("fold <> 3")
    mo.oof_predict(rows, "gbt", "id", early_stopping=True, models_out=models, maxIter=8, maxDepth=1, validationTol=0.9, seed=1)
    assert len(models) == 5 and all(m.getNumTrees < 8 for m in models)


def test_early_stopping_uses_the_left_out_fold(spark):
    """Labels without signal: few trees are added when the error of the left-out fold counts."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 5, "train", float(rng.random()), float(rng.random())) for i in range(500)]
    df = mo.assemble(spark.createDataFrame(rows, "id long, fold int, split string, x double, y double"), ["x"], "y")
    models: list = []
    out = mo.oof_predict(df, "gbt", "id", early_stopping=True, models_out=models, maxIter=15, maxDepth=4, seed=1)
    assert out.count() == 500 and len(models) == 5 and all(m.getNumTrees < 15 for m in models)


def test_every_target_of_every_row_is_predicted(spark):
    rows = [(i % 50, "pqr"[i % 3], float(i % 3) * 10, None if i % 7 == 0 else float(i % 3) * 100, None if i % 5 == 0 else "uvw"[i % 3]) for i in range(150)]
    df = spark.createDataFrame(rows, "key long, c string, x double, price double, kind string")  # each key three times
    kinds = {"price": ("gbt", {"maxIter": 3, "seed": 1}), "kind": ("forest_class", {"numTrees": 5, "seed": 1}), "c": ("forest_class", {"numTrees": 5, "seed": 1})}
    got = mo.predict_targets(df, df, kinds, ["c"], ["x"], "key").collect()
    want = {(r[0], "uvw"["pqr".index(r[1])], r[1]): r[2] * 10 for r in rows}
    assert len(got) == 150
    for r in got:
        assert r.price_pred == pytest.approx(want[r.key, r.kind_pred, r.c_pred], abs=1.0)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 20_000).alias("ts"), ((F.col("id") * 7) % 13 - 3).cast("double").alias("value"),
        F.when(F.col("id") % 11 != 0, F.col("id")).alias("user_id"),
    )
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    rows = daily.read_files(spark, str(tmp_path / "in"), df.schema)
    streamed = daily.stream_stats(spark, daily.daily_stats(rows, "ts", "value", "user_id"), str(tmp_path / "out"))
    batch = daily.daily_stats(df, "ts", "value", "user_id")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_more_than_a_hundred_classes(spark):
    rows = [(i, f"c{i % 150:03}", float(i % 150)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y string, x double")
    out = mo.predict_targets(df, df, {"y": ("forest_class", {"numTrees": 1, "maxDepth": 1, "seed": 1})}, [], ["x"], "id")
    assert out.filter("y_pred IS NOT NULL").count() == 300


def test_class_choice_reads_no_number_for_each_class(spark):
    """Rows are scored once and written; the plan that is left has no model, and no array of a number for each class."""
    rows = [(i, f"c{i % 9}", float(i % 9)) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, y string, x double")
    out = mo.predict_targets(df, df, {"y": ("forest_class", {"numTrees": 3, "seed": 1})}, [], ["x"], "id")
    assert "UDF" not in out._jdf.queryExecution().toString()
    assert sum(r.y_pred == rows[r.id][1] for r in out.collect()) > 80
