"""Factorisation machines with coefficients in Spark, against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.operators import factorisation as fm
from featloom.operators import models as mo

FOLDS, FACTORS, STEP, ROUNDS = 3, 2, 0.05, 4


def plain(x, y, start):
    """(intercept, coefficients) after ROUNDS rounds of AdamW, one row at a time."""
    n, m = x.shape
    now = np.concatenate([[0.0], np.zeros(m), start.ravel()])
    first, second = np.zeros_like(now), np.zeros_like(now)
    for i in range(1, ROUNDS + 1):
        g = np.zeros_like(now)
        for row, label in zip(x, y):
            slope = 2 * (one(now, row, m) - label)
            v = now[1 + m :].reshape(m, FACTORS)
            g[0] += slope
            g[1 : 1 + m] += slope * row
            g[1 + m :] += (slope * (row[:, None] * (row @ v)[None] - v * row[:, None] ** 2)).ravel()
        g /= n
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        now = now - STEP * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    return now


def one(now, row, m):
    v = now[1 + m :].reshape(m, FACTORS)
    return now[0] + now[1 : 1 + m] @ row + 0.5 * (((row @ v) ** 2).sum() - (row**2 @ v**2).sum())


def test_predictions_are_those_of_all_rows_at_once(spark):
    rng = np.random.default_rng(3)
    x = np.where(rng.random((40, 7)) < 0.4, rng.normal(size=(40, 7)), 0.0)
    x[5] = 0.0  # no cell
    rows = [(d, "train" if d % 4 else "test", d % FOLDS, float(rng.normal() + 2) if d % 4 else None) for d in range(40)]
    rows += [(9, "train", 0, 7.0), (None, "train", 1, 3.0)]  # an id twice, and none
    cells = [(d, f"t{j}", float(v)) for d, r in enumerate(x) for j, v in enumerate(r) if v] + [(None, "t1", 5.0), (None, "other", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, split string, fold int, label double").repartition(3)
    out = fm.fm_oof(docs, spark.createDataFrame(cells, "doc_id long, term string, w double"), "doc_id", folds=FOLDS, rounds=ROUNDS, factors=FACTORS, step=STEP, seed=4)
    terms = spark.createDataFrame([(f"t{j}",) for j in range(7)], "term string")
    start = np.array([r.v for r in terms.select("term", F.array(*[fm._normal(4, k, "term") for k in range(FACTORS)]).alias("v")).orderBy("term").collect()]) * fm.INIT
    models = []
    for f in range(FOLDS):
        mine = [r for r in rows if r[1] == "train" and r[0] is not None and r[2] != f]
        models.append(plain(np.array([x[r[0]] for r in mine]), [r[3] for r in mine], start))
    want = sorted((r[0], float(np.mean([one(m, x[r[0]], 7) for m in models]) if r[1] == "test" else one(models[r[2]], x[r[0]], 7))) for r in rows if r[0] is not None)
    found = sorted((r.doc_id, r.pred) for r in out.collect())
    assert [d for d, _ in found] == [d for d, _ in want]
    assert [p for _, p in found] == pytest.approx([p for _, p in want], abs=1e-9)


def test_start_is_normal(spark):
    z = np.array([r.z for r in spark.range(4000).select(fm._normal(1, 0, "id").alias("z")).collect()])
    assert abs(z.mean()) < 0.06 and abs(z.std() - 1) < 0.05 and abs((np.abs(z) < 1).mean() - 0.683) < 0.03


def test_no_learner_keeps_the_vocabulary_on_the_driver(spark, monkeypatch):
    """Spark ML's factorisation machine holds all coefficients on the driver."""
    from __spark_entry__ import SMOKE_DIR, queries

    def held(params):
        raise AssertionError("coefficients on the driver")

    monkeypatch.setitem(mo.KINDS, "fm", held)
    out = queries()["block_factorisation_machine_v9_o7"](spark, SMOKE_DIR)
    assert out.columns == ["doc_id", "pred"] and out.where("pred IS NULL").isEmpty()
    assert out.count() == spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").count()
