"""Ridge with coefficients in Spark, against the normal equations."""

import numpy as np
import pytest

from featloom.checks import load, registry
from featloom.operators import models as mo
from featloom.operators.block_ridge import ridge_oof

FOLDS, ALPHA = 3, 2.5


def solved(x, y):
    centred = x - x.mean(0)
    w = np.linalg.solve(centred.T @ centred + ALPHA * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    return y.mean() - x.mean(0) @ w, w


def test_predictions_solve_the_normal_equations(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((45, 9)) < 0.4, rng.normal(size=(45, 9)) + 1, 0.0)
    x[5] = 0.0  # no cell
    at = [*range(45), 7, 7]  # an id three times
    fold = [i % FOLDS for i in at]
    split = ["test" if i % 6 == 1 and n < 45 else "train" for n, i in enumerate(at)]
    y = [None if n % 11 == 3 else float(v) for n, v in enumerate(rng.normal(size=47))]
    rows = spark.createDataFrame([(i, split[n], fold[n], y[n]) for n, i in enumerate(at)] + [(None, "train", 0, 9.0)], "id long, split string, fold int, label double")
    cells = [(int(i), f"t{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x))] + [(None, "t1", 3.0), (99, "other", 2.0)]
    got = ridge_oof(rows, spark.createDataFrame(cells, "id long, term string, w double"), "id", alpha=ALPHA, folds=FOLDS, tol=1e-10).collect()
    want = []
    for f in range(FOLDS):
        used = [n for n in range(47) if split[n] == "train" and y[n] is not None and fold[n] != f]
        bias, w = solved(x[[at[n] for n in used]], np.array([y[n] for n in used]))
        want.append(bias + x[at] @ w)
    want = np.array(want)
    expected = sorted((at[n], split[n], want[fold[n], n] if split[n] == "train" else want[:, n].mean()) for n in range(47))
    assert [(r.id, r.split) for r in sorted(got, key=lambda r: (r.id, r.split, r.pred))] == [e[:2] for e in expected]
    assert sorted(r.pred for r in got) == pytest.approx(sorted(e[2] for e in expected), abs=1e-7)


@pytest.mark.parametrize("name", ["sparse_text_ridge_o3", "block_ridge_v9_o3"])
def test_text_ridges_keep_no_vocabulary_on_the_driver(spark, tmp_path, monkeypatch, name):
    """Spark ML's linear regression has a number for each term there; only the small first stage may use it."""
    load()
    docs = [(i, f"word{i % 4} other{i % 3} only{i}", "en", "web", 20 + i % 7) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    fit, sizes = mo.Ridge.fit, []
    monkeypatch.setattr(mo.Ridge, "fit", lambda self, df: sizes.append(len(df.first().features)) or fit(self, df))
    assert registry.QUERIES[name](spark, str(tmp_path)).count() == 60
    assert max(sizes, default=0) <= 1
