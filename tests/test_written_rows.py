"""Rows that several keys, columns or fits use are written once and dealt evenly."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featloom.operators import encode, group, models
from featloom.operators import neighbors as nb
from featloom.plans.fusion import Spec


@pytest.fixture
def source(spark, tmp_path):
    rows = [(i, f"a{i % 7}" if i % 11 else None, f"b{i % 3}", float(i)) for i in range(200)]
    folder = str(tmp_path / "rows")
    spark.createDataFrame(rows, "id long, a string, b string, x double").write.parquet(folder)
    return spark.read.parquet(folder), folder, rows


def test_features_of_many_keys_do_not_compute_the_rows_for_each(source):
    df, folder, rows = source
    out = group.group_features(df, [Spec(("a",), "x", "mean"), Spec(("b",), "x", "sum"), Spec(("a", "b"), "id", "nunique")])
    assert not any(folder in f for f in out.inputFiles())
    sums = {b: sum(r[3] for r in rows if r[2] == b) for b in ("b0", "b1", "b2")}
    assert {(r.b, r.b_sum_x) for r in out.collect()} == set(sums.items())


def test_codes_of_many_columns_do_not_compute_the_rows_for_each(source):
    df, folder, rows = source
    out = encode.label_encode(df, ["a", "b"], "_code")
    assert out.columns == [*df.columns, "a_code", "b_code"] and not any(folder in f for f in out.inputFiles())
    names = sorted({r[1] or "nan" for r in rows})
    assert {r.id: (r.a_code, r.b_code) for r in out.collect()} == {r[0]: (names.index(r[1] or "nan"), int(r[2][1])) for r in rows}
    again = encode.label_encode(df, ["a", "b"])
    assert again.columns == df.columns and dict(again.dtypes)["a"] == "int"


def test_fits_read_rows_in_splits(source, monkeypatch):
    df, _, rows = source
    monkeypatch.setattr(models, "ROWS", 20)
    seen = []
    fit = models.fit_folds
    monkeypatch.setattr(models, "fit_folds", lambda rows, *a, **b: (seen.append(rows.rdd.getNumPartitions()), fit(rows, *a, **b))[1])
    ready = models.assemble(df.withColumns({"split": F.lit("train"), "fold": (F.col("id") % 2).cast("int")}), ["x"], "x").coalesce(1)
    out = models.oof_predict(ready, "linear", "id", folds=2)
    assert seen == [10] and {r.id: round(r.pred, 3) for r in out.collect()} == {r[0]: r[3] for r in rows}


def test_folds_of_a_row_share_the_distances(monkeypatch):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (12, 4)).astype(float), rng.integers(0, 3, (60, 4)).astype(float)
    train = pd.DataFrame({"id": np.arange(60), "vec": list(y), "fold": np.arange(60) % 5.0})
    query = pd.concat([pd.DataFrame({"id": np.arange(12), "vec": list(x), "fold": float(f)}) for f in range(5)], ignore_index=True)
    compared = []
    squares = nb._squares
    monkeypatch.setattr(nb, "_squares", lambda a, b: (compared.append(len(a)), squares(a, b))[1])
    found = nb._best(query, train, 3, True)
    assert sum(compared) == len(np.unique(x, axis=0))
    for (q, f), rows in found.groupby(["query_id", "query_fold"]):
        dist = {i: float(np.sqrt(((x[q] - y[i]) ** 2).sum())) for i in range(60) if i != q and i % 5 != f}
        assert list(rows.neighbour_id) == sorted(dist, key=lambda i: (dist[i], i))[:3]
    assert len(found) == 12 * 5 * 3
