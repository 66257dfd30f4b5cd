"""Features of many keys in one join, and quantiles by narrowing, against plain Python and plans."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.operators import encode, group
from featloom.operators import models as mo
from featloom.operators import vectorize as vec
from featloom.plans import skew
from featloom.plans.fusion import Spec
from featloom.plans.selection import values_at


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    out = []
    for i in range(600):
        user = "hot" if rng.random() < 0.4 else None if rng.random() < 0.1 else f"u{rng.randrange(120)}"
        out.append((i, user, rng.choice(["a", "b", None]), rng.randrange(40), rng.random(), date(2024, 1, 1 + i % 28)))
    return spark.createDataFrame(out, "id long, user string, kind string, code int, x double, day date").repartition(3), out


def feature_rows(df, keys):
    return group.group_features(df, [Spec((k,), "x", a) for k in keys for a in ("mean", "count", "max")])


@pytest.mark.parametrize("heavy", [1000, 5])
def test_many_keys_equal_one_by_one(rows, monkeypatch, heavy):
    """With five broadcast rows most keys travel; with a thousand none does."""
    monkeypatch.setattr(skew, "HEAVY_PARTS", heavy)
    df, data = rows
    specs = [Spec((k,), "x", a) for k in ("user", "kind", "code", "day") for a in ("mean", "nunique", "sum")]
    specs += [Spec(("user", "kind"), "code", "max"), Spec(("kind",), "day", "max"), Spec(("user",), "code", "sum")]
    got = {r.id: r.asDict() for r in group.group_features(df, specs).collect()}
    assert len(got) == len(data)
    for i, user, kind, code, x, day in data:
        for name, at, value in (("user", 1, user), ("kind", 2, kind), ("code", 3, code), ("day", 5, day)):
            mine = [r[4] for r in data if r[at] == value] if value is not None else None
            found = got[i][f"{name}_mean_x"], got[i][f"{name}_nunique_x"]
            assert found == ((pytest.approx(sum(mine) / len(mine)), len(set(mine))) if mine else (None, None))
        both = [r[3] for r in data if (r[1], r[2]) == (user, kind)] if user and kind else None
        assert got[i]["user_kind_max_code"] == (max(both) if both else None)
        assert got[i]["kind_max_day"] == (max(r[5] for r in data if r[2] == kind) if kind else None)
        assert got[i]["user_sum_code"] == (sum(r[3] for r in data if r[1] == user) if user else None)


def test_rows_of_equal_content_stay_apart(spark):
    df = spark.createDataFrame([("a", 1, 1.0)] * 5 + [("b", 2, 2.0)], "k string, l int, x double")
    out = group.group_features(df, [Spec(("k",), "x", "count"), Spec(("l",), "x", "mean")]).collect()
    assert sorted((r.k, r.k_count_x, r.l_mean_x) for r in out) == [("a", 5, 1.0)] * 5 + [("b", 1, 2.0)]


def exchanges(df):
    """Shuffles by hash outside the aggregates of the single keys."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    wide = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("__row"), sum("__row" in line or "h1" in line for line in wide.splitlines() if "Exchange hashpartitioning" in line)


def test_exchanges_of_rows_do_not_grow_with_the_keys(rows, spark):
    df, _ = rows
    df = df.withColumns({f"k{i}": F.col("code") % (i + 2) for i in range(8)})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few, many = (exchanges(feature_rows(df, [f"k{i}" for i in range(n)]))[1] for n in (2, 8))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < many == few


# quantiles


def test_quantiles_of_several_columns(spark):
    rng = np.random.default_rng(2)
    heavy = np.exp(rng.normal(size=3000) * 6)  # nearly all values in the first of equal cells
    ties = rng.integers(0, 4, 3000).astype(float)
    near = 1e9 + rng.random(3000) * 1e-6
    data = [(float(a), float(b) if i % 7 else None, float(c), None) for i, (a, b, c) in enumerate(zip(heavy, ties, near))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(4)
    probs = [0.0, 0.013, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = values_at(df, probs={n: probs for n in "abcd"})
    for n, column in zip("abc", zip(*data)):
        have = [v for v in column if v is not None]
        assert got[n] == pytest.approx(np.quantile(have, probs).tolist(), rel=1e-12)
    assert got["d"] == [None] * 7
    ranks = sorted(heavy.tolist())
    assert values_at(df, ranks={"a": [0, 1, 1500, 2999]})["a"] == [ranks[i] for i in (0, 1, 1500, 2999)]


def test_quantiles_of_odd_numbers(spark):
    values = [-math.inf, -1e308, -1e308, 5e-324, 0.0, 1e-320, 1e308, math.inf, math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values + [None]], "v double")
    got = values_at(df, ranks={"v": list(range(10))})["v"]
    assert got[:9] == sorted(values[:9]) and math.isnan(got[9])
    assert values_at(df.filter("v IS NULL"), probs={"v": [0.5]}) == {"v": [None]}
    assert encode.edges_of(df.filter("v = 0"), "v", [4]) == {4: [0.0]}


# blocks and blends


def test_blocks_become_one_vector(spark):
    rows = spark.createDataFrame([(1, "x", 2.0), (2, None, None), (3, "y", 0.5)], "id long, kind string, p double")
    text = spark.createDataFrame([(1, "word", 0.3), (3, "kind=x", 0.7)], "id long, term string, w double")
    blocks = {"t": text, "c": vec.category_block(rows, "id", ["kind"]), "n": vec.number_block(rows, "id", ["p"])}
    found = {r.id: r.features.toArray().tolist() for r in vec.block_features(rows, "id", blocks).collect()}
    # columns c:kind=x, c:kind=y, n:p, t:kind=x, t:word
    assert found == {1: [1, 0, 2.0, 0, 0.3], 2: [0] * 5, 3: [0, 1, 0.5, 0.7, 0]}


@pytest.mark.parametrize("scale", [1.0, 3.0])
@pytest.mark.parametrize("chunk", [20_000, 7])
def test_blend_search_equals_every_weight(spark, monkeypatch, scale, chunk):
    """Also with a target outside [0, 1], where clipping can add to the error."""
    monkeypatch.setattr(mo, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    y = rng.random(200) * scale
    p = np.stack([y + rng.normal(size=200) * s for s in (0.3, 0.4, 0.5, 0.6)], axis=1)
    df = spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(y, p)], "y double, a double, b double, c double, d double")
    got = mo.blend_search(df, "y", list("abcd"), 10).first()
    grid = [(i, j, k, 10 - i - j - k) for i in range(1, 8) for j in range(1, 9 - i) for k in range(1, 10 - i - j)]
    errors = [np.sqrt(((y - np.clip(p @ (np.array(g) / 10), 0, 1)) ** 2).mean()) for g in grid]
    assert got.rmse == pytest.approx(min(errors), abs=1e-9)


def test_signed_presence_adds_signs(spark):
    terms = [(1, f"t{i}", 3) for i in range(400)]
    tc = spark.createDataFrame(terms, "id long, term string, n long")
    plain = {r.bucket: r.w for r in vec.hash_terms(tc.withColumn("n", F.lit(1)), "id", 16, signed=True).collect()}
    both = {r.bucket: r.w for r in vec.hash_terms(tc, "id", 16, signed=True, binary=True).collect()}
    assert both == {b: float(np.sign(w)) for b, w in plain.items()} and min(both.values()) < 0


def test_strings_have_no_histogram(spark):
    with pytest.raises(TypeError):
        group.histogram(spark.createDataFrame([("a",)], "s string"), "s", 3)
