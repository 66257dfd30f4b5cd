"""The skew-proof plans give the same results as the plain ones."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from featloom.plans import prefix, skew


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None, f"k{i % 50}"])
        day = 100 if rnd.random() < 0.4 else rnd.randint(1, 300)  # one heavy day
        data.append((i, key, day, float(rnd.randint(-5, 20)) if rnd.random() > 0.1 else None))
    return spark.createDataFrame(data, "id long, key string, day int, v double")


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("include", [True, False])
def test_running_sums_in_blocks(events, keys, include):
    sums = {"s": F.col("v"), "n": F.lit(1)}
    got = prefix.running_sums(events, keys, ["day", "id"], sums, include, blocks=7)
    part = [F.col(k) for k in keys] or [F.lit(0)]
    w = Window.partitionBy(*part).orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0 if include else -1)
    want = events.select("*", *[F.sum(e).over(w).alias(n) for n, e in sums.items()])
    assert rows_of(got) == rows_of(want)


def test_heavy_day_is_cut_by_the_second_order_column(events):
    blocks = prefix.add_block(events, ["day", "id"], 8)
    sizes = [r["count"] for r in blocks.filter("day = 100").groupBy("__block").count().collect()]
    assert len(sizes) > 2
    order = Window.orderBy("day", "id")
    back = blocks.withColumn("prev", F.lag("__block").over(order)).filter("prev > __block")
    assert back.count() == 0


def test_string_order_follows_bytes(spark):
    words = ["", "a", "aa", "ab", "é", "z", "Z", "ярко", "zzzzzzzz1", "zzzzzzzz2", "日本"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: r.code for r in prefix.sorted_codes(df, "w", "code", blocks=4).collect()}
    want = {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}
    assert got == want


def test_long_common_prefixes_are_cut(spark):
    df = spark.range(20_000).selectExpr("concat('https://site/a/long/way/', lpad(id, 8, '0')) AS url")
    sizes = [r["count"] for r in prefix.add_block(df, ["url"], 16).groupBy("__block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20_000 / 16


def test_date_orders_have_few_blocks(events):
    blocks = prefix.add_block(events, ["day", "id"], 8)
    assert blocks.select("__block").distinct().count() <= 8  # the rows of the carry window


def test_exact_quantiles_in_blocks(events):
    probs = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p90": 0.9, "hi": 1.0}
    got = prefix.exact_quantiles(events, ["key"], "v", probs, blocks=5)
    want = events.filter("v IS NOT NULL").groupBy("key").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    rnd = lambda df: df.select("key", *[F.round(n, 9).alias(n) for n in probs])
    assert rows_of(rnd(got)) == rows_of(rnd(want))


def test_quantile_rows_without_keys(events):
    steps = [i / 20 for i in range(21)]
    got = [r.value for r in prefix.quantile_rows(events, [], "v", steps, blocks=5).orderBy("i").collect()]
    want = events.agg(F.percentile("v", steps)).first()[0]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("weight", [None, "n"])
def test_keyed_left_join_with_hot_and_null_keys(events, weight, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_PARTS", 3)
    feats = events.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("m"), F.min("v").alias("lo"))
    got = skew.keyed_left_join(events, feats, ["key"], weight=weight)
    want = events.join(feats, "key", "left").select(*got.columns)
    assert rows_of(got) == rows_of(want)


def test_hot_rows_are_spread(spark):
    """One key with 60 % of the rows and NULL keys with 15 %: no partition of the shuffled join gets twice the mean."""
    df = spark.range(20_000).selectExpr(
        "id", "CASE WHEN id % 20 < 12 THEN -1 WHEN id % 20 < 15 THEN NULL ELSE id END AS key", "id % 7 AS v"
    )
    feats = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("m"))
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = skew.keyed_left_join(df, feats, ["key"], weight="n")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(sizes) <= 2 * sum(sizes) / 8
    assert "SortMergeJoin [key" in plan and "__meet" in plan.split("SortMergeJoin")[1].split("LeftOuter")[0]
    assert "ReusedExchange" in plan  # the feature table is aggregated once


def test_keys_of_different_types_meet(spark):
    left = spark.createDataFrame([(1, 0.0), (2, -0.0), (None, 1.0)], "k int, x double")
    by_long = spark.createDataFrame([(1, "a", 1), (2**40, "b", 1)], "k long, m string, n long")
    by_double = spark.createDataFrame([(0.0, "z", 1)], "x double, m string, n long")
    assert rows_of(skew.keyed_left_join(left, by_long, ["k"], "n").select("k", "m")) == [(1, "a"), (2, None), (None, None)]
    assert rows_of(skew.keyed_left_join(left, by_double, ["x"], "n").select("x", "m")) == rows_of(left.join(by_double, "x", "left").select("x", "m"))
