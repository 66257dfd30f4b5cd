"""Edge cases of cleaning, encoding, group and target operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from featloom.functions import columns as fx
from featloom.functions import text as tx
from featloom.operators import clean, encode, group, joins, ordered, setops, target
from featloom.operators import vectorize as vec
from featloom.plans.fusion import Spec, by_key
from featloom.sources import tables as src


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.4,), (3.0,)], "x double")
    assert [r[0] for r in df.select(fx.clip(F.col("x"))).collect()] == [None, 0.0, 0.4, 1.0]


def test_bins_with_repeated_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 2, 3, 4, 5]] + [(None,)], "x double")
    got = {(r.x, r.x_bin) for r in encode.quantile_bins(df, "x", 4).collect()}
    # quartiles 1, 1, 1.5, 3.25, 5: the lowest value is in the first bin
    assert got == {(1.0, 0), (2.0, 1), (3.0, 1), (4.0, 2), (5.0, 2), (None, None)}


def test_drop_constant_counts_null_as_value(spark):
    df = spark.createDataFrame([(1, 5, None), (2, 5, None), (3, None, None)], "a int, b int, c int")
    assert clean.drop_constant(df, ["a", "b", "c"]).columns == ["a", "b"]


def test_collapse_needs_both_splits(spark):
    data = [("train", "x"), ("test", "x"), ("train", "y"), ("test", "z"), ("train", None), ("test", None)]
    df = spark.createDataFrame(data, "split string, c string")
    got = sorted((r.split, r.c) for r in clean.collapse_rare(df, ["c"]).collect())
    assert got == sorted([("train", "x"), ("test", "x"), ("train", "others"), ("test", "others"), ("train", "nan"), ("test", "nan")])


def test_boxcox_of_lognormal_is_near_zero(spark):
    df = spark.range(4000).select(F.exp(F.randn(7)).alias("x"))
    assert abs(encode.boxcox_lambda(df, "x", shift="none")) < 0.1


def test_label_codes_put_missing_among_strings(spark):
    df = spark.createDataFrame([("zebra",), (None,), ("apple",)], "c string")
    got = {r.c: r.code for r in encode.label_encode(df, ["c"], "x").withColumnRenamed("cx", "code").collect()}
    assert got == {"apple": 0, None: 1, "zebra": 2}


def test_specs_share_one_aggregation_per_key():
    specs = [Spec("a", "x", "mean"), Spec("a", "x", "max"), Spec(("a", "b"), "x", "mean"), Spec("a", "x", "mean")]
    assert {k: len(v) for k, v in by_key(specs).items()} == {("a",): 2, ("a", "b"): 1}
    assert specs[2].name("all_") == "all_a_b_mean_x"


def test_group_features_null_key_and_single_row(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, "b", 5.0), (4, None, 9.0)], "id int, k string, x double")
    out = group.group_features(df, [Spec("k", "x", a) for a in ("mean", "std", "median")])
    got = {r.id: (r.k_mean_x, r.k_std_x, r.k_median_x) for r in out.collect()}
    assert got[1] == (3.0, pytest.approx(2**0.5), 3.0)
    assert got[3] == (5.0, None, 5.0)
    assert got[4] == (None, None, None)


def test_rollup_items_without_period(spark):
    items = spark.createDataFrame([(1, "u"), (1, "u"), (2, "u"), (3, "v")], "item_id long, user_id string")
    d = dt.date
    periods = spark.createDataFrame(
        [(1, d(2017, 12, 30), d(2018, 1, 2)), (1, d(2018, 1, 5), d(2018, 1, 6)), (9, d(2018, 1, 1), d(2018, 1, 3))],
        "item_id long, date_from date, date_to date",
    )
    users, per_item = group.activity_rollup(items, periods)
    assert {tuple(r) for r in users.collect()} == {("u", 4.0, 2.0, 2), ("v", None, None, 1)}
    assert {tuple(r) for r in per_item.collect()} == {(1, 4.0, 2.0, 2), (9, None, None, None)}


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("n", None)], "k string, c string")
    assert sorted(map(repr, (r.c for r in group.impute_by_group(df, "c", "k").collect()))) == ["'a'", "'a'", "'b'", "None"]


@pytest.fixture(scope="module")
def folds(spark):
    data = []
    for i in range(60):
        key = "one_fold" if i in (5, 10) else ("only_test" if i >= 58 else ("a", "b", None)[i % 3])
        split = "test" if i >= 50 else "train"
        data.append((i, key, split, i % 5, (i % 7) / 7.0 if split == "train" else None))
    return spark.createDataFrame(data, "id long, c string, split string, fold int, y double")


def test_oof_does_not_see_its_own_fold(folds):
    before = target.oof_encode(folds, ["c"], "y")
    changed = folds.withColumn("y", F.when((F.col("fold") == 2) & F.col("y").isNotNull(), 1.0 - F.col("y")).otherwise(F.col("y")))
    after = target.oof_encode(changed, ["c"], "y")
    pick = lambda df: {r.id: (r.c_dp_mean_enc, r.c_dp_std_enc) for r in df.filter("split = 'train' AND fold = 2").collect()}
    assert {k: pytest.approx(v) for k, v in pick(before).items()} == pick(after)


def test_oof_unseen_keys_are_zero(folds):
    got = {r.id: (r.c_dp_mean_enc, r.c_dp_std_enc) for r in target.oof_encode(folds, ["c"], "y").collect()}
    assert got[5] == (0.0, 0.0)  # its only other row is in the same fold
    assert got[58] == (0.0, 0.0)  # category of the test rows only
    assert got[2] == (0.0, 0.0)  # missing category


def test_smooth_encoding_of_unseen_is_prior(folds):
    out = target.smooth_encode(folds, ["c"], "y", smoothing=1.0, min_leaf=1.0)
    prior = folds.agg(F.avg("y")).first()[0]
    got = {r.id: r.c_te for r in out.collect()}
    assert got[58] == pytest.approx(prior) and got[2] == pytest.approx(prior)


def test_expanding_first_row_is_zero(folds):
    out = target.expanding_encode(folds, ["c"], "y", ["id"], blocks=4)
    got = {r.id: r.c_exp for r in out.collect()}
    assert got[0] == 0.0 and got[3] == pytest.approx(0.0) and got[6] == pytest.approx((0 + 3 / 7) / 2)


def test_lag_over_month_and_year_end(spark):
    d = dt.date
    df = spark.createDataFrame(
        [("a", d(2017, 12, 31), 0.5), ("a", d(2018, 1, 1), 0.1), ("a", d(2018, 2, 1), 0.3)], "k string, d date, y double"
    )
    out = joins.lagged_group_mean(df, ["k"], "d", "y", 1, "lag")
    assert {r.d: r.lag for r in out.collect()} == {d(2017, 12, 31): None, d(2018, 1, 1): 0.5, d(2018, 2, 1): None}


def test_running_distinct_counts_missing_value_once(spark):
    df = spark.createDataFrame([(1, "u", "x"), (2, "u", None), (3, "u", None), (4, "u", "x")], "id int, u string, c string")
    got = [r.c_types_ratio for r in ordered.running_distinct_ratio(df, "u", ["c"], ["id"], blocks=3).orderBy("id").collect()]
    assert got == pytest.approx([1.0, 1.0, 2 / 3, 0.5])


def test_row_key_is_checked(spark):
    with pytest.raises(ValueError):
        src.ensure_key(spark.createDataFrame([(1,), (1,)], "id int"), "id")


def test_feature_store_rebuilds_for_another_spec(spark, tmp_path):
    source = tmp_path / "in"
    spark.range(3).write.parquet(str(source))
    df, store, calls = spark.read.parquet(str(source)), src.FeatureStore(spark, str(tmp_path / "store")), []

    def build(d):
        calls.append(1)
        return d.select("id", (F.col("id") * 2).alias("x"))

    for spec in ("a", "a", "b"):
        assert store.get_or_build("double", [df], build, spec).count() == 3
    assert len(calls) == 2


def test_csv_scan_and_vectors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,day\n1,"two\nlines",2017-03-15\n')
    df = src.read_table(spark, str(tmp_path / "a.csv"), "id int, text string, day string", ["id", "day"], ["day"], "csv")
    assert df.collect() == [(1, dt.date(2017, 3, 15))]
    (tmp_path / "v.txt").write_text("cat 1 2.5\ndog -1 0\n")
    assert {tuple([r.word, *r.vector]) for r in src.read_vectors(spark, str(tmp_path / "v.txt")).collect()} == {("cat", 1.0, 2.5), ("dog", -1.0, 0.0)}


def test_text_edges(spark):
    df = spark.createDataFrame([(1, ""), (2, "the"), (3, "a a b")], "id int, t string")
    got = {r.id: (r.t_words, r.t_unique_words, r.t_unique_pct) for r in df.select("id", *tx.word_stats("t")).collect()}
    assert got == {1: (0, 0, None), 2: (1, 1, 100.0), 3: (3, 2, pytest.approx(200 / 3))}
    assert df.select(F.size(tx.clean_tokens(F.col("t"), ["the"]))).collect()[1][0] == 0
    n = df.select("id", tx.contained_tokens(F.lit("a a c"), F.col("t")).alias("n")).collect()
    assert [r.n for r in n] == [0, 0, 2]


def test_middle_truncation(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: i.cast("string")).alias("w"))
    got = df.select(tx.truncate_middle(F.col("w"))).first()[0]
    assert got == [str(i) for i in [*range(1, 21), *range(31, 61)]]


def test_strip_numbers_next_to_each_other(spark):
    df = spark.createDataFrame([("1 22 a3 4b 5-6 _7",)], "t string")
    assert df.select(tx.strip_numbers(F.col("t"))).first()[0] == "  a3 4b - _7"


def brute_char_wb(text, lo, hi):
    """Definition: n-grams of ' word '; a word shorter than n is taken whole, once."""
    out = []
    for w in text.lower().split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            if len(w) >= n:
                out += [w[i : i + n] for i in range(len(w) - n + 1)]
            elif n == lo:
                out.append(w)
    return out


@pytest.mark.parametrize("sizes", [(2, 3), (2, 4), (4, 5)])
def test_char_wb(spark, sizes):
    text = "A bc bc def ghijk"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    got = {r.term: r.n for r in vec.term_counts(df, "id", "t", "char_wb", sizes).collect()}
    want = brute_char_wb(text, *sizes)
    assert got == {t: want.count(t) for t in set(want)}


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", 3.0), (2, "b", 4.0)], "id int, term string, w double")
    assert sorted(r.w for r in vec.l2_normalize(df, "id").collect()) == pytest.approx([0.0, 0.6, 0.8])


def test_support_threshold_zero_when_everything_fits(spark):
    vocab = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "term string, df int, cf int")
    assert vec.prune_support(vocab, 5).count() == 2
    assert [r.term for r in vec.prune_support(vocab, 1).collect()] == ["b"]


def test_padded_ids_unknown_text(spark):
    df = spark.createDataFrame([(1, "x y x"), (2, "")], "id int, t string")
    got = {r.id: r.ids for r in vec.token_ids(df, "id", "t", 10, 4).collect()}
    assert got == {1: [0, 1, 2, 1], 2: [0, 0, 0, 0]}


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3,)], "x int")
    assert sorted(map(tuple, setops.union_all([a, b]).collect()), key=repr) == [(1, 2), (3, None)]


@pytest.mark.parametrize("analyzer, text, want", [
    ("word", "Ab cd ab, x", {"ab": 2, "cd": 1, "ab cd": 1, "cd ab": 1}),
    ("char", "aba", {"a": 2, "b": 1, "ab": 1, "ba": 1}),
    ("char_wb", "a a", {" ": 4, "a": 2, " a": 2, "a ": 2}),
])
def test_terms_of_ids_that_repeat_are_added_up(spark, analyzer, text, want):
    rows = [(1, text), (2, text), (2, text), (None, text), (None, text), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = {(r.id, r.term): r.n for r in vec.term_counts(df, "id", "t", analyzer, (1, 2)).collect()}
    expect = {(i, t): k * n for i, k in ((1, 1), (2, 2), (None, 2)) for t, n in want.items()}
    if analyzer == "char":
        expect[4, ""] = 1
    assert got == expect


def test_terms_of_own_ids_are_not_shuffled(spark):
    df = spark.range(20).withColumn("t", F.lit("one two three"))
    plan = vec.term_counts(df, "id", "t", ngrams=(1, 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_restrict_to_few_terms_is_not_shuffled(spark):
    tc = spark.createDataFrame([(1, "a", 2), (2, "b", 1), (2, "a", 1)], "id int, term string, n long")
    out = vec.restrict(tc, spark.createDataFrame([("a", 2, 3)], "term string, df long, cf long"))
    assert sorted(out.collect()) == [(1, "a", 2, 2), (2, "a", 1, 2)]
    assert "rightHint=(strategy=broadcast)" in out._jdf.queryExecution().optimizedPlan().toString()


def test_rare_buckets_go_without_a_shuffle_of_rows(spark):
    """Buckets of three documents or fewer go; the plan that drops them only reads what was written."""
    rows = [(i, f"t{j}", 2) for i in range(40) for j in range(12) if i % (j + 1) == 0] + [(None, "t0", 1)]
    tc = spark.createDataFrame(rows, "id long, term string, n long")
    every = vec.hash_terms(tc, "id", 100).collect()
    for buckets in (100, 2**28):
        out = vec.hash_terms(tc, "id", buckets, min_support=5)
        assert ("Exchange" in out._jdf.queryExecution().toString()) == (buckets > 2**27)
    out = vec.hash_terms(tc, "id", 100, min_support=5)
    size = {b: sum(r.bucket == b for r in every) for b in range(100)}
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in every if size[r.bucket] > 5)
    assert 0 < out.count() < len(every)
