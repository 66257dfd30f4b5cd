"""Inputs that once gave wrong answers: NULL order values, empty frames, repeated keys, documents without terms."""

import pytest
from pyspark.sql import functions as F

from featloom.operators import clean, models, neighbors, ordered, topics
from featloom.sources.tables import FeatureStore


def test_distinct_ratio_with_null_dates(spark):
    rows = [("a", None, "x"), ("a", 1, "x"), ("a", 2, "y"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "key string, day int, v string")
    got = {(r.key, r.day): r.v_types_ratio for r in ordered.running_distinct_ratio(df, "key", ["v"], ["day"]).collect()}
    assert got == {("a", None): 1.0, ("a", 1): 0.5, ("a", 2): pytest.approx(2 / 3), (None, 1): 1.0}


def test_constant_columns_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert clean.drop_constant(df, ["a", "b"]).columns == ["a", "b"]
    some = spark.createDataFrame([(1, None, "x"), (1, None, None)], "a int, b string, c string")
    assert clean.drop_constant(some, ["a", "b", "c"]).columns == ["c"]


def test_no_neighbours_among_no_rows(spark):
    query = spark.createDataFrame([(1, [0.0, 1.0])], "id long, v array<double>")
    got = neighbors.ann(query.limit(0), query, "id", "v", 2)
    assert got.count() == 0 and {"query_id", "neighbour_id", "dist", "rank"} <= set(got.columns)


def test_repeated_keys_do_not_multiply_training_rows(spark, monkeypatch):
    source = spark.createDataFrame([(1, "p", 0.0, "u"), (1, "q", 1.0, "w"), (1, "p", 0.2, "u"), (2, "q", 0.9, "w")], "key long, c string, x double, y string")
    target = spark.createDataFrame([(7, "p", 0.1, None), (8, "q", 1.1, None)], source.schema)
    seen, make = [], models.make_estimator

    def spy(kind, **params):
        learner = make(kind, **params)

        class Counting:
            def fit(self, df):
                seen.append(df.count())
                return learner.fit(df)

        return Counting()

    monkeypatch.setattr(models, "make_estimator", spy)
    got = {r.key: r.y_pred for r in models.predict_missing(source, target, "logistic", "y", ["c"], ["x"], "key").collect()}
    assert seen == [4] and got == {7: "u", 8: "w"}


def test_documents_without_terms_have_zero_scores(spark):
    tc = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, "b", 1.0)], "id long, term string, w double")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id long")
    scores = {r.id: r.scores for r in topics.svd_scores(tc, "id", "w", 2, ids=ids)[0].collect()}
    assert set(scores) == {1, 2, 3, 4} and scores[4] == [0.0, 0.0]
    factors = {r.id: r.f for r in topics.nmf_topics(tc, "id", "w", 2, iters=2, ids=ids)[0].collect()}
    assert set(factors) == {1, 2, 3, 4} and factors[4] == [0.0, 0.0]
    vecs = {r.id: r.vec for r in topics.to_sparse(tc, "id", "w", ids=ids)[0].collect()}
    assert set(vecs) == {1, 2, 3, 4} and vecs[4].numNonzeros() == 0


def test_feature_store_tells_filters_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df, store = spark.read.parquet(path), FeatureStore(spark, str(tmp_path / "store"))
    build = lambda x: x.groupBy().agg(F.count(F.lit(1)).alias("n"))
    assert store.get_or_build("f", [df.where("id < 3")], build).first().n == 3
    assert store.get_or_build("f", [df.where("id < 7")], build).first().n == 7
    spark.range(5).write.mode("overwrite").parquet(path)
    assert store.get_or_build("f", [spark.read.parquet(path).where("id < 7")], build).first().n == 5
