"""Products of sparse matrices in blocks against numpy, and that factors meet cells in no join."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.checks import load, registry
from featloom.operators import blocks, topic_model, topics
from featloom.plans import sizing
from featloom.plans.sizing import cut_lineage


@pytest.mark.parametrize("kind", ["long", "string"])
def test_products_match_numpy(spark, monkeypatch, kind):
    def both(block, f, docs, terms):
        return {"docs": {"f": block.times(f)}, "terms": {"f": block.back(docs, terms)}}

    monkeypatch.setattr(blocks, "CELLS", 60)
    rng = random.Random(2)
    cells = [(d, f"t{rng.randrange(30)}", rng.random() - 0.3) for d in range(40) for _ in range(rng.randint(1, 8))]  # some cells twice
    rows = spark.createDataFrame(cells, "id long, term string, x double")
    loose = rows.filter("id = 3").withColumn("id", F.lit(None).cast("long"))
    x = blocks.Blocks(cut_lineage(rows.union(loose).withColumn("id", F.col("id").cast(kind))), "id")
    assert x.loose > 2 and x.links.select("block").distinct().count() > 3
    terms = x.terms.select("term", "code", F.array(F.col("df") * 1.0, F.length("term") * 0.5).alias("f")).filter("term <> 't7'")
    docs = x.docs.withColumn("f", F.array(F.coalesce(F.col("id").cast("double"), F.lit(9.0)), F.lit(1.0)))
    got = cut_lineage(x.visit(both, "block int, code long, at int, f array<double>", terms, docs, loose=True))
    dense = np.zeros((40, 30))
    for d, t, v in cells:
        dense[d, int(t[1:])] += v
    f = np.zeros((30, 2))
    for r in terms.collect():
        f[int(r.term[1:])] = r.f
    mine = {r.id: r.f for r in got.filter("at IS NOT NULL").join(x.docs, ["block", "at"]).collect()}
    whole = dense @ f
    assert len(mine) == 41 and mine.pop(None) == pytest.approx(whole[3])
    assert all(v == pytest.approx(whole[int(d)]) for d, v in mine.items())
    back = dense.T @ np.array([[d, 1.0] for d in range(40)]) + np.outer(dense[3], [9.0, 1.0])
    summed = blocks.added(got.filter("code IS NOT NULL"), "code", "f", 2).join(x.terms, "code").collect()
    assert {r.term for r in summed} == {t for _, t, _ in cells}
    assert all(r.f == pytest.approx(back[int(r.term[1:])]) for r in summed)
    some = x.visit(both, "block int, code long, at int, f array<double>", terms, docs)
    assert some.filter("at IS NOT NULL").count() == 40


def test_rounds_join_no_cells(spark, monkeypatch):
    calls, join = [], blocks.keyed_left_join
    for module in (blocks, topics, topic_model):
        monkeypatch.setattr(module, "keyed_left_join", lambda *a, **b: calls.append(1) or join(*a, **b))
    tc = spark.createDataFrame([(d, f"t{(d * k) % 11}", 1.0 + k) for d in range(12) for k in (1, 2, 5)], "id long, term string, w double")
    topics.nmf_topics(tc, "id", "w", 2, iters=3)
    assert len(calls) == 1
    topic_model.lda_fit(tc, "id", "w", 2, rounds=3)
    assert len(calls) == 2
    topics.svd_scores(tc, "id", "w", 2)
    assert len(calls) == 3


def test_texts_of_one_file_are_dealt_out(spark, monkeypatch, tmp_path):
    rows = [(i, f"some words {i} of text", "en", "web", 20) for i in range(500)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    load()
    plan = lambda: registry.QUERIES["cooccurrence_counts_v14"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 8, true" in plan()
    monkeypatch.setattr(sizing, "SPLIT_BYTES", 100)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert sizing.spread(docs).rdd.getNumPartitions() > 16
    monkeypatch.setattr(sizing, "FEW_BYTES", 100)
    assert "Repartition" not in plan()
