"""Topics, word vectors, neighbours and row-wise statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded
from featloom.functions import columns as fx
from featloom.functions import text as tx
from featloom.operators import neighbors as nb
from featloom.operators import rowstats as rs
from featloom.operators import topic_model as lda
from featloom.operators import topics
from featloom.operators import vectorize as vec
from featloom.operators import word_vectors as wv
from featloom.operators.joins import attach
from featloom.operators.sparse_neighbors import sparse_ann
from featloom.plans.sizing import cut_lineage, spread


def _weights(t):
    """tf-idf of all terms."""
    n_docs = t.documents.agg(F.count(F.lit(1))).scalar()
    return vec.tfidf(vec.term_counts(t.documents, "doc_id", "text"), "doc_id", n_docs)


def _tokens(t):
    """Words of all texts; a small file is dealt to all cores first."""
    return spread(t.documents.select("text")).select(tx.clean_tokens(F.col("text")).alias("tokens"))


@check("svd_scores_v10")
def _(t):
    scores, _ = topics.svd_scores(_weights(t), "doc_id", "w", 5, ids=t.documents)
    return scores.select("doc_id", F.posexplode("scores").alias("component", "score")).withColumn("score", F.round("score", 4))


@check("lda_topics_v11")
def _(t):
    weights, _, _ = lda.lda_fit(vec.term_counts(t.documents, "doc_id", "text"), "doc_id", "n", 5, rounds=8)
    shares = lda.lda_shares(weights, "doc_id", 5, ids=t.documents)
    shared = topics.topic_shares(shares.withColumnRenamed("shares", "raw"), "raw")
    return shared.select("doc_id", F.transform("shares", lambda v: F.round(v, 4)).alias("shares"), "topic")


@check("nmf_topics_v12")
def _(t):
    docs, _, _ = topics.nmf_topics(_weights(t), "doc_id", "w", 5, iters=4, ids=t.documents)
    shared = topics.topic_shares(docs, "f")
    return shared.select("doc_id", F.transform("shares", lambda v: F.round(v, 4)).alias("shares"), "topic")


@check(
    "topic_shares_v13",
    f"""WITH a AS (SELECT vec_id, list_transform(embedding[1:5], lambda v: abs(CAST(v AS DOUBLE))) AS f FROM embeddings)
    SELECT vec_id, {R('f[1] / list_sum(f)', 's0')}, {R('f[5] / list_sum(f)', 's4')}, CAST(list_position(f, list_max(f)) - 1 AS INT) AS topic FROM a""",
)
def _(t):
    df = t.embeddings.select("vec_id", F.transform(F.slice("embedding", 1, 5), lambda v: F.abs(v.cast("double"))).alias("f"))
    out = topics.topic_shares(df, "f")
    return rounded(out.select("vec_id", F.get("shares", F.lit(0)).alias("s0"), F.get("shares", F.lit(4)).alias("s4"), "topic"), "s0", "s4")


@check("word_vectors_v14")
def _(t):
    docs = t.documents.select(tx.clean_tokens(F.col("text")).alias("tokens"))
    vectors = topics.train_vectors(docs, "tokens", size=10, window=3, min_count=1)
    return vectors.select("word", F.transform("vector", lambda v: F.round(v, 4)).alias("vector"))


@check("cooccurrence_vectors_v14")
def _(t):
    docs = _tokens(t)
    vectors = wv.cooccurrence_vectors(docs, "tokens", size=10, window=2, rounds=2)
    return vectors.select("word", "n", F.transform("vector", lambda v: F.round(v, 4)).alias("vector"))


PAIR_COUNTS = r"""WITH d AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: length(w) >= 2) AS w FROM documents),
p AS (SELECT w, o, unnest(range(1, len(w) - o + 1)) AS i FROM d, (SELECT unnest([1, 2]) AS o)), q AS (SELECT w[i] AS a, w[i + o] AS b FROM p)
SELECT word, context, COUNT(*) AS n FROM (SELECT a AS word, b AS context FROM q UNION ALL SELECT b, a FROM q) GROUP BY 1, 2"""


@check("cooccurrence_counts_v14", PAIR_COUNTS)
def _(t):
    return wv.cooccurrences(_tokens(t), "tokens", 2)


@check(
    "pooled_vectors_v15",
    f"""WITH d AS (SELECT label, i, CAST(embedding[i] AS DOUBLE) AS v FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings))
    SELECT label, CAST(i - 1 AS INT) AS dim, {R('AVG(v)', 'mean')}, {R('SUM(v)', 'sum')}, {R('stddev_pop(v)', 'std')} FROM d GROUP BY 1, 2""",
)
def _(t):
    out = topics.pool_rows(t.embeddings, "label", "embedding")
    cells = out.select("label", F.posexplode(F.arrays_zip("mean", "sum", "std")).alias("dim", "c")).select("label", "dim", "c.*")
    return rounded(cells, "mean", "sum", "std")


@check(
    "vocabulary_vectors_v16",
    f"""WITH voc AS (SELECT DISTINCT lang AS word FROM documents UNION SELECT 'none'), vecs AS (SELECT lang AS word, AVG(n_chars) AS v FROM documents WHERE lang > 'd' GROUP BY 1)
    SELECT word, {R('COALESCE(v, 0)', 'v0', 3)}, CAST(v IS NOT NULL AS INT) AS known FROM voc LEFT JOIN vecs USING (word)""",
)
def _(t):
    vectors = t.documents.filter("lang > 'd'").groupBy(F.col("lang").alias("word")).agg(F.array(F.avg("n_chars"), F.lit(1.0)).alias("vector"))
    vocab = t.documents.select(F.col("lang").alias("word")).union(t.region.select(F.lit("none"))).distinct()
    out, _ = topics.vocab_vectors(vocab, vectors, 2)
    return rounded(out.select("word", F.get("vector", F.lit(0)).alias("v0"), "known"), "v0", digits=3)


# ---- neighbours -------------------------------------------------------------------


@check("kmeans_groups_k1")
def _(t):
    return nb.assign_groups(t.embeddings, t.embeddings, "embedding", k=10, seed=3).select("vec_id", "grp")


SPLIT = "vec_id % 4 <> 0"
PAIRS = """WITH e AS (SELECT vec_id, label, vec_id % 5 AS fold, CAST(embedding AS DOUBLE[]) AS v, CAST(embedding[64] AS DOUBLE) AS price FROM embeddings),
pairs AS (SELECT q.vec_id AS query_id, t.vec_id AS neighbour_id, sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist, t.price
 FROM e q JOIN e t ON q.label = t.label AND t.vec_id % 4 <> 0 AND t.vec_id <> q.vec_id),
near AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, neighbour_id) AS INT) AS rank FROM pairs)"""


def _rows(t):
    return t.embeddings.select(
        "vec_id", "label", (F.col("vec_id") % 5).cast("int").alias("fold"), "embedding",
        F.col("embedding")[63].cast("double").alias("price"),
        F.when(F.expr(SPLIT), "train").otherwise("test").alias("split"),
    )


@check(
    "neighbours_in_group_k2_j7",
    f"{PAIRS} SELECT query_id, rank, neighbour_id, {R('dist', 'dist')} FROM near WHERE rank <= 10",
)
def _(t):
    rows = _rows(t)
    out = nb.knn(rows.filter("split = 'train'"), rows, "vec_id", "embedding", "label", 10, exclude_self=True, cell_rows=200)
    return rounded(out.select("query_id", "rank", "neighbour_id", "dist"), "dist")


@check(
    "neighbour_features_k3",
    f"""{PAIRS} SELECT query_id, {R('AVG(CASE WHEN rank <= 5 THEN dist END)', '"5_closest_avg_dist"')}, {R('AVG(CASE WHEN rank <= 5 THEN price END)', 'price_5_closest_mean')},
    {R('AVG(dist)', '"10_closest_avg_dist"')}, {R('AVG(price)', 'price_10_closest_mean')} FROM near WHERE rank <= 10 GROUP BY 1""",
)
def _(t):
    rows = _rows(t)
    train = rows.filter("split = 'train'")
    near = nb.knn(train, rows, "vec_id", "embedding", "label", 10, exclude_self=True)
    out = nb.knn_features(near, train, "vec_id", ["price"], [5, 10]).drop("query_fold")
    return rounded(out, *[c for c in out.columns if c != "query_id"])


@check(
    "foldwise_neighbours_k4",
    f"""WITH e AS (SELECT vec_id, label, CAST(vec_id % 5 AS INT) AS fold, {SPLIT} AS tr, CAST(embedding AS DOUBLE[]) AS v, CAST(embedding[64] AS DOUBLE) AS price FROM embeddings),
    q AS (SELECT vec_id, fold, v FROM e WHERE tr UNION ALL SELECT vec_id, f.fold, v FROM e, (SELECT unnest([0, 1, 2, 3, 4]) AS fold) f WHERE NOT tr),
    near AS (SELECT q.vec_id AS query_id, q.fold, sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist, t.price, t.vec_id AS nid
      FROM q JOIN e t ON t.tr AND t.fold <> q.fold),
    top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, fold ORDER BY dist, nid) AS r FROM near) WHERE r <= 10),
    per AS (SELECT query_id, fold, AVG(CASE WHEN r <= 5 THEN dist END) AS d5, AVG(CASE WHEN r <= 5 THEN price END) AS p5, AVG(dist) AS d10, AVG(price) AS p10 FROM top GROUP BY 1, 2)
    SELECT query_id, {R('AVG(d5)', '"5_closest_avg_dist"')}, {R('AVG(p5)', 'price_5_closest_mean')}, {R('AVG(d10)', '"10_closest_avg_dist"')}, {R('AVG(p10)', 'price_10_closest_mean')} FROM per GROUP BY 1""",
)
def _(t):
    out = nb.oof_knn_features(_rows(t).drop("label"), "vec_id", "embedding", ["price"], [5, 10])
    return rounded(out, *[c for c in out.columns if c != "query_id"])


@check("approximate_neighbours_k5")
def _(t):
    return nb.ann(t.embeddings, t.embeddings, "vec_id", "embedding", 5, probes=3, exclude_self=True, cell_rows=50).select("query_id", "rank", "neighbour_id")


@check("sparse_fold_neighbours_k5")
def _(t):
    """Each document's five closest in the other folds, by tf-idf; documents without a label search all folds in turn."""
    docs = t.docs.select("doc_id", "text", "quality", F.pmod("doc_id", F.lit(5)).alias("fold"))
    weights = cut_lineage(vec.tfidf(vec.term_counts(docs, "doc_id", "text"), "doc_id", docs.count()))
    labelled = docs.filter("quality IS NOT NULL").select("doc_id", "fold")
    every = docs.filter("quality IS NULL").select("doc_id", F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("fold"))
    train = weights.join(labelled.select("doc_id"), "doc_id", "left_semi")
    asks = labelled.unionByName(every.withColumn("fold", F.col("fold").cast("long")))
    near = sparse_ann(train, weights, "doc_id", 5, train_folds=labelled, query_folds=asks)
    return rounded(near, "dist")


@check(
    "geo_codes_by_city_k6",
    """SELECT c_custkey, n_name || '_' || r_name AS city_region, n_regionkey AS geo_code FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = places.withColumn("city_region", fx.interact(["n_name", "r_name"]))
    people = t.customer.join(named.select("n_nationkey", "city_region"), F.col("c_nationkey") == F.col("n_nationkey"))
    geo = named.select("city_region", F.col("n_regionkey").alias("geo_code"))
    return attach(people.select("c_custkey", "city_region"), geo, "city_region")


# ---- row-wise statistics ------------------------------------------------------------

P = "list_sort([p1, p2, p3])"


@check(
    "model_group_stats_m1",
    f"""SELECT item_id, {R('(p1 + p2 + p3) / 3', 'm_mean')}, {R(P + '[2]', 'm_median')}, {R(P + '[3]', 'm_max')}, {R(P + '[1]', 'm_min')},
    {R('list_aggregate([p1, p2, p3], ' + "'stddev_samp')", 'm_std')} FROM preds""",
    ("preds",),
)
def _(t):
    out = rs.row_stats(t.preds.select("item_id", "p1", "p2", "p3"), ["p1", "p2", "p3"], "m_").drop("p1", "p2", "p3")
    return rounded(out, *[c for c in out.columns if c != "item_id"])


@check(
    "score_vector_stats_m2",
    f"""WITH s AS (SELECT vec_id, list_sort(list_transform(embedding[1:10], lambda v: CAST(v AS DOUBLE))) AS v FROM embeddings),
    q AS (SELECT *, v[3] + (v[4] - v[3]) * 0.25 AS q1, v[7] + (v[8] - v[7]) * 0.75 AS q3, (list_sum(v) - v[10]) / 9 AS rest FROM s)
    SELECT vec_id, {R('q1', 'q1')}, {R('q3', 'q3')}, {R('q3 - q1', 'quartile_range')}, {R('v[10] - v[1]', '"range"')},
    {R('rest', 'mean_without_max')}, {R('v[10] - rest', 'max_over_rest')} FROM q""",
)
def _(t):
    stats = ["q1", "q3", "quartile_range", "range", "mean_without_max", "max_over_rest"]
    out = t.embeddings.select("vec_id", rs.array_stats(F.slice("embedding", 1, 10), stats).alias("s")).select("vec_id", "s.*")
    return rounded(out, *stats)


@check(
    "geometric_harmonic_means_m3",
    f"""SELECT item_id, {R('exp((ln(a) + ln(b) + ln(c)) / 3)', 'gmean')}, {R('3 / (1 / a + 1 / b + 1 / c)', 'hmean')} FROM
    (SELECT item_id, LEAST(GREATEST(p1, 1e-15), 1) AS a, LEAST(GREATEST(p2, 1e-15), 1) AS b, LEAST(GREATEST(p3, 1e-15), 1) AS c FROM preds)""",
    ("preds",),
)
def _(t):
    return rounded(rs.row_means(t.preds, ["p1", "p2", "p3"]).select("item_id", "gmean", "hmean"), "gmean", "hmean")


@check(
    "prediction_pairs_m4",
    "SELECT item_id, " + ", ".join(
        f"{R(f'({a} + {b}) / 2', f'{a}_{b}_mean')}, {R(f'sqrt({a} * {b})', f'{a}_{b}_gmean')}, {R(f'({a} + {b}) / 2', f'{a}_{b}_median')}, {R(f'abs({a} - {b}) / sqrt(2)', f'{a}_{b}_std')}"
        for a, b in [("p1", "p2"), ("p1", "p3"), ("p2", "p3")]
    ) + " FROM preds",
    ("preds",),
)
def _(t):
    out = rs.combos(t.preds.select("item_id", "p1", "p2", "p3"), ["p1", "p2", "p3"], 2).drop("p1", "p2", "p3")
    return rounded(out, *[c for c in out.columns if c != "item_id"])


@check(
    "loss_weighted_power_mean_m5",
    f"SELECT item_id, {R('pow(pow(p1, 1 / 0.208425) * pow(p2, 1 / 0.208764), 1 / (1 / 0.208425 + 1 / 0.208764))', 'powered')} FROM preds",
    ("preds",),
)
def _(t):
    value = fx.power_mean(F.col("p1"), F.col("p2"), 1 / 0.208425, 1 / 0.208764)
    return rounded(t.preds.select("item_id", value.alias("powered")), "powered")


@check(
    "confidence_votes_m6",
    f"""SELECT vec_id, CAST(a > 0.5 AS INT) AS a_bin, CAST(b > 0.5 AS INT) AS b_bin, CAST(c > 0.5 AS INT) AS c_bin,
    CAST(a > 0.5 AS INT) + CAST(b > 0.5 AS INT) + CAST(c > 0.5 AS INT) AS conf_votes, {R('(a + b + c) / 3', 'conf_mean')}, {R('list_sort([a, b, c])[2]', 'conf_median')},
    {R('GREATEST(a, b, c)', 'conf_max')}, {R('LEAST(a, b, c)', 'conf_min')}, {R("list_aggregate([a, b, c], 'stddev_samp')", 'conf_std')} FROM
    (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c FROM embeddings)""",
)
def _(t):
    df = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate("abc")])
    out = rs.confidence_votes(df, ["a", "b", "c"]).drop("a", "b", "c")
    return rounded(out, *[c for c in out.columns if c.startswith("conf_") and c != "conf_votes"])
