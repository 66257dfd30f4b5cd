"""Target encodings, running features, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded, text_date
from featloom.functions import columns as fx
from featloom.operators import ordered, setops, target

# ---- target encoding ----------------------------------------------------------


@check(
    "smoothed_encoding_e1",
    f"""WITH prior AS (SELECT AVG(y) AS p FROM items),
    a AS (SELECT param_1, AVG(y) AS m, 1 / (1 + exp(-(COUNT(y) - 100) / 10.0)) AS w FROM items WHERE param_1 IS NOT NULL GROUP BY 1),
    b AS (SELECT city, AVG(y) AS m, 1 / (1 + exp(-(COUNT(y) - 100) / 10.0)) AS w FROM items GROUP BY 1)
    SELECT item_id, {R('COALESCE(p * (1 - a.w) + a.m * a.w, p)', 'param_1_te')}, {R('COALESCE(p * (1 - b.w) + b.m * b.w, p)', 'city_te')}
    FROM items CROSS JOIN prior LEFT JOIN a USING (param_1) LEFT JOIN b USING (city)""",
    ("items",),
)
def _(t):
    out = target.smooth_encode(t.items.select("item_id", "param_1", "city", "y"), ["param_1", "city"], "y")
    return rounded(out.select("item_id", "param_1_te", "city_te"), "param_1_te", "city_te")


@check("noisy_encoding_e2")
def _(t):
    df = t.items.select("item_id", "param_1", "y")
    return target.smooth_encode(df, ["param_1"], "y", noise=0.01, seed=5).select("item_id", "param_1_te")


def _oof_sql(source, col, id_col="item_id", extra=""):
    """Straight from the definition: one group-by per left-out fold."""
    return f"""WITH src AS ({source}), f AS (SELECT unnest([0, 1, 2, 3, 4]) AS fold),
    enc AS (SELECT f.fold, v, COALESCE(AVG(y), 0) AS m, COALESCE(stddev_samp(y), 0) AS s FROM src JOIN f ON src.fold <> f.fold
      WHERE split = 'train' AND v IS NOT NULL GROUP BY f.fold, v),
    tst AS (SELECT v, SUM(m) / 5 AS m, SUM(s) / 5 AS s FROM enc GROUP BY v)
    SELECT {id_col}, {R("COALESCE(CASE WHEN split = 'train' THEN enc.m ELSE tst.m END, 0)", f"{col}_dp_mean_enc")},
    {R("COALESCE(CASE WHEN split = 'train' THEN enc.s ELSE tst.s END, 0)", f"{col}_dp_std_enc")} FROM src
    LEFT JOIN enc ON src.fold = enc.fold AND src.v = enc.v LEFT JOIN tst ON src.v = tst.v"""


@check("oof_encoding_e3", _oof_sql("SELECT item_id, split, fold, y, param_1 AS v FROM items", "param_1"), ("items",))
def _(t):
    out = target.oof_encode(t.items, ["param_1"], "y").select("item_id", "param_1_dp_mean_enc", "param_1_dp_std_enc")
    return rounded(out, "param_1_dp_mean_enc", "param_1_dp_std_enc")


@check("oof_encoding_small_groups_e3", _oof_sql("SELECT item_id, split, fold, y, user_id AS v FROM items", "user_id"), ("items",))
def _(t):
    out = target.oof_encode(t.items, ["user_id"], "y").select("item_id", "user_id_dp_mean_enc", "user_id_dp_std_enc")
    return rounded(out, "user_id_dp_mean_enc", "user_id_dp_std_enc")


@check(
    "expanding_encoding_e4_w4",
    f"""SELECT item_id, {R('''CASE WHEN param_1 IS NULL THEN 0 WHEN split = 'train' THEN
      COALESCE(AVG(y) OVER (PARTITION BY param_1 ORDER BY activation_date, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      ELSE COALESCE(AVG(y) OVER (PARTITION BY param_1), 0) END''', 'param_1_exp')} FROM items""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "split", "param_1", "activation_date", "y")
    out = target.expanding_encode(df, ["param_1"], "y", ["activation_date", "item_id"], blocks=8)
    return rounded(out.select("item_id", "param_1_exp"), "param_1_exp")


SHARES = """WITH raw AS (SELECT vec_id, unnest(generate_series(1, 5)) AS k, embedding FROM embeddings),
shares AS (SELECT vec_id, k - 1 AS topic, abs(CAST(embedding[k] AS DOUBLE)) / SUM(abs(CAST(embedding[k] AS DOUBLE))) OVER (PARTITION BY vec_id) AS share FROM raw),
stats AS (SELECT label % 5 AS topic, AVG(y) AS m, COALESCE(stddev_samp(y), 0) AS s, median(y) AS md
  FROM (SELECT label, CAST(embedding[10] AS DOUBLE) AS y FROM embeddings) GROUP BY 1)"""


def _shares(t):
    first = F.transform(F.slice("embedding", 1, 5), lambda v: F.abs(v.cast("double")))
    total = F.aggregate(first, F.lit(0.0), lambda a, v: a + v)
    df = t.embeddings.select("vec_id", F.transform(first, lambda v: v / total).alias("s"))
    return df.select("vec_id", F.posexplode("s").alias("topic", "share"))


@check(
    "topic_weighted_encoding_e5",
    f"""{SHARES} SELECT vec_id, {R('SUM(share * m)', 'weighted_y_mean')}, {R('SUM(share * s)', 'weighted_y_std')}, {R('SUM(share * md)', 'weighted_y_median')}
    FROM shares LEFT JOIN stats USING (topic) GROUP BY 1""",
)
def _(t):
    rows = t.embeddings.select((F.col("label") % 5).alias("topic"), F.col("embedding")[9].cast("double").alias("y"))
    stats = target.topic_stats(rows, "topic", {"y": ["mean", "std", "median"]})
    return rounded(target.topic_weighted(_shares(t), stats, "vec_id", "topic"), "weighted_y_mean", "weighted_y_std", "weighted_y_median")


@check(
    "topic_weighted_oof_e5",
    SHARES.split("stats AS")[0].rstrip().rstrip(",")
    + """, src AS (SELECT vec_id, label % 5 AS v, CAST(embedding[10] AS DOUBLE) AS y, vec_id % 5 AS fold,
      CASE WHEN vec_id % 7 < 5 THEN 'train' ELSE 'test' END AS split FROM embeddings),
    f AS (SELECT unnest([0, 1, 2, 3, 4]) AS fold),
    enc AS (SELECT f.fold, v, AVG(y) AS m, COALESCE(stddev_samp(y), 0) AS s FROM src JOIN f ON src.fold <> f.fold WHERE split = 'train' GROUP BY 1, 2),
    tst AS (SELECT -1 AS fold, v, SUM(m) / 5 AS m, SUM(s) / 5 AS s FROM enc GROUP BY v),
    enc_all AS (SELECT * FROM enc UNION ALL SELECT * FROM tst)
    SELECT vec_id, """
    + R("SUM(share * COALESCE(m, 0))", "weighted_y_mean") + ", " + R("SUM(share * COALESCE(s, 0))", "weighted_y_std")
    + """ FROM shares JOIN src USING (vec_id) LEFT JOIN enc_all ON enc_all.v = topic AND enc_all.fold = CASE WHEN split = 'train' THEN src.fold ELSE -1 END GROUP BY 1""",
)
def _(t):
    rows = t.embeddings.select(
        "vec_id", (F.col("label") % 5).alias("topic"), F.col("embedding")[9].cast("double").alias("y"),
        (F.col("vec_id") % 5).alias("fold"), F.when(F.col("vec_id") % 7 < 5, "train").otherwise("test").alias("split"),
    )
    return rounded(target.topic_weighted_oof(_shares(t), rows, "vec_id", "topic", "y"), "weighted_y_mean", "weighted_y_std")


@check(
    "user_oof_encoding_e6",
    _oof_sql(
        """SELECT item_id, split, fold, y, CASE WHEN n > 12 AND tr = 1 AND te = 1 THEN CAST(user_id AS VARCHAR) ELSE 'others_users' END AS v FROM
        (SELECT *, COUNT(*) OVER (PARTITION BY user_id) AS n, MAX(CASE WHEN split = 'train' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS tr,
         MAX(CASE WHEN split = 'test' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS te FROM items)""",
        "user_id",
    ),
    ("items",),
)
def _(t):
    out = target.user_oof_encode(t.items.select("item_id", "user_id", "split", "fold", "y"), "y", min_count=12)
    return rounded(out.select("item_id", "user_id_dp_mean_enc", "user_id_dp_std_enc"), "user_id_dp_mean_enc", "user_id_dp_std_enc")


@check(
    "binned_oof_encoding_e7",
    _oof_sql(
        """SELECT item_id, split, fold, y, CASE WHEN price IS NULL THEN NULL ELSE GREATEST(len(list_filter(edges, lambda e: e < price)) - 1, 0) END AS v
        FROM items, (SELECT list_sort(list_distinct(quantile_cont(price, [CAST(i AS DOUBLE) / 20 FOR i IN range(21)]))) AS edges FROM items)""".replace(
            "[CAST(i AS DOUBLE) / 20 FOR i IN range(21)]", "[" + ", ".join(f"CAST({i} AS DOUBLE) / 20" for i in range(21)) + "]"
        ),
        "price_bin",
    ),
    ("items",),
)
def _(t):
    out = target.binned_oof_encode(t.items, "price", "y", 20)
    return rounded(out.select("item_id", "price_bin_dp_mean_enc", "price_bin_dp_std_enc"), "price_bin_dp_mean_enc", "price_bin_dp_std_enc")


# ---- running features ---------------------------------------------------------

PERIOD_ORDER = ["activation_date", "date_from", "date_to", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@check(
    "renewal_counter_w1",
    f"""SELECT item_id, l_partkey, l_suppkey, CAST(row_number() OVER w - 1 AS INT) AS renewed_count, CAST(row_number() OVER w > 1 AS INT) AS is_renewed
    FROM periods WINDOW w AS (PARTITION BY item_id ORDER BY {', '.join(PERIOD_ORDER)})""",
    ("periods",),
)
def _(t):
    out = ordered.occurrence_number(t.periods, "item_id", PERIOD_ORDER, blocks=8)
    return out.select("item_id", "l_partkey", "l_suppkey", "renewed_count", "is_renewed")


@check(
    "running_distinct_ratio_w2",
    f"""SELECT item_id, {R('SUM(f1) OVER w / CAST(COUNT(*) OVER w AS DOUBLE)', 'city_types_ratio')}, {R('SUM(f2) OVER w / CAST(COUNT(*) OVER w AS DOUBLE)', 'param_1_types_ratio')} FROM
    (SELECT item_id, category_name, activation_date, CASE WHEN row_number() OVER (PARTITION BY category_name, city ORDER BY activation_date, item_id) = 1 THEN 1 ELSE 0 END AS f1,
     CASE WHEN row_number() OVER (PARTITION BY category_name, param_1 ORDER BY activation_date, item_id) = 1 THEN 1 ELSE 0 END AS f2 FROM items)
    WINDOW w AS (PARTITION BY category_name ORDER BY activation_date, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "category_name", "city", "param_1", "activation_date")
    out = ordered.running_distinct_ratio(df, "category_name", ["city", "param_1"], ["activation_date", "item_id"], blocks=8)
    return rounded(out.select("item_id", "city_types_ratio", "param_1_types_ratio"), "city_types_ratio", "param_1_types_ratio")


@check(
    "running_mean_w3",
    f"""SELECT item_id, {R('AVG(CASE WHEN price >= 0 THEN price END) OVER (ORDER BY activation_date, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'avg_price', 4)} FROM items""",
    ("items",),
)
def _(t):
    out = ordered.running_mean(t.items.select("item_id", "activation_date", "price"), "price", ["activation_date", "item_id"], blocks=8)
    return rounded(out.select("item_id", "avg_price"), "avg_price", digits=4)


@check(
    "running_mean_by_date_w3",
    f"""SELECT CAST(activation_date AS VARCHAR) AS activation_date, {R('SUM(s) OVER w / SUM(n) OVER w', 'avg_price', 4)} FROM
    (SELECT activation_date, SUM(price) AS s, COUNT(price) AS n FROM items GROUP BY 1) WINDOW w AS (ORDER BY activation_date)""",
    ("items",),
)
def _(t):
    return rounded(text_date(ordered.running_date_mean(t.items, "activation_date", "price"), "activation_date"), "avg_price", digits=4)


@check(
    "first_per_key_w5",
    f"""SELECT item_id, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY {', '.join(PERIOD_ORDER)}) AS r FROM periods) WHERE r = 1""",
    ("periods",),
)
def _(t):
    return ordered.first_per_key(t.periods, "item_id", PERIOD_ORDER).select("item_id", "l_partkey", "l_suppkey", "l_quantity")


@check(
    "row_argmax_w6",
    """SELECT vec_id, CAST(list_position(list_slice(embedding, 1, 10), list_max(list_slice(embedding, 1, 10))) - 1 AS INT) AS best FROM embeddings""",
)
def _(t):
    return t.embeddings.select("vec_id", fx.argmax(F.slice("embedding", 1, 10)).alias("best"))


# ---- sorts, limits, sets --------------------------------------------------------


@check(
    "sort_and_head_t1_t2",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20",
)
def _(t):
    return setops.head_by(t.orders, ["o_orderdate", "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


@check(
    "row_positions_t1",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_id FROM orders",
)
def _(t):
    return ordered.row_positions(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], blocks=8).drop("o_totalprice")


@check("top_values_t3", "SELECT param_1, COUNT(*) AS n FROM items GROUP BY 1 ORDER BY n DESC, param_1 LIMIT 10", ("items",))
def _(t):
    return setops.top_values(t.items.filter("param_1 IS NOT NULL"), "param_1", 10)


@check(
    "top_terms_t4",
    """SELECT topic, term, weight, rank FROM (SELECT lang AS topic, source AS term, COUNT(*) AS weight, CAST(row_number() OVER (PARTITION BY lang ORDER BY COUNT(*) DESC, source) AS INT) AS rank
    FROM documents GROUP BY 1, 2) WHERE rank <= 3""",
)
def _(t):
    counts = t.documents.groupBy(F.col("lang").alias("topic"), F.col("source").alias("term")).agg(F.count(F.lit(1)).alias("weight"))
    return setops.top_terms(counts, 3)


@check(
    "largest_orders_per_customer_t5",
    """SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rank FROM orders) WHERE rank <= 3""",
)
def _(t):
    return ordered.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@check(
    "above_percentile_t6",
    """WITH imp AS (SELECT p_brand AS name, SUM(p_retailprice) AS importance FROM part GROUP BY 1)
    SELECT name FROM imp WHERE importance > (SELECT quantile_cont(importance, 0.1) FROM imp)""",
)
def _(t):
    imp = t.part.groupBy(F.col("p_brand").alias("name")).agg(F.sum("p_retailprice").alias("importance"))
    return setops.keep_above_percentile(imp, 10).select("name")


@check(
    "union_all_u1",
    "SELECT c_name AS name, c_acctbal AS bal, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier",
)
def _(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return setops.union_all([a, b])


@check(
    "distinct_rows_u2",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def _(t):
    return setops.distinct_by(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@check(
    "shared_values_u3",
    "SELECT user_id FROM items WHERE split = 'train' INTERSECT SELECT user_id FROM items WHERE split = 'test'",
    ("items",),
)
def _(t):
    return setops.shared_values(t.items.filter("split = 'train'"), t.items.filter("split = 'test'"), "user_id")


@check(
    "one_sided_values_u4",
    "SELECT user_id FROM items WHERE split = 'train' EXCEPT SELECT user_id FROM items WHERE split = 'test'",
    ("items",),
)
def _(t):
    return setops.only_in(t.items.filter("split = 'train'"), t.items.filter("split = 'test'"), "user_id")
