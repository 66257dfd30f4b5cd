"""Scans, filters, clean-up, encoders, dates and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded, text_date
from featloom.functions import columns as fx
from featloom.operators import clean, encode, joins, setops
from featloom.plans.sizing import new_folder
from featloom.sources import tables as src

# ---- scans and sinks --------------------------------------------------------


@check("scan_columns_and_dates_a1", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders")
def _(t):
    schema = "o_orderkey bigint, o_orderdate timestamp"
    df = src.read_table(t.spark, f"{t.folder}/orders.parquet", schema, ["o_orderkey", "o_orderdate"], ["o_orderdate"])
    return text_date(df, "o_orderdate")


@check(
    "chunk_cleaning_scan_a2",
    rf"""SELECT doc_id, lang, length(text) AS text_len,
    CASE WHEN text = 'unknown' THEN 0 ELSE len(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> '')) END AS text_word_cnt,
    CASE WHEN text = 'unknown' THEN 0 ELSE len(list_distinct(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> ''))) END AS text_unique_word_cnt,
    {R("COALESCE(text_unique / NULLIF(text_n, 0), 0)", "text_unique_percent")}, quality
    FROM (SELECT *, CAST(len(list_distinct(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> ''))) AS DOUBLE) AS text_unique,
          len(list_filter(regexp_split_to_array(text, '[ \t\r\n]+'), lambda w: w <> '')) AS text_n
          FROM (SELECT doc_id, lang, text, COALESCE(quality, -1) AS quality FROM docs WHERE doc_id IS NOT NULL AND source IS NOT NULL))""",
    ("docs",),
)
def _(t):
    df = src.clean_listing(t.docs, ["text"], ["quality"], ["lang"], ["doc_id", "source"])
    cols = ["doc_id", "lang", "text_len", "text_word_cnt", "text_unique_word_cnt", "text_unique_percent", "quality"]
    return rounded(df.select(*cols), "text_unique_percent")


@check(
    "text_union_of_files_a3",
    """SELECT 'documents' AS source, doc_id AS id, md5(text) AS text_md5 FROM documents
    UNION ALL SELECT 'benchmark', item_id, md5(text) FROM benchmark""",
)
def _(t):
    docs = t.documents.select(F.col("doc_id").alias("id"), "text").withColumn("source", F.lit("documents"))
    bench = t.benchmark.select(F.col("item_id").alias("id"), "text").withColumn("source", F.lit("benchmark"))
    return setops.union_all([docs, bench]).select("source", "id", F.md5("text").alias("text_md5"))


def _store(t):
    return src.FeatureStore(t.spark, new_folder(t.spark, "feature-store"))


@check(
    "feature_store_a4",
    f"SELECT region, {R('AVG(price)', 'avg_price', 4)} FROM items GROUP BY region",
    ("items",),
)
def _(t):
    def build(df):
        return df.groupBy("region").agg(F.avg("price").alias("avg_price"))

    store = _store(t)
    store.get_or_build("region_price", [t.items], build, "mean")
    return rounded(store.get_or_build("region_price", [t.items], build, "mean"), "avg_price", digits=4)


@check(
    "assemble_feature_parts_a5",
    f"""SELECT i.user_id, n_items, {R('avg_price', 'avg_price', 4)} FROM
    (SELECT DISTINCT user_id FROM items) i LEFT JOIN (SELECT user_id, COUNT(*) AS n_items FROM items GROUP BY 1) a USING (user_id)
    LEFT JOIN (SELECT user_id, AVG(price) AS avg_price FROM items GROUP BY 1) b USING (user_id)""",
    ("items",),
)
def _(t):
    users = t.items.select("user_id").distinct()
    parts = [
        t.items.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items")),
        t.items.groupBy("user_id").agg(F.avg("price").alias("avg_price")),
    ]
    return rounded(src.FeatureStore.assemble(users, parts, "user_id"), "avg_price", digits=4)


@check("prediction_sink_a6", "SELECT o_orderkey AS item_id, LEAST(GREATEST(o_totalprice / 100000 - 1, 0), 1) AS pred FROM orders")
def _(t):
    df = t.orders.select(F.col("o_orderkey").alias("item_id"), (F.col("o_totalprice") / 100000 - 1).alias("pred"))
    folder = new_folder(t.spark, "predictions")
    src.write_predictions(df, folder, "item_id", "pred")
    return t.spark.read.parquet(folder)


@check("file_listing_a7")
def _(t):
    bad = t.region.select(F.lower("r_name").alias("id"))
    return src.file_index(t.spark, t.folder, "*.parquet", bad).select("id", "length")


@check("business_row_key_a8", "SELECT o_orderkey AS item_id, o_custkey FROM orders")
def _(t):
    return src.ensure_key(t.orders, "o_orderkey").select(F.col("o_orderkey").alias("item_id"), "o_custkey")


# ---- filters and projections ------------------------------------------------

@check(
    "fill_and_flag_missing_b1_b2",
    """SELECT item_id, COALESCE(param_1, 'unknown') AS param_1, COALESCE(price, -1) AS price,
    CASE WHEN param_1 IS NULL THEN 1 ELSE 0 END AS param_1_is_na, CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price_is_na FROM items""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "param_1", "price")
    return clean.fill_missing(df, {"param_1": "unknown", "price": -1.0}, "_is_na")


@check(
    "guarded_logs_b3",
    f"""SELECT c_custkey, {R('CASE WHEN c_acctbal > 0 THEN ln(1 + c_acctbal) ELSE c_acctbal END', 'log_bal')},
    {R('COALESCE(ln(pos + 0.001), AVG(ln(pos + 0.001)) OVER ())', 'log_filled')},
    {R("exp(CASE WHEN c_acctbal > 0 THEN ln(1 + c_acctbal) ELSE 0 END) - 1", "back", 4)}
    FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS pos FROM customer)""",
)
def _(t):
    bal = F.col("c_acctbal")
    df = t.customer.select("c_custkey", bal.alias("log_bal"), F.when(bal >= 0, bal).alias("log_filled"),
                           F.when(bal > 0, F.log1p(bal)).otherwise(0.0).alias("back"))
    df = clean.log_columns(df, ["log_bal"])
    df = clean.log_columns(df, ["log_filled"], kind="log")
    df = clean.log_columns(df, ["back"], kind="expm1")
    return rounded(rounded(df, "log_bal", "log_filled"), "back", digits=4)


@check(
    "date_windows_b4",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) <= DATE '1999-12-31' THEN 'train' ELSE 'valid' END AS part
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
)
def _(t):
    df = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    ranges = {"train": ("1996-01-01", "1999-12-31"), "valid": ("2000-01-01", "2000-12-31")}
    return clean.split_by_date(df, "d", ranges).drop("d")


@check("rows_with_key_and_target_b5", "SELECT item_id, y FROM items WHERE y IS NOT NULL AND param_1 IS NOT NULL", ("items",))
def _(t):
    return clean.require(t.items, ["y", "param_1"]).select("item_id", "y")


@check(
    "clip_binarize_classes_b6_b7_b8",
    """SELECT item_id, LEAST(GREATEST(2 * y - 0.5, 0), 1) AS clipped, CAST(y > 0.5 AS INT) AS is_high,
    CASE WHEN y = 0 THEN 0 WHEN y = 1 THEN 2 WHEN y IS NOT NULL THEN 1 END AS y_class,
    CAST(floor(y / 0.125 + 0.5) AS INT) AS y_bin FROM items WHERE y IS NOT NULL""",
    ("items",),
)
def _(t):
    y = F.col("y")
    return t.items.filter(y.isNotNull()).select(
        "item_id", fx.clip(y * 2 - 0.5).alias("clipped"), fx.binarize(y).alias("is_high"),
        fx.three_class(y).alias("y_class"), fx.nearest_bin(y).alias("y_bin"),
    )


@check(
    "override_from_lookup_b9",
    """SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN c_acctbal ELSE o_totalprice END AS pred
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(t):
    leak = t.customer.filter("c_acctbal < 0").select("c_custkey", "c_acctbal")
    df = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("pred"))
    return joins.override(df, leak, "c_custkey", "pred").drop("c_custkey")


@check("key_cleanup_b10", "SELECT p_partkey, p_name || '.jpg' AS raw, split_part(p_name || '.jpg', '.', 1) AS image FROM part")
def _(t):
    raw = F.concat("p_name", F.lit(".jpg"))
    return t.part.select("p_partkey", raw.alias("raw"), fx.clean_key(raw).alias("image"))


COLLAPSE = """SELECT item_id, split, CASE WHEN n > {m} AND tr = 1 AND te = 1 THEN v ELSE '{o}' END AS {c} FROM
(SELECT item_id, split, v, COUNT(*) OVER (PARTITION BY v) AS n,
 MAX(CASE WHEN split = 'train' THEN 1 ELSE 0 END) OVER (PARTITION BY v) AS tr,
 MAX(CASE WHEN split = 'test' THEN 1 ELSE 0 END) OVER (PARTITION BY v) AS te
 FROM (SELECT item_id, split, COALESCE(CAST({c} AS VARCHAR), 'nan') AS v FROM items))"""


@check("collapse_unshared_values_b11", COLLAPSE.format(c="image_top_1", m=0, o="others"), ("items",))
def _(t):
    return clean.collapse_rare(t.items.select("item_id", "split", "image_top_1"), ["image_top_1"])


@check("collapse_rare_users_b12", COLLAPSE.format(c="user_id", m=12, o="others_users"), ("items",))
def _(t):
    df = t.items.select("item_id", "split", "user_id")
    return clean.collapse_rare(df, ["user_id"], min_count=12, other="others_users")


@check("hash_sample_b13")
def _(t):
    return clean.hash_sample(t.orders, "o_orderkey", 0.1, seed=7).select("o_orderkey")


@check("drop_constant_columns_b14", "SELECT p_partkey, p_brand FROM part")
def _(t):
    df = t.part.select("p_partkey", "p_brand", F.lit(1).alias("one"), F.lit(None).cast("int").alias("none"))
    return clean.drop_constant(df, ["p_brand", "one", "none"])


@check(
    "downcast_plan_b15",
    "SELECT 'l_linenumber' AS \"column\", 'tinyint' AS type WHERE (SELECT MAX(l_linenumber) FROM lineitem) < 128 "
    "UNION ALL SELECT 'l_orderkey', CASE WHEN MAX(l_orderkey) < 128 THEN 'tinyint' WHEN MAX(l_orderkey) < 32768 THEN 'smallint' ELSE 'int' END FROM lineitem "
    "UNION ALL SELECT 'l_extendedprice', CASE WHEN MAX(l_extendedprice) < 3e38 THEN 'float' ELSE 'double' END FROM lineitem",
)
def _(t):
    df = t.lineitem.select("l_linenumber", "l_orderkey", "l_extendedprice")
    plan = clean.plan_types(df)
    clean.downcast(df, plan)
    # one row per column, joined to the observed ranges
    ranges = clean.column_ranges(df, list(plan))
    lookup = F.create_map(*[F.lit(v) for kv in plan.items() for v in kv])
    return ranges.select("column", lookup[F.col("column")].alias("type"))


@check(
    "columns_above_threshold_b16_powers_b17",
    f"""SELECT item_id, CAST(p1 > 0.5 AS INT) + CAST(p2 > 0.5 AS INT) + CAST(p3 > 0.5 AS INT) AS n_above,
    {R('p1 * p1', 'p1_pow2')}, {R('p1 * p1 * p1', 'p1_pow3')} FROM preds""",
    ("preds",),
)
def _(t):
    df = t.preds.select("item_id", fx.count_above(["p1", "p2", "p3"], 0.5).alias("n_above"), *fx.powers("p1"))
    return rounded(df, "p1_pow2", "p1_pow3")


@check(
    "chronological_holdout_b19",
    """SELECT item_id, CASE WHEN pos <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'valid' END AS part FROM
    (SELECT item_id, row_number() OVER (ORDER BY activation_date, item_id) AS pos, COUNT(*) OVER () AS n FROM items)""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "activation_date")
    return clean.split_by_fraction(df, ["activation_date", "item_id"], 0.7).drop("activation_date")


@check("second_of_day_b18", "SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INT) AS sec FROM events")
def _(t):
    return t.events.select("event_id", fx.second_of_day(F.col("ts")).alias("sec"))


# ---- encoders, bins, scaling --------------------------------------------------


@check(
    "label_codes_n1",
    """SELECT item_id, CAST(dense_rank() OVER (ORDER BY COALESCE(param_1, 'nan')) - 1 AS INT) AS param_1,
    CAST(dense_rank() OVER (ORDER BY city) - 1 AS INT) AS city FROM items""",
    ("items",),
)
def _(t):
    return encode.label_encode(t.items.select("item_id", "param_1", "city"), ["param_1", "city"])


@check(
    "interaction_codes_n2",
    """SELECT item_id, CAST(dense_rank() OVER (ORDER BY region || '_' || COALESCE(param_2, 'nan')) - 1 AS INT) AS region_param_2 FROM items""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", fx.interact(["region", "param_2"]).alias("region_param_2"))
    return encode.label_encode(df, ["region_param_2"])


@check(
    "joined_categories_n3_n4",
    """SELECT item_id, COALESCE(param_1, 'nan') || ' ' || COALESCE(param_2, 'nan') || ' ' || COALESCE(param_3, 'nan') AS params,
    region || '_' || city AS city FROM items""",
    ("items",),
)
def _(t):
    return t.items.select("item_id", fx.interact(["param_1", "param_2", "param_3"], " ").alias("params"),
                          fx.interact(["region", "city"]).alias("city"))


@check(
    "cardinality_split_n5",
    """SELECT c AS "column", n AS "values", CASE WHEN n > 1000 THEN 'high' ELSE 'low' END AS kind FROM
    (SELECT 'user_id' AS c, COUNT(DISTINCT user_id) AS n FROM items UNION ALL SELECT 'param_1', COUNT(DISTINCT param_1) FROM items
     UNION ALL SELECT 'city', COUNT(DISTINCT city) FROM items)""",
    ("items",),
)
def _(t):
    sizes = encode.category_sizes(t.items, ["user_id", "param_1", "city"])
    return sizes.withColumn("kind", F.when(F.col("values") > 1000, "high").otherwise("low"))


@check(
    "one_hot_features_n6",
    """WITH a AS (SELECT item_id, region, COALESCE(param_1, 'nan') AS param_1, COALESCE(price, -1) AS price FROM items),
    c AS (SELECT *, dense_rank() OVER (ORDER BY region) - 1 AS i, dense_rank() OVER (ORDER BY param_1) - 1 AS j FROM a),
    n AS (SELECT COUNT(DISTINCT region) AS nr, COUNT(DISTINCT param_1) AS np FROM a)
    SELECT item_id, CAST(i AS INT) AS cell, 1.0::DOUBLE AS value FROM c UNION ALL SELECT item_id, CAST(nr + 1 + j AS INT), 1.0::DOUBLE FROM c, n
    UNION ALL SELECT item_id, CAST(nr + np + 2 AS INT), price FROM c, n""",
    ("items",),
)
def _(t):
    """Every cell that is not zero, NULL as a category of its own; each block ends with a cell for unseen values."""
    from pyspark.ml.functions import vector_to_array

    df = t.items.select("item_id", "region", "param_1", F.coalesce("price", F.lit(-1.0)).alias("price"))
    hot = encode.one_hot(df, ["region", "param_1"], ["price"])
    cells = hot.select("item_id", F.posexplode(vector_to_array("features")).alias("cell", "value"))
    return cells.where("value <> 0")


BINS = """SELECT item_id, CASE WHEN price IS NULL THEN NULL ELSE GREATEST(len(list_filter(edges, lambda e: e < price)) - 1, 0) END AS price_bin FROM items,
(SELECT list_sort(list_distinct(quantile_cont(price, {probs}))) AS edges FROM items)"""


@check(
    "quantile_bins_n8",
    BINS.format(probs="[" + ", ".join(f"CAST({i} AS DOUBLE) / 80" for i in range(81)) + "]"),
    ("items",),
)
def _(t):
    return encode.quantile_bins(t.items.select("item_id", "price"), "price", 80).drop("price")


def _bin_score_sql(sizes):
    parts = []
    for q in sizes:
        probs = "[" + ", ".join(f"CAST({i} AS DOUBLE) / {q}" for i in range(q + 1)) + "]"
        parts.append(
            f"""SELECT {q} AS n_bins, AVG(sd) AS m FROM (SELECT stddev_samp(y) AS sd FROM (
            SELECT y, GREATEST(len(list_filter(edges, lambda e: e < price)) - 1, 0) AS b FROM items,
            (SELECT list_sort(list_distinct(quantile_cont(price, {probs}))) AS edges FROM items WHERE y IS NOT NULL) e
            WHERE y IS NOT NULL AND price IS NOT NULL) GROUP BY b)"""
        )
    union = " UNION ALL ".join(parts)
    return f"SELECT n_bins, {R('m', 'mean_std')} FROM ({union})"


@check("bin_count_choice_n9", _bin_score_sql([10, 20, 40]), ("items",))
def _(t):
    return rounded(encode.bin_count_scores(t.items, "price", "y", [10, 20, 40]), "mean_std")


@check(
    "standardize_n10",
    f"""SELECT item_id, {R('(price - AVG(price) OVER ()) / stddev_pop(price) OVER ()', 'price')},
    {R('(item_seq_number - AVG(item_seq_number) OVER ()) / stddev_samp(item_seq_number) OVER ()', 'item_seq_number')} FROM items""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "price", "item_seq_number")
    df = encode.standardize(df, ["price"], ddof=0)
    return rounded(encode.standardize(df, ["item_seq_number"], ddof=1), "price", "item_seq_number")


@check(
    "minmax_n11",
    f"""SELECT c_custkey, {R('''CASE WHEN c_acctbal >= 0 THEN (c_acctbal - MIN(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) OVER ())
    / (MAX(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) OVER () - MIN(CASE WHEN c_acctbal >= 0 THEN c_acctbal END) OVER ()) ELSE -1 END''', 'c_acctbal')}
    FROM customer""",
)
def _(t):
    return rounded(encode.minmax(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"]), "c_acctbal")


@check(
    "boxcox_fixed_lambda_n12",
    f"""SELECT c_custkey, {R('(pow(c_acctbal - MIN(c_acctbal) OVER () + 1, 0.25) - 1) / 0.25', 'c_acctbal')} FROM customer""",
)
def _(t):
    return rounded(encode.boxcox_apply(t.customer.select("c_custkey", "c_acctbal"), {"c_acctbal": 0.25}), "c_acctbal")


def _boxcox_sql(grid):
    rows = " UNION ALL ".join(
        f"SELECT CAST({g} AS DOUBLE) AS lam, ({g} - 1) * SUM(ln(x)) - COUNT(*) / 2.0 * ln(var_pop("
        + ("ln(x)" if g == 0 else f"(pow(x, CAST({g} AS DOUBLE)) - 1) / {g}")
        + ")) AS loglik FROM s"
        for g in grid
    )
    return f"""WITH s AS (SELECT c_acctbal - (SELECT MIN(c_acctbal) FROM customer) + 1 AS x FROM customer)
    SELECT lam, {R('loglik', 'loglik', 3)} FROM ({rows})"""


@check("boxcox_lambda_scores_n12", _boxcox_sql([-0.5, 0, 0.25, 0.5, 0.75, 1.0, 1.5]))
def _(t):
    scores = encode.boxcox_scores(t.customer, "c_acctbal", [-0.5, 0, 0.25, 0.5, 0.75, 1.0, 1.5])
    return rounded(scores, "loglik", digits=3)


@check("boxcox_best_lambda_n12")
def _(t):
    lam = encode.boxcox_lambda(t.customer, "c_acctbal")
    return encode.boxcox_scores(t.customer, "c_acctbal", [lam])


@check(
    "missing_outside_range_n13",
    """SELECT item_id, COALESCE(price, -(SELECT MAX(price) FROM items)) AS price FROM items""",
    ("items",),
)
def _(t):
    return encode.fill_outside(t.items.select("item_id", "price"), ["price"])


@check(
    "log10_standardize_n14",
    f"""SELECT item_id, {R('(v - AVG(v) OVER ()) / stddev_pop(v) OVER ()', 'price')} FROM
    (SELECT item_id, COALESCE(log10(price + 1), 0) AS v FROM items)""",
    ("items",),
)
def _(t):
    return rounded(encode.log10_standardize(t.items.select("item_id", "price"), ["price"]), "price")


# ---- dates --------------------------------------------------------------------


@check(
    "date_parts_d1_d2",
    """SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INT) AS weekday, CAST(dayofyear(o_orderdate) AS INT) AS day_of_year,
    CAST(weekofyear(o_orderdate) AS INT) AS iso_week, CAST(day(o_orderdate) AS INT) AS day_of_month FROM orders""",
)
def _(t):
    return t.orders.select("o_orderkey", *fx.date_parts("o_orderdate"))


@check(
    "ad_durations_d3",
    """SELECT item_id, l_linenumber, l_quantity, l_extendedprice, date_diff('day', activation_date, date_from) AS duration_1,
    date_diff('day', activation_date, date_to) AS duration_2, date_diff('day', date_from, date_to) AS duration_3 FROM periods""",
    ("periods",),
)
def _(t):
    return t.periods.select("item_id", "l_linenumber", "l_quantity", "l_extendedprice",
                            *fx.durations("activation_date", "date_from", "date_to"))


@check(
    "join_on_date_d4",
    """SELECT item_id, n FROM items JOIN (SELECT CAST(o_orderdate AS DATE) AS activation_date, COUNT(*) AS n FROM orders GROUP BY 1) USING (activation_date)""",
    ("items",),
)
def _(t):
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("activation_date")).agg(F.count(F.lit(1)).alias("n"))
    return joins.attach(t.items.select("item_id", "activation_date"), daily, "activation_date", weight=None).select("item_id", "n")


# ---- joins ----------------------------------------------------------------------


@check(
    "left_join_j1_j2",
    f"""SELECT item_id, {R('u.m', 'user_price', 4)}, n AS image_city_n FROM items
    LEFT JOIN (SELECT user_id, AVG(price) AS m FROM items GROUP BY 1) u USING (user_id)
    LEFT JOIN (SELECT image_top_1, city, COUNT(*) AS n FROM items GROUP BY 1, 2) USING (image_top_1, city)""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "user_id", "image_top_1", "city")
    users = t.items.groupBy("user_id").agg(F.avg("price").alias("user_price"))
    pairs = t.items.groupBy("image_top_1", "city").agg(F.count(F.lit(1)).alias("image_city_n"))
    out = joins.attach(joins.attach(df, users, "user_id"), pairs, ["image_top_1", "city"])
    return rounded(out.select("item_id", "user_price", "image_city_n"), "user_price", digits=4)


@check(
    "lookup_with_default_j3",
    """SELECT o_orderkey, COALESCE(n, 0) AS n_lines FROM orders LEFT JOIN
    (SELECT l_orderkey, COUNT(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def _(t):
    lines = t.lineitem.filter("l_quantity > 25").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    return joins.attach(t.orders.select("o_orderkey"), lines.agg(F.count(F.lit(1)).alias("n_lines")), "o_orderkey", default=0)


@check(
    "full_join_of_rollups_j4",
    """SELECT k, n_orders, n_lines FROM (SELECT o_custkey AS k, COUNT(*) AS n_orders FROM orders GROUP BY 1)
    FULL JOIN (SELECT l_suppkey AS k, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) USING (k)""",
)
def _(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("n_lines"))
    return joins.full_merge(a, b, "k")


@check(
    "membership_j5",
    """SELECT c_custkey, CAST(c_custkey IN (SELECT o_custkey FROM orders) AS INT) AS c_custkey_in FROM customer""",
)
def _(t):
    return joins.flag_in(t.customer.select("c_custkey"), "c_custkey", t.orders.select(F.col("o_custkey").alias("c_custkey")))


@check("non_members_j5", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(t):
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_in(t.customer.select("c_custkey"), "c_custkey", buyers, negate=True)


@check(
    "lagged_group_mean_j6",
    f"""SELECT item_id, {R('m', 'lagged')} FROM items LEFT JOIN
    (SELECT category_name, activation_date + 1 AS d, AVG(y) AS m FROM items GROUP BY category_name, activation_date) g
    ON items.category_name = g.category_name AND items.activation_date = g.d""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "category_name", "activation_date", "y")
    out = joins.lagged_group_mean(df, ["category_name"], "activation_date", "y", 1, "lagged")
    return rounded(out.select("item_id", "lagged"), "lagged")


@check(
    "keyed_concat_j9",
    "SELECT doc_id, lang, quality, toxic FROM docs",
    ("docs",),
)
def _(t):
    return joins.attach(t.documents.select("doc_id", "lang"), t.labels, "doc_id")
