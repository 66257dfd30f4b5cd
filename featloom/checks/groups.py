"""Group statistics, rollups, profiles and whole-table summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded, text_date
from featloom.functions import text as tx
from featloom.operators import group
from featloom.plans.fusion import Spec


def S(key, on, agg):
    return Spec((key,) if isinstance(key, str) else key, on, agg)


@check(
    "group_features_g1",
    f"""SELECT item_id, category_name_count_price, {R('m', 'category_name_mean_price', 4)}, category_name_nunique_city,
    category_name_max_price, category_name_min_price, {R('s', 'category_name_sum_price', 2)}, {R('sd', 'category_name_std_price', 4)},
    {R('md', 'category_name_median_price', 4)}, {R('cm', 'region_param_1_mean_item_seq_number')} FROM items
    LEFT JOIN (SELECT category_name, COUNT(price) AS category_name_count_price, AVG(price) AS m, COUNT(DISTINCT city) AS category_name_nunique_city,
      MAX(price) AS category_name_max_price, MIN(price) AS category_name_min_price, SUM(price) AS s, stddev_samp(price) AS sd,
      median(price) AS md FROM items GROUP BY 1) USING (category_name)
    LEFT JOIN (SELECT region, param_1, AVG(item_seq_number) AS cm FROM items GROUP BY 1, 2) USING (region, param_1)""",
    ("items",),
)
def _(t):
    aggs = ["count", "mean", "max", "min", "sum", "std", "median"]
    specs = [S("category_name", "price", a) for a in aggs] + [S("category_name", "city", "nunique")]
    specs.append(S(("region", "param_1"), "item_seq_number", "mean"))
    out = group.group_features(t.items.select("item_id", "region", "param_1", "category_name", "city", "price", "item_seq_number"), specs)
    out = out.select("item_id", *[s.name() for s in specs])
    out = rounded(out, "category_name_mean_price", "category_name_std_price", "category_name_median_price", digits=4)
    return rounded(rounded(out, "category_name_sum_price", digits=2), "region_param_1_mean_item_seq_number")


@check(
    "group_features_from_source_g2",
    f"""SELECT o_orderkey, all_o_custkey_count_l_quantity, {R('m', 'all_o_custkey_mean_l_quantity')}, {R('md', 'all_o_custkey_median_l_quantity')}
    FROM orders LEFT JOIN (SELECT o_custkey, COUNT(l_quantity) AS all_o_custkey_count_l_quantity, AVG(l_quantity) AS m, median(l_quantity) AS md
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) USING (o_custkey)""",
)
def _(t):
    owners = t.orders.select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity").join(owners, "o_orderkey")
    specs = [S("o_custkey", "l_quantity", a) for a in ("count", "mean", "median")]
    out = group.group_features(owners, specs, source=lines, mark="all_").drop("o_custkey")
    return rounded(out, "all_o_custkey_mean_l_quantity", "all_o_custkey_median_l_quantity")


# stand-ins for the prediction columns, one of them with gaps
STAND_INS = {"price_pred": "price * 0.9", "price_pred_all": "COALESCE(price, 1000.0)", "ridge_preds": "COALESCE(y, 0.3)"}


def _default_sql():
    by_key = {}
    for s in group.default_specs():
        by_key.setdefault(s.key, []).append(s)
    fn = {"mean": "AVG({c})", "nunique": "COUNT(DISTINCT {c})", "count": "COUNT({c})", "std": "stddev_samp({c})", "sum": "SUM({c})"}
    joins, cols = [], []
    for i, (key, specs) in enumerate(by_key.items()):
        aggs = []
        for s in specs:
            expr = fn[s.agg].format(c=s.on)
            cols.append(R(f"g{i}.{s.name()}", s.name(), 3) if s.agg in ("mean", "std", "sum") else f"g{i}.{s.name()}")
            aggs.append(f"{expr} AS {s.name()}")
        keys = ", ".join(key)
        cond = " AND ".join(f"items.{k} = g{i}.{k}" for k in key)
        joins.append(f"LEFT JOIN (SELECT {keys}, {', '.join(aggs)} FROM items GROUP BY {keys}) g{i} ON {cond}")
    stand_ins = ", ".join(f"{e} AS {n}" for n, e in STAND_INS.items())
    body = ' '.join(joins).replace("FROM items", "FROM rows_")
    return f"WITH rows_ AS (SELECT *, {stand_ins} FROM items) SELECT item_id, {', '.join(cols)} FROM items {body}"


@check("default_feature_list_g3", _default_sql(), ("items",))
def _(t):
    specs = group.default_specs()
    items = t.items.withColumns({n: F.expr(e) for n, e in STAND_INS.items()})
    out = group.group_features(items, specs).select("item_id", *[s.name() for s in specs])
    return rounded(out, *[s.name() for s in specs if s.agg in ("mean", "std", "sum")], digits=3)


@check(
    "category_share_g4",
    f"""SELECT item_id, {R("COALESCE(f, 0)", "share_city_user_type_F")}, {R("COALESCE(o, 0)", "share_city_user_type_O")} FROM items
    LEFT JOIN (SELECT city, AVG(CAST(user_type = 'F' AS INT)) AS f, AVG(CAST(user_type = 'O' AS INT)) AS o FROM items GROUP BY 1) USING (city)""",
    ("items",),
)
def _(t):
    from featloom.operators.joins import attach

    shares = group.category_share(t.items, "city", "user_type", ["F", "O"])
    out = attach(t.items.select("item_id", "city"), shares, "city", default=0.0).drop("city")
    return rounded(out, "share_city_user_type_F", "share_city_user_type_O")


@check(
    "user_profile_vector_g5",
    "SELECT user_id, " + ", ".join(
        R(f"AVG(CAST(category_name = '{v}' AS INT))", f'"category_name_{v}"')
        for v in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    ) + " FROM items GROUP BY user_id",
    ("items",),
)
def _(t):
    out = group.profile_vector(t.items, "user_id", "category_name")
    return out.select("user_id", *[F.round(F.col(f"`{c}`") + 1e-9, 6).alias(c) for c in out.columns if c != "user_id"])


ROLLUP = """WITH per_item AS (SELECT item_id, SUM(date_diff('day', date_from, date_to)) AS days_up_sum, COUNT(*) AS times_put_up FROM periods GROUP BY 1),
users AS (SELECT user_id, AVG(days_up_sum) AS d, AVG(times_put_up) AS t, median(days_up_sum) AS md, median(times_put_up) AS mt, COUNT(*) AS n_user_items
  FROM items LEFT JOIN per_item USING (item_id) GROUP BY 1)"""


@check(
    "activity_rollup_users_g6_g7",
    f"""{ROLLUP} SELECT user_id, {R('d', 'avg_days_up_user')}, {R('t', 'avg_times_up_user')}, n_user_items,
    {R('md', 'med_days_up_user')}, {R('mt', 'med_times_up_user')} FROM users""",
    ("items", "periods"),
)
def _(t):
    users, _ = group.activity_rollup(t.items.select("item_id", "user_id"), t.periods, medians=True)
    return rounded(users, "avg_days_up_user", "avg_times_up_user", "med_days_up_user", "med_times_up_user")


@check(
    "activity_rollup_items_g8",
    f"""{ROLLUP} SELECT item_id, {R('d', 'avg_days_up_user_item')}, {R('t', 'avg_times_up_user_item')}, n_user_items AS n_user_items_item
    FROM per_item JOIN items USING (item_id) JOIN users USING (user_id)""",
    ("items", "periods"),
)
def _(t):
    _, per_item = group.activity_rollup(t.items.select("item_id", "user_id"), t.periods)
    return rounded(per_item, "avg_days_up_user_item", "avg_times_up_user_item")


@check(
    "mean_log_price_g9",
    f"SELECT user_id, category_name, {R('AVG(ln(1 + price))', 'avg_log_price')} FROM items WHERE price IS NOT NULL GROUP BY 1, 2",
    ("items",),
)
def _(t):
    return rounded(group.mean_log_price(t.items, ["user_id", "category_name"]), "avg_log_price")


@check(
    "conditional_stats_g10",
    f"""SELECT c_nationkey, {R('AVG(p)', 'bal_mean')}, {R('median(p)', 'bal_median', 4)}, {R('SUM(p)', 'bal_sum', 3)}, {R('stddev_samp(p)', 'bal_std', 4)},
    COUNT(CASE WHEN bal < 0 THEN 1 END) AS bal_negative
    FROM (SELECT c_nationkey, c_acctbal AS bal, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS p FROM customer) GROUP BY 1""",
)
def _(t):
    df = t.customer.select("c_nationkey", F.col("c_acctbal").alias("bal"))
    good = group.conditional_stats(df, ["c_nationkey"], "bal", ["mean", "median", "sum", "std"], "bal >= 0")
    bad = group.conditional_stats(df, ["c_nationkey"], "bal", ["count"], "bal < 0").withColumnRenamed("bal_count", "bal_negative")
    out = group.merge_groups(good, bad, ["c_nationkey"])
    return rounded(rounded(rounded(out, "bal_mean"), "bal_median", "bal_std", digits=4), "bal_sum", digits=3)


@check(
    "sequence_stats_g11",
    f"""SELECT category_name, {R('AVG(item_seq_number)', 'seq_mean')}, {R('median(item_seq_number)', 'seq_median')}, CAST(SUM(item_seq_number) AS BIGINT) AS seq_sum,
    COUNT(DISTINCT item_seq_number) AS seq_nunique, {R('stddev_samp(item_seq_number)', 'seq_std')} FROM items GROUP BY 1""",
    ("items",),
)
def _(t):
    specs = [Spec(("category_name",), "item_seq_number", a, None, f"seq_{a}") for a in ("mean", "median", "sum", "nunique", "std")]
    return rounded(group.group_stats(t.items, ["category_name"], specs, weight=None), "seq_mean", "seq_median", "seq_std")


@check(
    "cross_counts_g12",
    f"""SELECT 'image_top_1' AS "by", 'param_1' AS "of", MAX(n) AS n_max, MIN(n) AS n_min, {R('stddev_samp(n)', 'n_std')}, {R('median(n)', 'n_median')} FROM
    (SELECT COUNT(DISTINCT param_1) AS n FROM items WHERE image_top_1 IS NOT NULL GROUP BY image_top_1)
    UNION ALL SELECT 'param_1', 'image_top_1', MAX(n), MIN(n), {R('stddev_samp(n)')}, {R('median(n)')} FROM
    (SELECT COUNT(DISTINCT image_top_1) AS n FROM items WHERE param_1 IS NOT NULL GROUP BY param_1)""",
    ("items",),
)
def _(t):
    both = group.cross_counts(t.items, "image_top_1", "param_1").unionByName(group.cross_counts(t.items, "param_1", "image_top_1"))
    return rounded(both, "n_std", "n_median")


@check(
    "per_date_stats_g13",
    f"""WITH p AS (SELECT activation_date, date_diff('day', date_from, date_to) AS duration_3 FROM periods)
    SELECT CAST(activation_date AS VARCHAR) AS activation_date, {R('AVG(duration_3)', 'duration_3_mean')}, {R('median(duration_3)', 'duration_3_median')},
    {R('stddev_samp(duration_3)', 'duration_3_std')}, MIN(duration_3) AS duration_3_min, MAX(duration_3) AS duration_3_max FROM p GROUP BY 1""",
    ("periods",),
)
def _(t):
    df = t.periods.select("activation_date", F.datediff("date_to", "date_from").alias("duration_3"))
    out = group.per_date_stats(df, "activation_date", ["duration_3"], ("mean", "median", "std", "min", "max"))
    return rounded(text_date(out, "activation_date"), "duration_3_mean", "duration_3_median", "duration_3_std")


@check(
    "text_length_by_date_g13",
    f"""SELECT CAST(ts AS VARCHAR) AS day, {R('AVG(w)', 'w_mean')}, {R('stddev_samp(w)', 'w_std')} FROM
    (SELECT CAST(ts AS DATE) AS ts, length(event_type) AS w FROM events) GROUP BY 1""",
)
def _(t):
    df = t.events.select(F.col("ts").cast("date").alias("day"), F.length("event_type").alias("w"))
    return rounded(text_date(group.per_date_stats(df, "day", ["w"], ("mean", "std")), "day"), "w_mean", "w_std")


@check(
    "unique_percent_g14",
    f"""SELECT CAST(activation_date AS VARCHAR) AS activation_date, {R('COUNT(DISTINCT user_id) * 100.0 / COUNT(*)', 'user_id_unique_pct')},
    {R('COUNT(DISTINCT city) * 100.0 / COUNT(*)', 'city_unique_pct')} FROM items GROUP BY 1""",
    ("items",),
)
def _(t):
    out = group.unique_percent(t.items, "activation_date", ["user_id", "city"])
    return rounded(text_date(out, "activation_date"), "user_id_unique_pct", "city_unique_pct")


@check(
    "frequency_encode_g15",
    """SELECT item_id, COALESCE(a.n, 0) AS param_1_cnt, COALESCE(b.n, 0) AS city_cnt FROM items
    LEFT JOIN (SELECT param_1, COUNT(*) AS n FROM items WHERE split = 'train' GROUP BY 1) a USING (param_1)
    LEFT JOIN (SELECT city, COUNT(*) AS n FROM items WHERE split = 'train' GROUP BY 1) b USING (city)""",
    ("items",),
)
def _(t):
    df = t.items.select("item_id", "split", "param_1", "city")
    return group.frequency_encode(df, ["param_1", "city"], F.col("split") == "train").select("item_id", "param_1_cnt", "city_cnt")


@check(
    "user_stats_g16",
    f"""SELECT user_id, {R('COALESCE(AVG(price), 0)', 'price_user_mean', 4)}, {R('COALESCE(stddev_samp(price), 0)', 'price_user_std', 4)},
    COUNT(DISTINCT param_1) + MAX(CASE WHEN param_1 IS NULL THEN 1 ELSE 0 END) AS param_1_user_type_cnt,
    COUNT(DISTINCT category_name) AS category_name_user_type_cnt FROM items WHERE split = 'train' GROUP BY 1""",
    ("items",),
)
def _(t):
    out = group.user_stats(t.items, "user_id", ["price"], ["param_1", "category_name"], "split = 'train'")
    return rounded(out, "price_user_mean", "price_user_std", digits=4)


@check(
    "ad_totals_with_default_g17",
    f"""WITH totals AS (SELECT item_id, COUNT(*) AS times, SUM(date_diff('day', date_from, date_to)) AS days FROM periods GROUP BY 1)
    SELECT item_id, {R('COALESCE(times, (SELECT AVG(times) FROM totals))', 'times')}, {R('COALESCE(days, (SELECT AVG(days) FROM totals))', 'days')}
    FROM items LEFT JOIN totals USING (item_id)""",
    ("items", "periods"),
)
def _(t):
    totals = t.periods.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("times"), F.sum(F.datediff("date_to", "date_from")).alias("days")
    )
    return rounded(group.totals_with_default(t.items.select("item_id"), totals, "item_id", ["times", "days"]), "times", "days")


@check(
    "mode_imputation_g18",
    """WITH counts AS (SELECT city, param_1, COUNT(*) AS n FROM items WHERE param_1 IS NOT NULL GROUP BY 1, 2),
    best AS (SELECT city, param_1 AS fill, row_number() OVER (PARTITION BY city ORDER BY n DESC, param_1) AS r FROM counts)
    SELECT item_id, COALESCE(param_1, fill) AS param_1 FROM items LEFT JOIN (SELECT * FROM best WHERE r = 1) USING (city)""",
    ("items",),
)
def _(t):
    return group.impute_by_group(t.items.select("item_id", "city", "param_1"), "param_1", "city", "mode").select("item_id", "param_1")


@check(
    "median_imputation_g19",
    f"""SELECT item_id, {R('COALESCE(price, m)', 'price', 4)} FROM items LEFT JOIN (SELECT city, median(price) AS m FROM items GROUP BY 1) USING (city)""",
    ("items",),
)
def _(t):
    out = group.impute_by_group(t.items.select("item_id", "city", "price"), "price", "city", "median")
    return rounded(out.select("item_id", "price"), "price", digits=4)


@check(
    "target_nunique_g20_kurtosis_g21",
    f"""SELECT item_id, n AS param_1_nunique_y, {R('k', 'param_1_kurtosis_y')} FROM items
    LEFT JOIN (SELECT param_1, COUNT(DISTINCT y) AS n, kurtosis_pop(y) AS k FROM items GROUP BY 1) USING (param_1)""",
    ("items",),
)
def _(t):
    specs = [S("param_1", "y", "nunique"), S("param_1", "y", "kurtosis")]
    out = group.group_features(t.items.select("item_id", "param_1", "y"), specs).drop("param_1", "y")
    return rounded(out, "param_1_kurtosis_y")


@check(
    "correlations_g22",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})', 'corr')} FROM preds"
        for a, b in [("y", "p1"), ("y", "p2"), ("y", "p3"), ("p1", "p2"), ("p1", "p3"), ("p2", "p3")]
    ),
    ("preds",),
)
def _(t):
    return rounded(group.corr_long(t.preds, ["y", "p1", "p2", "p3"]), "corr")


@check(
    "missing_profile_g23",
    "SELECT \"column\", missing, " + R("missing * 100.0 / (SELECT COUNT(*) FROM items)", "missing_pct") + " FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", COUNT(*) AS missing FROM items WHERE {c} IS NULL" for c in ["param_1", "price", "y"])
    + " UNION ALL SELECT '(any)', COUNT(*) FROM items WHERE param_1 IS NULL OR price IS NULL OR y IS NULL)",
    ("items",),
)
def _(t):
    return rounded(group.null_profile(t.items, ["param_1", "price", "y"]), "missing_pct")


@check("value_counts_g24", "SELECT param_1, COUNT(*) AS n FROM items GROUP BY 1 HAVING COUNT(*) > 30", ("items",))
def _(t):
    return group.value_counts(t.items, "param_1", 30)


@check(
    "histogram_g25",
    """WITH e AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem)
    SELECT CAST(LEAST(floor((l_extendedprice - lo) * 20 / (hi - lo)), 19) AS INT) AS bin, COUNT(*) AS n FROM lineitem, e GROUP BY 1""",
)
def _(t):
    return group.histogram(t.lineitem, "l_extendedprice", 20)


@check(
    "table_scalars_g26",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {R(f'AVG({c})', 'mean', 3)}, {R(f'stddev_samp({c})', 'std', 3)}, {R(f'quantile_cont({c}, 0.25)', 'p25', 3)},
        {R(f'quantile_cont({c}, 0.5)', 'p50', 3)}, {R(f'quantile_cont({c}, 0.75)', 'p75', 3)} FROM lineitem"""
        for c in ["l_extendedprice", "l_quantity"]
    ),
)
def _(t):
    return rounded(group.scalars(t.lineitem, ["l_extendedprice", "l_quantity"]), "mean", "std", "p25", "p50", "p75", digits=3)
