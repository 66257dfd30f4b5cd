"""The driver tables in the shape of listings, ad periods and labelled texts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_AT = "2000-07-01 00:00:00"


class Tables:
    """Lazy access to one data folder: ``t.orders``, ``t.items`` and so on."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def line_by_order(self) -> DataFrame:
        lines = self.read("lineitem").join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return lines.groupBy("l_orderkey").agg(
            F.min("p_brand").alias("param_1"),
            F.min("p_type").alias("param_2"),
            F.min("p_size").cast("string").alias("param_3"),
            F.min("l_suppkey").cast("int").alias("image_top_1"),
            F.max("l_linenumber").alias("item_seq_number"),
            (
                F.sum(F.round(F.col("l_discount") * 100).cast("int"))
                / (F.count(F.lit(1)).cast("double") * 10)
            ).alias("y_all"),
        )

    @cached_property
    def items(self) -> DataFrame:
        places = self.read("nation").join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        owners = self.read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        train = F.col("o_orderdate") < F.lit(SPLIT_AT).cast("timestamp")
        rows = (
            self.read("orders")
            .join(owners, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.line_by_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        )
        return rows.select(
            F.col("o_orderkey").alias("item_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("parent_category_name"),
            F.col("o_orderpriority").alias("category_name"),
            F.col("o_orderstatus").alias("user_type"),
            "param_1",
            "param_2",
            "param_3",
            "image_top_1",
            "item_seq_number",
            F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("price"),
            F.col("o_orderdate").cast("date").alias("activation_date"),
            F.when(train, "train").otherwise("test").alias("split"),
            F.when(train, F.col("y_all")).alias("y"),
            ((F.col("o_orderkey") * 31 + F.col("o_custkey") * 17) % 5).alias("fold"),
        )

    @cached_property
    def periods(self) -> DataFrame:
        rows = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return rows.select(
            F.col("l_orderkey").alias("item_id"),
            F.col("o_orderdate").cast("date").alias("activation_date"),
            F.least("o_orderdate", "l_shipdate").cast("date").alias("date_from"),
            F.greatest("o_orderdate", "l_shipdate").cast("date").alias("date_to"),
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
        )

    @cached_property
    def docs(self) -> DataFrame:
        return self.read("documents").join(self.read("labels"), "doc_id", "left")

    @cached_property
    def preds(self) -> DataFrame:
        """Train items with three stand-in model columns: mean y by region,
        category and brand (items without a line have none)."""
        items = self.items.filter("split = 'train' AND y IS NOT NULL AND param_1 IS NOT NULL")
        for name, key in (("p1", "region"), ("p2", "category_name"), ("p3", "param_1")):
            items = items.join(items.groupBy(key).agg(F.avg("y").alias(name)), key)
        return items.select("item_id", "fold", "y", "p1", "p2", "p3")


# The same views as common table expressions, for the comparison SQL.
VIEW_SQL = {
    "line_by_order": """
SELECT l_orderkey, MIN(p_brand) AS param_1, MIN(p_type) AS param_2, CAST(MIN(p_size) AS STRING) AS param_3,
       CAST(MIN(l_suppkey) AS INT) AS image_top_1, MAX(l_linenumber) AS item_seq_number,
       SUM(CAST(ROUND(l_discount * 100) AS INT)) / (CAST(COUNT(*) AS DOUBLE) * 10) AS y_all
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "items": """
SELECT o_orderkey AS item_id, o_custkey AS user_id, r_name AS region, n_name AS city,
       c_mktsegment AS parent_category_name, o_orderpriority AS category_name, o_orderstatus AS user_type,
       param_1, param_2, param_3, image_top_1, item_seq_number,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price,
       CAST(o_orderdate AS DATE) AS activation_date,
       CASE WHEN o_orderdate < TIMESTAMP '2000-07-01 00:00:00' THEN 'train' ELSE 'test' END AS split,
       CASE WHEN o_orderdate < TIMESTAMP '2000-07-01 00:00:00' THEN y_all END AS y,
       (o_orderkey * 31 + o_custkey * 17) % 5 AS fold
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey LEFT JOIN line_by_order ON o_orderkey = l_orderkey""",
    "periods": """
SELECT l_orderkey AS item_id, CAST(o_orderdate AS DATE) AS activation_date,
       CAST(LEAST(o_orderdate, l_shipdate) AS DATE) AS date_from,
       CAST(GREATEST(o_orderdate, l_shipdate) AS DATE) AS date_to,
       l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "docs": """
SELECT doc_id, text, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""",
    "train_y": """
SELECT item_id, fold, y, region, category_name, param_1 FROM items
WHERE split = 'train' AND y IS NOT NULL AND param_1 IS NOT NULL""",
    "preds": """
SELECT item_id, fold, y, AVG(y) OVER (PARTITION BY region) AS p1,
       AVG(y) OVER (PARTITION BY category_name) AS p2, AVG(y) OVER (PARTITION BY param_1) AS p3 FROM train_y""",
}
NEEDS = {
    "items": ["line_by_order"],
    "train_y": ["line_by_order", "items"],
    "preds": ["line_by_order", "items", "train_y"],
}


def with_views(names: list[str], body: str) -> str:
    """``body`` preceded by the common table expressions it uses."""
    ordered: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    ctes = ", ".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in ordered)
    body = body.strip()
    if not ordered:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
