"""One query for each operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featloom.llm import (
    bitslice, decontaminate, hadamard, importance, line_dedup, line_rules, mixing, prefix_free, prefix_trie, pruned_graph, secrets,
    seed_extend, suffix_tree,
)
from featloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_pivotal_mixing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(documents(spark, folder))


@query("op2_suffix_tree_scores")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.report(documents(spark, folder))


@query("op3_prefix_free_parsing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_free.report(documents(spark, folder))


@query("op4_forest_secret_scan")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(documents(spark, folder))


@query("op5_winnow_decontaminate", decontaminate.SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.report(documents(spark, folder), bench).drop("mark")


@query("op6_importance_resampling")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return importance.report(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op7_deletion_line_dedup", line_dedup.REPORT_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(documents(spark, folder))


@query("op8_bitsliced_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return bitslice.report(documents(spark, folder))


@query("op9_seed_extend_substrings", seed_extend.SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return seed_extend.report(documents(spark, folder))


@query("op10_line_rules", line_rules.REPORT_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.report(documents(spark, folder))


@query("op11_euler_prefix_trie", prefix_trie.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.report(spark.read.parquet(f"{folder}/conversations.parquet"))


@query("op12_hadamard_clusters", hadamard.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return hadamard.report(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op13_pruned_graph_neighbours")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return pruned_graph.report(spark.read.parquet(f"{folder}/embeddings.parquet"))
