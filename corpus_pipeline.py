"""The training-data pipeline: each stage reads what its predecessor kept.

Cases of the single stages stand in their operators; a stage whose input is
empty hands an empty table on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featloom.llm import decontaminate, line_dedup, line_rules, mixing
from featloom.llm import near_copies as near
from featloom.llm.common import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return line_rules.clean(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, up to one word; those left without words go."""
    return line_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return near.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, numbered in ``mix_copy``."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]
# fingerprints and random rounding have no SQL form; tests/llm compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages, each written below the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
