"""Scans, unions, the feature store and the prediction sink."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.functions.columns import clip
from featloom.plans.skew import keyed_left_join


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    columns: list[str] | None = None,
    dates: list[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Scan with a declared schema, a column subset and date parsing."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("csv needs a declared schema")
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if columns:
        df = df.select(*columns)
    return df.withColumns({c: F.to_date(c) for c in dates})


def read_union(
    spark: SparkSession,
    paths: dict[str, str],
    columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """One frame over several files; ``source`` names the file a row is from."""
    parts = [
        read_table(spark, path, columns=columns, **options).withColumn("source", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def clean_listing(df: DataFrame, text_cols: list[str], number_cols: list[str], label_cols: list[str],
                  required: list[str], drop_text: bool = True) -> DataFrame:
    """Ingest cleaning: rows without the required keys go, gaps are filled, and
    texts are replaced by length, word, unique-word and unique-share columns.
    A text equal to 'unknown' has no words."""
    df = df.dropna(subset=required)
    df = df.fillna({c: "unknown" for c in label_cols + text_cols}).fillna({c: -1 for c in number_cols})
    for c in text_cols:
        words = F.filter(F.split(F.col(c), r"[ \t\r\n]+"), lambda w: w != "")
        unknown = F.col(c) == "unknown"
        total = F.when(unknown, 0).otherwise(F.size(words))
        unique = F.when(unknown, 0).otherwise(F.size(F.array_distinct(words)))
        df = df.withColumns(
            {
                f"{c}_len": F.length(c),
                f"{c}_word_cnt": total,
                f"{c}_unique_word_cnt": unique,
                f"{c}_unique_percent": F.coalesce(F.try_divide(unique, total), F.lit(0.0)),
            }
        )
    return df.drop(*text_cols) if drop_text else df


class FeatureStore:
    """Parquet folder per feature family, rebuilt when inputs or spec change."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _stamp(self, inputs: list[DataFrame], spec: object) -> str:
        """Hash of the inputs' plans (without the numbers Spark gives columns), of their files with sizes and times, and of the spec."""
        plans = [re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString()) for df in inputs]
        files = sorted({f for df in inputs for f in df.inputFiles()})
        state = None
        if files:
            listed = self.spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
            state = listed.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
        text = json.dumps([files, plans, [str(x) for x in state or ()], [df.schema.json() for df in inputs], spec], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def _read(self, folder: str) -> DataFrame | None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        done = hadoop.Path(f"{folder}/_SUCCESS")
        fs = done.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return self.spark.read.parquet(folder) if fs.exists(done) else None

    def get_or_build(
        self, name: str, inputs: list[DataFrame], build: Callable[..., DataFrame], spec: object = None
    ) -> DataFrame:
        """The stored family when its stamp matches, else build, write and read it."""
        folder = f"{self.path}/{name}/{self._stamp(inputs, spec)}"
        stored = self._read(folder)
        if stored is not None:
            return stored
        build(*inputs).write.mode("overwrite").parquet(folder)
        return self.spark.read.parquet(folder)

    @staticmethod
    def assemble(base: DataFrame, parts: list[DataFrame], key: str) -> DataFrame:
        """Keyed left joins of feature families, in place of positional concat."""
        for part in parts:
            base = keyed_left_join(base, part, [key])
        return base


def predictions(df: DataFrame, id_col: str, pred_col: str, bounds=(0.0, 1.0)) -> DataFrame:
    return df.select(id_col, clip(F.col(pred_col), *bounds).alias(pred_col))


def write_predictions(df: DataFrame, path: str, id_col: str, pred_col: str, bounds=(0.0, 1.0), fmt="parquet"):
    """(id, clipped prediction), written in parallel."""
    writer = predictions(df, id_col, pred_col, bounds).write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def file_index(spark: SparkSession, path: str, glob: str, bad_ids: DataFrame | None = None) -> DataFrame:
    """Listing (id, path, length, modified) of binary files; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
        .withColumn("id", F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1))
    )
    if bad_ids is not None:
        files = files.join(bad_ids.select("id").distinct(), "id", "left_anti")
    return files.select("id", "path", "length", "modificationTime")


def ensure_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Fail when ``key`` is not a row id (NULL or repeated)."""
    keys = [key] if isinstance(key, str) else key
    missing = df.filter(" OR ".join(f"`{k}` IS NULL" for k in keys)).limit(1)
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(1)
    if missing.count() or repeated.count():
        raise ValueError(f"{keys} is not a row key")
    return df


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Word-vector text file, one ``word v1 v2 ...`` per line."""
    parts = F.split(F.rtrim("value"), " ")
    return spark.read.text(path).select(
        parts[0].alias("word"),
        F.transform(F.slice(parts, 2, F.size(parts) - 1), lambda v: v.cast("float")).alias("vector"),
    )
