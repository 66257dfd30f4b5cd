"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: the white space of the contracts, x20 and x09 to x0D
SPACE_CLASS = r"\x20\x09-\x0D"
LAST_ID = 2**63 - 1  # where rows without an id stand in the order of ids
MAX_BITS = 2**27


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only for local[...] masters without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local,")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back, so that lost executors cost only their own tasks."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def words(text: Column) -> Column:
    """Words between white space; NULL text has none."""
    return F.coalesce(F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != ""), F.array().cast("array<string>"))


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of the named columns as Python values, some hundred at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns))


MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each unsigned number (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    return x ^ (x >> np.uint64(31))


def bitmap(hashes: DataFrame, name: str, per: int = 16) -> np.ndarray:
    """A bit for each value of the hash column ``name``: some ``per`` bits a value, at most MAX_BITS (16 MB) in all.

    Spark puts the words together; the driver gets at most MAX_BITS / 64 rows.
    """
    bits, count = 2**16, hashes.count()
    while bits < min(per * count, MAX_BITS):
        bits *= 2
    at = hashes.select(F.col(name).bitwiseAND(F.lit(bits - 1)).alias("b"))
    one = F.expr("shiftleft(1L, cast(b & 63 AS int))")
    table = at.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(one).alias("v")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[table["w"].to_numpy(np.int64)] = table["v"].to_numpy(np.int64).view(np.uint64)
    return out


def may_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each unsigned hash is set: always for values of the bitmap, seldom for others."""
    at = hashes & np.uint64(len(table) * 64 - 1)
    return (table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def near_keys(rows: DataFrame, keys: DataFrame, name: str, per: int = 16) -> DataFrame:
    """``rows`` whose hash column ``name`` may be among those of ``keys``, so that fewer texts are shuffled by the join that follows."""
    bits = rows.sparkSession.sparkContext.broadcast(bitmap(keys.select(name).distinct(), name, per))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(may_hold(bits.value, hashes.view(np.uint64))))

    return rows.mapInArrow(run, rows.schema)


def prefix_sums_by(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with the running sum of each expression in the total order ``order``, the own row included.

    Rows are dealt out by ranges of the order and numbered inside their range; only
    the totals of the ranges, one row for each partition, meet in one task.
    """
    inputs = {f"o_{i}": c for i, c in enumerate(order)} | {f"v_{n}": c for n, c in sums.items()}
    keys = [f"o_{i}" for i in range(len(order))]
    rows = df.withColumns(inputs).repartitionByRange(*keys).withColumn("o_part", F.spark_partition_id())
    rows = stored(rows, "ranges")
    totals = rows.groupBy("o_part").agg(*[F.sum(f"v_{n}").alias(f"t_{n}") for n in sums])
    before = Window.orderBy("o_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("o_part", *[F.coalesce(F.sum(f"t_{n}").over(before), F.lit(0)).alias(f"c_{n}") for n in sums])
    inside = Window.partitionBy("o_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"i_{n}": F.sum(f"v_{n}").over(inside) for n in sums}).join(carry, "o_part")
    return rows.select(*df.columns, *[(F.col(f"i_{n}") + F.col(f"c_{n}")).alias(n) for n in sums])
