"""Decisions that depend on how large an input is."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A plan that reads less than this in all is safe in a single task.
SMALL_BYTES = 32 * 1024 * 1024
# Four splits of files, and the compressed input of a task of costly row work.
FEW_BYTES = 512 * 1024 * 1024
SPLIT_BYTES = 16 * 1024 * 1024


def source_bytes(df: DataFrame) -> int:
    """Size of everything the optimized plan reads (file statistics, no job).

    Catalyst multiplies the sizes of joined inputs, which calls any join large;
    keyed joins and aggregates cannot outgrow their sources that way.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def is_small(df: DataFrame, bound: int = SMALL_BYTES) -> bool:
    return source_bytes(df) <= bound


def spread(df: DataFrame) -> DataFrame:
    """An input that gives each core less than a few full splits is dealt out before costly row work, to all
    cores and by SPLIT_BYTES (a row group is never split by a scan); larger inputs are left alone."""
    cores, size = df.sparkSession.sparkContext.defaultParallelism, source_bytes(df)
    return df.repartition(max(cores, -(-size // SPLIT_BYTES))) if size <= cores * FEW_BYTES else df


def block_count(df: DataFrame) -> int:
    """Blocks for ordered prefixes: as many as the job has shuffle partitions."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, parts)


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; in local mode without that setting, a temporary one for the whole session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster[...] has executors of its own
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    folder = "file://" + tempfile.mkdtemp(prefix="featloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: later plans start from
    its files (whose sizes are known) and survive the loss of executors."""
    folder = new_folder(df.sparkSession, "stage")
    df.write.parquet(folder)
    out = df.sparkSession.read.parquet(folder)
    out._written_to = folder
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete the files of frames that ``cut_lineage`` returned and nothing reads any more (others are left alone).

    Shuffle files go when the driver's JVM finds that no plan refers to them, which without the collection
    below may be many rounds later.
    """
    for df in frames:
        folder = None if df is None else df.__dict__.pop("_written_to", None)
        if folder:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    spark = SparkSession.getActiveSession()
    if spark is not None:
        spark._jvm.java.lang.System.gc()
