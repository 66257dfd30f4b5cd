"""The chunked ingest as a stream: cleaning and per-date totals, file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.plans.sizing import new_folder


def read_files(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet", per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder, ``per_trigger`` at a time."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", per_trigger)
        .option("pathGlobFilter", glob)
        .parquet(path)
    )


def daily_stats(rows: DataFrame, ts: str, value: str, key: str, watermark: str | None = None) -> DataFrame:
    """Per date: rows, mean of the non-negative values, and largest value.

    The same function serves a batch and a stream.  With a watermark, finished
    dates leave the state and can be appended.
    """
    clean = rows.dropna(subset=[ts, key]).withColumn("__v", F.when(F.col(value) >= 0, F.col(value)))
    if watermark:
        clean = clean.withWatermark(ts, watermark)
        day = F.window(ts, "1 day").getField("start").cast("date")
    else:
        day = F.col(ts).cast("date")
    return clean.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("__v").alias("mean_value"), F.max("__v").alias("max_value")
    )


def stream_stats(spark: SparkSession, stats: DataFrame, out: str | None = None) -> DataFrame:
    """Run a complete-mode aggregation over what is there now and return its table."""
    out = out or new_folder(spark, "stream")

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/table")

    query = (
        stats.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(replace)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/table")
