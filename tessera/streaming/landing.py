"""Listings that keep landing: counts by event time, with late rows dropped after a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def landed(spark: SparkSession, path: str, schema: StructType | str, per_batch: int = 1000) -> DataFrame:
    """Parquet files of ``path`` as they appear, at most ``per_batch`` at once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Rows of each key in each window of event time."""
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, width).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), *keys, "n")
    )


def appended(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs what has landed into a Parquet table and stops; a rerun continues where it ended."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
