"""Event tables as streams: windowed counts with a watermark, and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed_counts(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, event_type, n, total of each window; rows later than the watermark don't count in a stream."""
    g = (events.withWatermark("ts", late) if events.isStreaming else events).groupBy(F.window("ts", size), "event_type")
    return g.agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
