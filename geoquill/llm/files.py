"""Binary files through Spark's own writers and readers, so any store that Spark reaches will do.

Each row of a binary column becomes one piece of the partition's file; the pieces
are divided by a separator that the format knows. Spark commits the files, so a
lost or repeated task leaves no half file behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_pieces(df: DataFrame, path: str, separator: str = "\n", compression: str = "none") -> None:
    """df: one binary column, never null. File part-00007 holds the rows of partition 7."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.option("lineSep", separator).option("compression", compression).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """part (int, number of the partition that wrote the file), content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("part"), "content")
