"""Table sources and sinks: schemas are checked on load, writes are atomic table directories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where: str | Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Columns and rows of a Parquet table; both reach the scan. A schema, if given, must hold."""
    df = spark.read.parquet(path)
    if schema is not None and (missing := [f for f in schema if f.name not in df.columns or df.schema[f.name].dataType != f.dataType]):
        raise ValueError(f"{path} lacks {missing}")
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all, by column name; columns that some lack are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def update(df: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """df with column replaced where changes (key, column) has a row for the key, also by null; of several rows for a key the greatest value counts, null only where there is no other."""
    new = changes.groupBy(F.col(key).alias("_k")).agg(F.max(F.col(column)).alias("_v"), F.lit(True).alias("_new"))
    return df.join(new, df[key] == F.col("_k"), "left").withColumn(column, F.when(F.col("_new"), F.col("_v")).otherwise(F.col(column))).select(*df.columns)


def delete(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def compare_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """rows_a, rows_b, difference."""
    n = a.agg(F.count(F.lit(1)).alias("rows_a")).crossJoin(b.agg(F.count(F.lit(1)).alias("rows_b")))
    return n.withColumn("difference", F.col("rows_a") - F.col("rows_b"))


def combine(spark: SparkSession, pattern: str) -> DataFrame:
    """All tables whose path matches the pattern, as one."""
    return spark.read.option("mergeSchema", "true").parquet(pattern)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A CSV rule table with header, strings throughout, plus rule_no in file order (one file)."""
    return spark.read.csv(path, header=True).coalesce(1).withColumn("rule_no", F.monotonically_increasing_id())


def validate_catalog(expected: Iterable[str], found: Iterable[str]) -> tuple[set[str], set[str]]:
    """(missing, extra) names."""
    e, f = set(expected), set(found)
    return e - f, f - e


def remaining_units(units: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Units of work that the progress table doesn't list."""
    return units.join(done.select(key).distinct(), key, "left_anti")


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    """df and new rows with some of its columns, in its types; columns they lack are null, columns df lacks are an error."""
    if extra := [c for c in rows.columns if c not in df.columns]:
        raise ValueError(f"no such columns: {extra}")
    return df.unionByName(rows.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in rows.columns]), allowMissingColumns=True)


def geometry_only(df: DataFrame, geometry: list[str], template: T.StructType) -> DataFrame:
    """The geometry of df in the template's columns; its other columns are null."""
    return df.select(*[F.col(f.name) if f.name in geometry else F.lit(None).cast(f.dataType).alias(f.name) for f in template])


def add_columns(df: DataFrame, columns: list[tuple[str, str]], constants: dict[str, object] | None = None) -> DataFrame:
    """df with typed columns, null or of one value each; a column that is there already keeps its values."""
    new = {c: F.lit((constants or {}).get(c)).cast(t) for c, t in columns if c not in df.columns}
    return df.withColumns(new) if new else df


def unique_name(df: DataFrame, name: str) -> str:
    """name, or the first of name_1, name_2, ... that df doesn't have; upper and lower case are the same."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if n.lower() not in taken)


def state(df: DataFrame) -> DataFrame:
    """has_rows and n_rows, one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select((F.col("n_rows") > 0).alias("has_rows"), "n_rows")


def carry(df: DataFrame, other: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """df with chosen columns of other under new names, joined by key; null where other lacks the key. Keys of other are unique."""
    return df.join(other.select(F.col(key).alias("_k"), *[F.col(a).alias(f"_{b}") for a, b in fields.items()]), df[key] == F.col("_k"), "left").select(*[df[c] for c in df.columns], *[F.col(f"_{b}").alias(b) for b in fields.values()])
