"""Row numbers and running totals over a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquill.workspace import Workspace, partitions


def running_totals(df: DataFrame, ws: Workspace, order: list[str], group: list[str] | None = None, value: str | None = None, n: int | None = None) -> DataFrame:
    """df plus row_no (0-based place in its group, by order) and before (sum of value over earlier rows of the group).

    Rows are range-partitioned by (group, order), numbered inside each partition
    while they stream by, and shifted by the totals of the earlier partitions: one
    small row for each partition and group. A group of any size is spread over as
    many partitions as it fills. Rows that tie in order get consecutive numbers in
    no stated order; null groups count as a group; null values add nothing.
    """
    group = list(group or [])
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__row", T.LongType()), T.StructField("__sum", T.LongType())])
    names, arrow = df.columns, df.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, key, row, total = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            keys = list(zip(*(b.column(names.index(g)).to_pylist() for g in group), strict=True)) if group else [()] * b.num_rows
            values = b.column(names.index(value)).to_pylist() if value else [0] * b.num_rows
            rows, sums = [], []
            for k, v in zip(keys, values, strict=True):
                if k != key:
                    key, row, total = k, 0, 0
                rows.append(row)
                sums.append(total)
                row, total = row + 1, total + (v or 0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(rows, pa.int64()), pa.array(sums, pa.int64())], names=[*names, "__part", "__row", "__sum"])

    n = n or partitions(arrow)
    by = [*group, *order]
    placed = ws.put(df.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(number, schema), "numbered")
    amount = F.coalesce(F.col(value), F.lit(0)).cast("long") if value else F.lit(0).cast("long")
    w = Window.partitionBy(*[f"g{i}" for i in range(len(group))]).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(F.col("__part").alias("p"), *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)]).agg(F.count(F.lit(1)).alias("c"), F.sum(amount).alias("s"))
    shift = parts.select("p", *[f"g{i}" for i in range(len(group))], F.coalesce(F.sum("c").over(w), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("s").over(w), F.lit(0)).alias("sum_before"))
    on = F.col("__part") == F.col("p")
    for i, g in enumerate(group):
        on &= F.col(g).eqNullSafe(F.col(f"g{i}"))
    out = placed.join(shift, on).withColumns({"row_no": F.col("__row") + F.col("rows_before"), "before": F.col("__sum") + F.col("sum_before")})
    return out.select(*names, "row_no", "before")
