"""Heights on a grid of cells, and the orientation of lines by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(points: DataFrame, cells: DataFrame, width: int, top: int, xmin: int = 0) -> DataFrame:
    """points plus z of the cell (col, row, z) they fall in; row 0 is at the top; null outside."""
    p = points.withColumns({"col": F.floor((F.col("x") - xmin) / width).cast("bigint"), "row": F.floor((F.lit(top) - F.col("y")) / width).cast("bigint")})
    return p.join(cells, ["col", "row"], "left").select(*points.columns, "z")


def orientation(start_z: Column, end_z: Column, anchor: int, confident: int | None = None) -> Column:
    """flip where a line climbs by enough; skip where a height is missing or the difference is small."""
    d = F.abs(start_z - end_z)
    return F.when(start_z.isNull() | end_z.isNull() | (d < anchor) | (d < (anchor if confident is None else confident)), "skip").when(start_z < end_z, "flip").otherwise("keep")


def gate(start_z: Column, end_z: Column, threshold: int) -> Column:
    """Whether a connection may climb from start to end; unknown heights always may."""
    return F.coalesce(end_z - start_z <= threshold, F.lit(True))
