"""Rasters as tiles in a folder: found by their place, read in windows.

Tiles are text grids in folders tx=.../ty=..., so Spark's partition pruning finds those
that a window touches and no other file is opened. A tile is ncols, nrows, xllcorner,
yllcorner, cellsize, NODATA_value, then the rows from the top.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODATA = -9999.0


def write_tiles(cells: DataFrame, path: str, size: int, width: float = 1.0) -> None:
    """Write cells (col, row, z; row counts upwards, both from any origin) as tiles of size x size; cells that are missing or null have no data."""
    d = cells.select(F.floor(F.col("col") / size).cast("int").alias("tx"), F.floor(F.col("row") / size).cast("int").alias("ty"), F.pmod("col", F.lit(size)).cast("int").alias("i"), F.pmod("row", F.lit(size)).cast("int").alias("j"), F.col("z").cast("double").alias("z"))
    whole = d.groupBy("tx", "ty").agg(F.map_from_entries(F.collect_list(F.struct((F.col("j") * size + F.col("i")).alias("k"), "z"))).alias("m"))
    line = lambda j: F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.element_at("m", (j * size + i).cast("int")), F.lit(NODATA)).cast("string")))
    rows = F.transform(F.sequence(F.lit(size - 1), F.lit(0), F.lit(-1)), line)
    head = F.concat_ws("\n", F.lit(f"ncols {size}"), F.lit(f"nrows {size}"), F.concat(F.lit("xllcorner "), (F.col("tx") * size * width).cast("string")), F.concat(F.lit("yllcorner "), (F.col("ty") * size * width).cast("string")), F.lit(f"cellsize {width}"), F.lit(f"NODATA_value {NODATA}"))
    text = whole.select("tx", "ty", F.concat_ws("\n", head, F.concat_ws("\n", rows)).alias("value"))
    # one file for each tile: its rows lie in one partition, and a partition has one folder for each tile
    text.repartition("tx", "ty").write.partitionBy("tx", "ty").text(path)


def tiles(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, size: int | None = None, width: float = 1.0) -> DataFrame:
    """(tx, ty, path, content) of the tiles of a folder, or of those that a box (xmin, ymin, xmax, ymax) touches; size and width are then those of the tiles."""
    d = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    if box is not None:
        tile = lambda v: int(v // (size * width))
        d = d.where(F.col("tx").between(tile(box[0]), tile(box[2])) & F.col("ty").between(tile(box[1]), tile(box[3])))
    return d.select("tx", "ty", "path", "content")


def cells(found: DataFrame, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(x, y, width, z): lower left corners of the cells of tiles, those that a box touches only; no data is left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            for content in b.column(0).to_pylist():
                lines = content.decode().split("\n")
                head = {k.lower(): float(v) for k, v in (x.split() for x in lines[:6])}
                n, m, w = int(head["ncols"]), int(head["nrows"]), head["cellsize"]
                z = np.array(" ".join(lines[6:]).split(), float).reshape(m, n)[::-1]
                x, y = head["xllcorner"] + w * np.arange(n), head["yllcorner"] + w * np.arange(m)
                i, j = (x > -np.inf), (y > -np.inf)
                if box is not None:
                    i, j = (x <= box[2]) & (x + w >= box[0]), (y <= box[3]) & (y + w >= box[1])
                z, x, y = z[j][:, i], x[i], y[j]
                at, over = np.meshgrid(x, y)
                ok = z != head["nodata_value"]
                yield pa.RecordBatch.from_arrays([pa.array(at[ok]), pa.array(over[ok]), pa.array(np.full(int(ok.sum()), w)), pa.array(z[ok])], names=["x", "y", "width", "z"])

    return found.select("content").mapInArrow(read, "x double, y double, width double, z double")


def bilinear(points: DataFrame, grid: DataFrame, width: float) -> DataFrame:
    """points (id, x, y) plus z, between the middles of the four cells around each, over seams of tiles too; null where one of the four is missing."""
    u, v = F.col("x") / width - 0.5, F.col("y") / width - 0.5
    p = points.withColumns({"i": F.floor(u).cast("bigint"), "j": F.floor(v).cast("bigint")}).withColumns({"fx": u - F.col("i"), "fy": v - F.col("j")})
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])).alias("o")
    asked = p.select("id", "i", "j", "fx", "fy", corner).select("id", (F.col("i") + F.col("o.a")).alias("i"), (F.col("j") + F.col("o.b")).alias("j"), (F.when(F.col("o.a") == 1, F.col("fx")).otherwise(1 - F.col("fx")) * F.when(F.col("o.b") == 1, F.col("fy")).otherwise(1 - F.col("fy"))).alias("part"))
    g = grid.select(F.round(F.col("x") / width).cast("bigint").alias("i"), F.round(F.col("y") / width).cast("bigint").alias("j"), F.col("z").alias("cell"))
    got = asked.join(g, ["i", "j"]).groupBy("id").agg(F.sum(F.col("part") * F.col("cell")).alias("sum"), F.count(F.lit(1)).alias("n"))
    return points.join(got, "id", "left").select(*points.columns, F.when(F.col("n") == 4, F.col("sum")).alias("z"))
