"""Partitioned runs: cells own what is centred in them and see a halo around."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.operators.spatial import _cell


def assign(points: DataFrame, size: int, halo: int) -> DataFrame:
    """points with cell (col, row) and owned: one row for each cell that owns a point or has it in its halo."""
    x, y = F.col("x"), F.col("y")
    low = lambda c: F.ceil((c - halo) / size).cast("bigint") - 1  # noqa: E731  a cell has its upper edge for the halo
    out = points.withColumn("col", F.explode(F.sequence(low(x), _cell(x + halo, size)))).withColumn("row", F.explode(F.sequence(low(y), _cell(y + halo, size))))
    dx = F.greatest(F.col("col") * size - x, x - (F.col("col") + 1) * size, F.lit(0))
    dy = F.greatest(F.col("row") * size - y, y - (F.col("row") + 1) * size, F.lit(0))
    owned = (F.col("col") == _cell(x, size)) & (F.col("row") == _cell(y, size))
    return out.withColumn("owned", owned).where(F.col("owned") | (dx * dx + dy * dy <= halo * halo))


def metrics(assigned: DataFrame) -> DataFrame:
    """Counts of owned and halo rows of each cell that owns any, and the owned share in percent."""
    m = assigned.groupBy("col", "row").agg(F.sum(F.col("owned").cast("int")).alias("n_owned"), F.sum((~F.col("owned")).cast("int")).alias("n_halo")).where("n_owned > 0")
    return m.withColumn("owned_percent", F.round(100 * F.col("n_owned") / (F.col("n_owned") + F.col("n_halo")), 2))


def sized_cells(points: DataFrame, limit: int, start: int, halo: int, least: int = 1) -> tuple[int, int]:
    """(size, load): the first size, halving from start, at which no cell holds more than limit rows, halo included, or the least size; load is the most that a cell holds then."""
    size = max(start, least)
    while True:
        most = assign(points, size, halo).groupBy("col", "row").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= limit or size <= least:
            return size, most
        size = max(size // 2, least)


def cell_size(points: DataFrame, limit: int, start: int, halo: int, least: int = 1) -> int:
    """The first size, halving from start, at which no cell holds more than limit rows; an error where even the least size has more."""
    size, most = sized_cells(points, limit, start, halo, least)
    if most > limit:
        raise ValueError(f"cells of {size} hold up to {most} rows, not {limit}")
    return size


def run_partitioned(points: DataFrame, size: int, halo: int, function: Callable, schema: str) -> DataFrame:
    """function(frame of one cell, halo included) on every cell that owns rows; only owned rows of its result stay.

    The result must carry id; rows whose id the cell doesn't own are dropped.
    """

    def run(frame):
        own = frame.loc[frame["owned"], "id"]
        if not len(own):
            return frame.iloc[0:0].reindex(columns=[c.split()[0] for c in schema.split(", ")])
        out = function(frame)
        return out[out["id"].isin(own)]

    return assign(points, size, halo).groupBy("col", "row").applyInPandas(run, schema)


def quad_cells(points: DataFrame, limit: int, size: int, least: int) -> DataFrame:
    """(size, col, row, n) of square cells that hold rows: each is split in four while it holds more than limit and is larger than least.

    size is least times a power of two. Rows are counted once, by cells of the least
    size; larger cells add their counts up, so nothing is read again for a level.
    """
    counts = points.groupBy(_cell(F.col("x"), least).alias("col"), _cell(F.col("y"), least).alias("row")).agg(F.count(F.lit(1)).alias("n"))
    levels = []
    s = least
    while s <= size:
        levels.append(s)
        s *= 2
    # each least cell once for every level, with the sums of the cells around it
    each = counts.withColumn("size", F.explode(F.array(*[F.lit(s).cast("bigint") for s in levels])))
    up = lambda c: F.floor(F.col(c) * least / F.col("size")).cast("bigint")
    cells = each.select("size", up("col").alias("col"), up("row").alias("row"), "n").groupBy("size", "col", "row").agg(F.sum("n").alias("n"))
    half = lambda c: F.floor(F.col(c) / 2).cast("bigint").alias(c)
    parent = cells.where(F.col("n") > limit).select("size", "col", "row")
    # a parent holds at least what its child does, so a cell is reached as soon as its parent is split
    p = parent.select((F.col("size") / 2).cast("bigint").alias("size"), F.col("col").alias("pc"), F.col("row").alias("pr"))
    reached = cells.withColumns({"pc": half("col"), "pr": half("row")}).join(p, ["size", "pc", "pr"], "left_semi").select("size", "col", "row", "n").unionByName(cells.where(F.col("size") == levels[-1]))
    return reached.where((F.col("n") <= limit) | (F.col("size") == least))


def clip(boxes: DataFrame, size: int) -> DataFrame:
    """(id, col, row, x0, y0, x1, y1): the part of each box inside each cell that it shares area with."""
    last = lambda c: F.ceil(F.col(c) / size).cast("bigint") - 1
    out = boxes.withColumn("col", F.explode(F.sequence(_cell(F.col("xmin"), size), last("xmax")))).withColumn("row", F.explode(F.sequence(_cell(F.col("ymin"), size), last("ymax"))))
    return out.select(
        "id", "col", "row", F.greatest("xmin", F.col("col") * size).alias("x0"), F.greatest("ymin", F.col("row") * size).alias("y0"), F.least("xmax", (F.col("col") + 1) * size).alias("x1"), F.least("ymax", (F.col("row") + 1) * size).alias("y1")
    )
