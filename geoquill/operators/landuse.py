"""Land use on grid cells: small parts by a least size for each category, holes, cells without category, attributes of what was dissolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.operators.cells import connected_cells, shared_sides
from geoquill.workspace import Workspace

NONE = "\0none"


def parts(cells: DataFrame, ws: Workspace, by: str = "category") -> DataFrame:
    """cells plus part: connected cells of equal category (null is one), named by the smallest id."""
    d = cells.withColumn("gq_k", F.coalesce(F.col(by), F.lit(NONE)))
    return ws.put(connected_cells(d, ws, "gq_k").drop("gq_k"), "parts")


def borders(whole: DataFrame) -> DataFrame:
    """(part, other, len): length of the border between two parts; other is null for the border to where no cells are."""
    near = shared_sides(whole)
    inner = near.where("part <> other")
    sides = near.groupBy("part").agg(F.sum("len").alias("n"))
    open_ = whole.groupBy("part").agg((4 * F.count(F.lit(1))).alias("every")).join(sides, "part", "left").select("part", F.lit(None).cast("bigint").alias("other"), (F.col("every") - F.coalesce("n", F.lit(0))).alias("len")).where("len > 0")
    return inner.unionByName(open_)


def _given(whole: DataFrame, losers: DataFrame, border: DataFrame, by: str) -> DataFrame:
    """Category of each losing part (part): that of the neighbour with the longest border, then of the smaller part; losers and parts without category give none."""
    # a part has the name of one of its cells
    kind = whole.where("id = part").select(F.col("part").alias("other"), F.col(by).alias("new")).where("new is not null")
    b = border.where("other is not null").join(losers, "part", "left_semi").join(losers.select(F.col("part").alias("other")), "other", "left_anti").join(kind, "other")
    return b.groupBy("part").agg(F.max(F.struct("len", (-F.col("other")).alias("o"), "new")).alias("m")).select("part", F.col("m.new").alias("gq_new"))


def _recoloured(whole: DataFrame, given: DataFrame, ws: Workspace, by: str) -> DataFrame:
    d = whole.join(given, "part", "left").withColumn(by, F.coalesce("gq_new", by)).drop("gq_new", "part")
    return ws.put(d, "cells")


def eliminate_by_category(cells: DataFrame, least: dict[str, int], ws: Workspace, by: str = "category") -> DataFrame:
    """cells (id, col, row, category) after one pass for each category of `least`, in its order: parts of that category of fewer cells take the category of the neighbour with the longest border.

    A later pass sees what the earlier ones made, so grown parts count whole. Small
    parts with no neighbour of another kind stay.
    """
    for kind, n in least.items():
        whole = parts(cells, ws, by)
        small = whole.where(F.col(by) == kind).groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < n).select("part")
        new = _recoloured(whole, _given(whole, small, borders(whole), by), ws, by)
        ws.drop(cells, whole)
        cells = new
    return cells


def fill_holes(cells: DataFrame, most: int, ws: Workspace, by: str = "category") -> DataFrame:
    """cells whose holes of at most `most` cells have the category around them: a hole is a part with one neighbour part only, and none of the border where cells end."""
    whole = parts(cells, ws, by)
    b = ws.put(borders(whole), "borders")
    alone = b.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("other").isNull()).alias("open")).where("n = 1 and not open").select("part")
    holes = whole.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).join(alone, "part").select("part")
    return _recoloured(whole, _given(whole, holes, b, by), ws, by)


def fill_missing(cells: DataFrame, ws: Workspace, by: str = "category") -> DataFrame:
    """cells without category take that of the neighbour with the longest border of their part."""
    whole = parts(cells, ws, by)
    return _recoloured(whole, _given(whole, whole.where(F.col(by).isNull()).select("part").distinct(), borders(whole), by), ws, by)


def restored(whole: DataFrame, attributes: DataFrame, keep: list[str]) -> DataFrame:
    """(part, keep) of parts of cells (id, part): the attributes (id, keep) that most of the part's cells have together, of equally many those of the smallest id."""
    d = whole.select("id", "part").join(attributes.select("id", *keep), "id")
    n = d.groupBy("part", *keep).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return n.groupBy("part").agg(F.max(F.struct("n", (-F.col("first")).alias("o"), *keep)).alias("m")).select("part", *[F.col(f"m.{k}").alias(k) for k in keep])
