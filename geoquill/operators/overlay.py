"""Overlay of boxes and grid cells, dissolve, and tables of attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoquill.operators.cells import connected_cells, shared_sides
from geoquill.operators.graph import connected_components
from geoquill.operators.spatial import box_pairs, outer_boxes
from geoquill.workspace import Workspace


def intersections(a: DataFrame, b: DataFrame, size: int = 200) -> DataFrame:
    """(a_id, b_id, x0, y0, x1, y1, area) of overlaps with area."""
    return box_pairs(a, b, size, touch=False).select("a_id", "b_id", "x0", "y0", "x1", "y1", ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))


def largest_overlap(a: DataFrame, b: DataFrame, size: int = 200) -> DataFrame:
    """(a_id, b_id, area): of each box the one that covers most of it; ties by the smaller id."""
    return intersections(a, b, size).groupBy("a_id").agg(F.max(F.struct("area", (-F.col("b_id")).alias("n"))).alias("m")).select("a_id", (-F.col("m.n")).alias("b_id"), F.col("m.area").alias("area"))


def dissolve_boxes(boxes: DataFrame, ws: Workspace, by: str | None = None, size: int = 200) -> DataFrame:
    """(id, part): connected boxes, of equal `by` if given; part is the smallest id."""
    if not by:
        # boxes of one corner meet there, and what meets one of them meets one of the outer ones
        outer = outer_boxes(boxes)
        pairs = box_pairs(outer, outer, size).where("a_id < b_id").select("a_id", "b_id")
        first = boxes.where("xmin <= xmax and ymin <= ymax").groupBy("xmin", "ymin").agg(F.min("id").alias("b_id"))
        pairs = pairs.unionByName(boxes.where("xmin <= xmax and ymin <= ymax").join(first, ["xmin", "ymin"]).where("id <> b_id").select(F.col("id").alias("a_id"), "b_id"))
    else:
        pairs = box_pairs(boxes, boxes, size).where("a_id < b_id").select("a_id", "b_id")
        k = boxes.select("id", F.col(by).alias("k"))
        pairs = pairs.join(k.toDF("a_id", "ka"), "a_id").join(k.toDF("b_id", "kb"), "b_id").where("ka <=> kb").select("a_id", "b_id")
    of = connected_components(pairs, ws, "a_id", "b_id")
    return boxes.select("id").join(of, "id", "left").select("id", F.coalesce("component", "id").alias("part"))


def cell_neighbours(cells: DataFrame) -> DataFrame:
    """(id, other) of grid cells (id, col, row) that share an edge."""
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    a = cells.select("id", "col", "row", o.alias("o")).select("id", (F.col("col") + F.col("o.i")).alias("col"), (F.col("row") + F.col("o.j")).alias("row"))
    return a.join(cells.select(F.col("id").alias("other"), "col", "row"), ["col", "row"]).select("id", "other")


def dissolve_cells(cells: DataFrame, ws: Workspace, by: str = "category") -> DataFrame:
    """(id, part): connected cells of equal category; part is the smallest id."""
    return connected_cells(cells.select("id", "col", "row", by), ws, by).select("id", "part")


def eliminate_small(cells: DataFrame, parts: DataFrame, least: int, by: str = "category") -> DataFrame:
    """(id, category): parts of fewer than `least` cells take the category of the neighbour part with the longest shared border.

    Ties go to the smaller part. Parts without a neighbour large enough stay.
    """
    c = cells.join(parts, "id")
    n = c.groupBy("part", by).agg(F.count(F.lit(1)).alias("n"))
    border = shared_sides(c, cells.count()).where("part <> other").select("part", F.col("other").alias("other_part"), "len")
    small = n.where(F.col("n") < least).select("part")
    big = n.where(F.col("n") >= least).select(F.col("part").alias("other_part"), F.col(by).alias("new"))
    best = border.join(small, "part", "left_semi").join(big, "other_part").groupBy("part").agg(F.max(F.struct("len", (-F.col("other_part")).alias("o"), "new")).alias("m")).select("part", F.col("m.new").alias("new"))
    return c.join(best, "part", "left").select("id", F.coalesce("new", by).alias(by))


def wildcard_rules(df: DataFrame, rules: DataFrame, keys: list[str], rule_keys: list[str]) -> DataFrame:
    """df plus new_class and pass of the first rule (rule_no) whose keys are equal or *; the first key's value and null without one.

    The first key is an equi-join, so rules are only tried against rows they may match.
    """
    r = rules.select("rule_no", "new_class", "pass", *[F.col(k).alias(f"_{k}") for k in rule_keys])
    on = df[keys[0]] == F.col(f"_{rule_keys[0]}")
    for k, rk in zip(keys[1:], rule_keys[1:], strict=True):
        on &= (F.col(f"_{rk}") == "*") | (F.col(f"_{rk}") == df[k])
    hit = df.join(r, on).groupBy("id").agg(F.min(F.struct("rule_no", "new_class", "pass")).alias("m"))
    return df.join(hit, "id", "left").select(*df.columns, F.coalesce("m.new_class", keys[0]).alias("new_class"), F.col("m.pass").alias("pass"))


def overlap_counts(cells: DataFrame, least: int) -> DataFrame:
    """(col, row, n) of cells that at least so many features cover."""
    return cells.groupBy("col", "row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def count_features(a: DataFrame, b: DataFrame, size: int = 200) -> DataFrame:
    """a's ids with join_count and the smallest matching id; boxes without a match have 0 and null."""
    m = box_pairs(a, b, size).groupBy(F.col("a_id").alias("id")).agg(F.count(F.lit(1)).alias("join_count"), F.min("b_id").alias("first_id"))
    return a.select("id").join(m, "id", "left").select("id", F.coalesce("join_count", F.lit(0)).alias("join_count"), "first_id")


def top_one(df: DataFrame, group: list[str], order: list) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def covered_cells(boxes: DataFrame, size: int) -> DataFrame:
    """(id, col, row) of grid cells that a box meets with area."""
    last = lambda c: F.ceil(F.col(c) / size).cast("bigint") - 1
    first = lambda c: F.floor(F.col(c) / size).cast("bigint")
    out = boxes.select("id", "ymin", "ymax", F.explode(F.sequence(first("xmin"), last("xmax"))).alias("col"))
    return out.select("id", "col", F.explode(F.sequence(first("ymin"), last("ymax"))).alias("row"))


def erase(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells (id, col, row) outside the mask's."""
    return cells.join(mask.select("col", "row").distinct(), ["col", "row"], "left_anti").select("id", "col", "row")


def identity(cells: DataFrame, other: DataFrame) -> DataFrame:
    """(id, col, row, other): each cell with every feature of other that covers it, or null."""
    return cells.join(other.select(F.col("id").alias("other"), "col", "row"), ["col", "row"], "left").select("id", "col", "row", "other")
