"""Divided roads: two carriageways of one road become its middle line."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from geoquill.functions import kernels
from geoquill.functions.geometry import azimuth, orientation_difference
from geoquill.operators.arrangement import meeting
from geoquill.operators.gapplan import nearest_on, segments
from geoquill.workspace import Workspace


def pairs(lines: DataFrame, ws: Workspace, distance: float, angle: float = 20.0, share: float = 0.5) -> DataFrame:
    """(a_id, b_id, apart) of lines (line_id, merge_id, line) that run beside each other and choose each other.

    Only lines of equal merge_id, not null and not 0, are compared. Of each line's parts,
    by length, at least `share` must have their middle within distance of a part of the
    other that runs at most `angle` degrees askew, and so the other way round. Of
    several such lines the nearest is chosen, by the mean distance of the middles, then
    by id; only lines that choose each other are a pair. Lines that cross are beside
    each other at their crossing alone, so they never are.
    """
    s = segments(lines.where("merge_id is not null and merge_id <> 0"), "line_id", "merge_id").where("ax <> bx or ay <> by")
    s = s.withColumns({"seg": F.xxhash64("line_id", "part"), "x": (F.col("ax") + F.col("bx")) / 2, "y": (F.col("ay") + F.col("by")) / 2, "len": F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")), "az": azimuth(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))})
    s = ws.put(s, "parts")
    whole = int(distance) + 1
    cell = lambda c: F.col(c).cast("bigint")
    mid = s.select(F.col("seg").alias("key"), (F.floor("x") - whole).cast("bigint").alias("xmin"), (F.floor("y") - whole).cast("bigint").alias("ymin"), (F.ceil("x") + whole).cast("bigint").alias("xmax"), (F.ceil("y") + whole).cast("bigint").alias("ymax"))
    box = s.select(F.col("seg").alias("key"), cell("ax").alias("x1"), F.floor(F.least("ax", "bx")).cast("bigint").alias("xmin"), F.floor(F.least("ay", "by")).cast("bigint").alias("ymin"), F.ceil(F.greatest("ax", "bx")).cast("bigint").alias("xmax"), F.ceil(F.greatest("ay", "by")).cast("bigint").alias("ymax")).drop("x1")
    m = s.select(F.col("seg").alias("a_key"), F.col("line_id").alias("a_id"), "merge_id", "x", "y", "len", F.col("az").alias("a_az"))
    o = s.select(F.col("seg").alias("b_key"), F.col("line_id").alias("b_id"), F.col("merge_id").alias("b_merge"), "ax", "ay", "bx", "by", F.col("az").alias("b_az"))
    p = meeting(mid, box, 2 * whole).join(m, "a_key").join(o, "b_key").where("a_id <> b_id and merge_id = b_merge")
    p = p.where(orientation_difference(F.col("a_az"), F.col("b_az")) <= angle).withColumns(nearest_on("x", "y")).where(F.col("d2") <= distance * distance)
    beside = p.groupBy("a_id", "b_id", "a_key").agg(F.min("d2").alias("d2"), F.first("len").alias("len"))
    total = s.groupBy(F.col("line_id").alias("a_id")).agg(F.sum("len").alias("total"))
    one = beside.groupBy("a_id", "b_id").agg(F.sum("len").alias("covered"), (F.sum(F.col("len") * F.sqrt("d2")) / F.sum("len")).alias("apart")).join(total, "a_id").where(F.col("covered") >= share * F.col("total"))
    one = ws.put(one.select("a_id", "b_id", "apart"), "beside")
    both = one.join(one.select(F.col("a_id").alias("b_id"), F.col("b_id").alias("a_id"), F.col("apart").alias("back")), ["a_id", "b_id"]).withColumn("apart", F.greatest("apart", "back"))
    best = both.groupBy("a_id").agg(F.min(F.struct("apart", "b_id")).alias("m")).select("a_id", F.col("m.b_id").alias("b_id"), F.col("m.apart").alias("apart"))
    return best.join(best.select(F.col("a_id").alias("b_id"), F.col("b_id").alias("a_id")), ["a_id", "b_id"]).where("a_id < b_id").select("a_id", "b_id", "apart")


def middle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The line halfway between two, by shares of their lengths, in the direction of a; a vertex for each of theirs."""
    if np.hypot(*(a[0] - b[0])) + np.hypot(*(a[-1] - b[-1])) > np.hypot(*(a[0] - b[-1])) + np.hypot(*(a[-1] - b[0])):
        b = b[::-1]

    def shares(line):
        along = np.concatenate([[0], np.cumsum(np.hypot(*np.diff(line, axis=0).T))])
        return along / (along[-1] or 1.0)

    t = np.unique(np.round(np.concatenate([shares(a), shares(b)]), 9))
    la, lb = kernels.length(a), kernels.length(b)
    return np.array([(kernels.at(a, x * la) + kernels.at(b, x * lb)) / 2 for x in t])


def _middles():
    @pandas_udf(kernels.LINE)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        points = lambda v: np.array([(p["x"], p["y"]) for p in v], float)
        return pd.Series([[{"x": x, "y": y} for x, y in middle(points(p), points(q)).tolist()] for p, q in zip(a, b, strict=True)])

    return run


def merge_divided(lines: DataFrame, ws: Workspace, distance: float, angle: float = 20.0, share: float = 0.5) -> DataFrame:
    """lines (line_id, merge_id, line) with both lines of each pair replaced by their middle line, which has the smaller line_id; merged tells which these are."""
    two = ws.put(pairs(lines, ws, distance, angle, share), "pairs")
    line_of = lambda p: lines.select(F.col("line_id").alias(f"{p}_id"), F.col("merge_id"), F.col("line").alias(f"{p}_line"))
    new = two.join(line_of("a"), "a_id").join(line_of("b").drop("merge_id"), "b_id").select(F.col("a_id").alias("line_id"), "merge_id", _middles()("a_line", "b_line").alias("line"), F.lit(True).alias("merged"))
    gone = two.select(F.explode(F.array("a_id", "b_id")).alias("line_id"))
    return lines.join(gone, "line_id", "left_anti").select("line_id", "merge_id", "line", F.lit(False).alias("merged")).unionByName(new)
