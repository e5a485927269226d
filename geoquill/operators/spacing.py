"""Greedy spacing along lines: a scan that carries what it kept last, without the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoquill.operators.graph import rounds
from geoquill.workspace import Workspace


def spaced(points: DataFrame, ws: Workspace, least: int, large: int) -> DataFrame:
    """id of points (id, line, dist, size) that a scan along each line keeps, in order of (dist, id).

    The scan holds a current point, at first the line's first. A large point (of size
    `large` or more) becomes current, and the current one before it goes unless it is
    large too. A small one goes where it is nearer than `least` to the current one, else
    it becomes current. So each point, were it current, has one successor: the next
    large point or the first far enough, whichever comes first. The currents are the
    points that the first one leads to, found by doubling: a line of any number of
    points takes rounds as its logarithm. Null lines or distances are left out; ids are
    those of one row each.
    """
    p = points.where("line is not null and dist is not null").select("id", "line", "dist", (F.col("size") >= large).alias("big"))
    place = F.struct("dist", "id")
    back = Window.partitionBy("line").orderBy(F.col("dist").desc(), F.col("id").desc())
    after = F.last(F.when(F.col("big"), place), True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    p = p.withColumn("next_big", after).withColumn("first", F.row_number().over(Window.partitionBy("line").orderBy("dist", "id")) == 1)
    # far enough: each point asks once more, at its distance plus the least, for the point at or after that place
    asks = p.select("line", (F.col("dist") + least).alias("dist"), F.lit(0).alias("kind"), "id", "big", "next_big", "first", F.col("dist").alias("own"))
    given = p.select("line", "dist", F.lit(1).alias("kind"), "id", "big", "next_big", "first", F.col("dist").alias("own"))
    w = Window.partitionBy("line").orderBy(F.col("dist").desc(), F.col("kind").desc(), F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    far = asks.unionByName(given).withColumn("far", F.last(F.when(F.col("kind") == 1, place), True).over(w)).where("kind = 0")
    # a distance of 0 would find the point itself or one before it
    far = far.withColumn("far", F.when(F.col("far") > F.struct(F.col("own").alias("dist"), "id"), F.col("far")))
    step = ws.put(far.select("id", "big", "first", F.least("far", "next_big").alias("nxt")).select("id", "big", "first", F.col("nxt.id").alias("nxt")), "steps")
    on, to = ws.put(step.where("first").select("id"), "on"), ws.put(step.where("nxt is not null").select("id", "nxt"), "to")
    for _ in rounds(62):
        more = ws.put(on.unionByName(on.join(to, "id").select(F.col("nxt").alias("id"))).distinct(), "on")
        twice = ws.put(to.join(to.select(F.col("id").alias("nxt"), F.col("nxt").alias("n2")), "nxt").select("id", F.col("n2").alias("nxt")), "to")
        ws.drop(on, to)
        on, to = more, twice
        if to.isEmpty():
            break
    current = step.join(on, "id", "left_semi")
    nxt = step.select(F.col("id").alias("nxt"), F.col("big").alias("next_big"))
    return current.join(nxt, "nxt", "left").where("big or not coalesce(next_big, false)").select("id")


def longest_ladders(members: DataFrame) -> DataFrame:
    """(line, ladder): of the ladders (line, ladder, id) on each line the one with the most members over all lines; ties go to the smaller ladder."""
    size = members.groupBy("ladder").agg(F.count_distinct("id").alias("n"))
    on = members.select("line", "ladder").distinct().join(size, "ladder")
    return on.groupBy("line").agg(F.min(F.struct((-F.col("n")).alias("n"), "ladder")).alias("m")).select("line", F.col("m.ladder").alias("ladder"))
