"""Networks without short cycles: of every cycle the line of highest rank goes, so what was connected stays connected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoquill.operators.graph import rounds
from geoquill.operators.network import degrees, ends
from geoquill.workspace import Workspace


def _sides(lines: DataFrame, rank: str, length: str) -> DataFrame:
    """(a, b, r, w), both ways: the line of lowest rank between two nodes, and its length; a and b with their degrees before them."""
    d = degrees(lines.select("line_id", "src", "dst")).select(F.col("node").alias("n"), F.struct("degree", F.col("n")).alias("at"))
    e = lines.where("src <> dst").select(F.least("src", "dst").alias("s"), F.greatest("src", "dst").alias("t"), F.struct(F.col(rank).alias("rank"), "line_id").alias("r"), F.col(length).alias("w"))
    e = e.groupBy("s", "t").agg(F.min(F.struct("r", "w")).alias("l"))
    e = e.join(d.select(F.col("n").alias("s"), F.col("at").alias("a")), "s").join(d.select(F.col("n").alias("t"), F.col("at").alias("b")), "t").select("a", "b", "l.r", "l.w")
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "r", "w"))


def _wedges(sides: DataFrame) -> DataFrame:
    """(y, z, top, w): two lines y - mid - z, the higher rank of the two and their length. z is above mid and y by degree, so hubs end wedges and aren't in their middle."""
    up = sides.where("b > a").select(F.col("a").alias("mid"), F.col("b").alias("z"), F.col("r").alias("r1"), F.col("w").alias("w1"))
    other = sides.select(F.col("a").alias("mid"), F.col("b").alias("y"), F.col("r").alias("r2"), F.col("w").alias("w2"))
    return up.join(other, "mid").where("y < z").select("y", "z", F.greatest("r1", "r2").alias("top"), (F.col("w1") + F.col("w2")).alias("w"))


def cycle_losers(lines: DataFrame, size: int, rank: str, longest: int, length: str = "length_cm") -> DataFrame:
    """(line_id): of each cycle of size (1 to 4) lines and at most that length the line of highest rank, ties by the greatest line_id.

    Of parallel lines only that of lowest rank takes part in cycles of three and four; in
    cycles of two every line that is parallel to a lower one. Null ends, ranks and lengths make no cycle.
    """
    whole = lines.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & F.col(rank).isNotNull() & F.col(length).isNotNull())
    if size == 1:
        return whole.where((F.col("src") == F.col("dst")) & (F.col(length) <= longest)).select("line_id")
    if size == 2:
        lower = Window.partitionBy(F.least("src", "dst"), F.greatest("src", "dst")).orderBy(rank, "line_id").rowsBetween(Window.unboundedPreceding, -1)
        return whole.where("src <> dst").withColumn("gq_low", F.min(length).over(lower)).where(F.col("gq_low") + F.col(length) <= longest).select("line_id")
    sides = _sides(whole, rank, length)
    w = _wedges(sides).where(F.col("w") <= longest)
    if size == 3:
        closing = sides.where("b > a").select(F.col("a").alias("y"), F.col("b").alias("z"), F.col("r").alias("r3"), F.col("w").alias("w3"))
        lost = w.join(closing, ["y", "z"]).where(F.col("w") + F.col("w3") <= longest).select(F.greatest("top", "r3").alias("r"))
    else:
        # a wedge is beaten by the shortest of those that join the same nodes with lower ranks
        before = Window.partitionBy("y", "z").orderBy("top").rowsBetween(Window.unboundedPreceding, -1)
        lost = w.withColumn("low", F.min("w").over(before)).where(F.col("low") + F.col("w") <= longest).select(F.col("top").alias("r"))
    return lost.select("r.line_id").distinct()


def without_cycles(lines: DataFrame, ws: Workspace, rank: str, longest: int, length: str = "length_cm", limit: int | None = None) -> DataFrame:
    """lines without those that close short cycles of one, two, three and four lines, in this order; each size is repeated until none is left.

    A removed line is the highest of a cycle, so a spanning forest of the lowest ranks stays whole.
    """
    cur = ws.put(lines, "lines")
    for size in (1, 2, 3, 4):
        for _ in rounds(limit):
            gone = ws.put(cycle_losers(cur, size, rank, longest, length), "gone")
            if gone.isEmpty():
                break
            new = ws.put(cur.join(gone, "line_id", "left_anti").select(*lines.columns), "lines")
            ws.drop(cur, gone)
            cur = new
    return cur


def thinned(lines: DataFrame, ws: Workspace, rank: str, keep: int, longest: int, least: int, length: str = "length_cm", limit: int | None = None) -> DataFrame:
    """lines without short cycles and then, until nothing changes, without dead ends shorter than least whose rank is above keep."""
    cur = without_cycles(lines, ws, rank, longest, length, limit)
    for _ in rounds(limit):
        dead = ends(cur).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("line_id")).where("n = 1").select("line_id").distinct()
        gone = ws.put(cur.where((F.col(rank) > keep) & (F.col(length) < least)).select("line_id").join(dead, "line_id", "left_semi"), "gone")
        if gone.isEmpty():
            return cur
        new = ws.put(cur.join(gone, "line_id", "left_anti").select(*lines.columns), "lines")
        ws.drop(cur, gone)
        cur = new
    return cur
