"""Rings of roads that become one point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.operators.graph import connected_components
from geoquill.operators.network import ends
from geoquill.workspace import Workspace


def rings(pieces: DataFrame, ws: Workspace) -> DataFrame:
    """(ring, line_id) of pieces (line_id, src, dst, number) that form closed rings of one number: connected, and two at every node.

    ring is the smallest node. A piece that is a loop is a ring of its own where no other piece meets it.
    """
    p = ws.put(pieces.select("line_id", "number", F.struct("number", F.col("src").alias("node")).alias("s"), F.struct("number", F.col("dst").alias("node")).alias("d")), "pieces")
    # nodes of different numbers are different: numbered by their smallest piece
    node = ws.put(p.select(F.explode(F.array("s", "d")).alias("k"), "line_id").groupBy("k").agg(F.min("line_id").alias("at"), F.count(F.lit(1)).alias("n")), "nodes")
    both = p.join(node.select(F.col("k").alias("s"), F.col("at").alias("a"), F.col("n").alias("ns")), "s").join(node.select(F.col("k").alias("d"), F.col("at").alias("b"), F.col("n").alias("nd")), "d")
    joined = both.select("line_id", "a").unionByName(both.select("line_id", F.col("b").alias("a")))
    of = connected_components(joined, ws, "line_id", "a")
    d = both.join(of.select(F.col("id").alias("line_id"), F.col("component").alias("part")), "line_id", "left").withColumn("part", F.coalesce("part", "line_id"))
    whole = d.groupBy("part").agg(F.max(F.greatest("ns", "nd")).alias("most"), F.min(F.least("ns", "nd")).alias("least"), F.min(F.least("s.node", "d.node")).alias("ring")).where("most = 2 and least = 2")
    return d.join(whole, "part").select("ring", "line_id")


def collapse(lines: DataFrame, ws: Workspace, kind: str = "roundabout", tunnel: str = "U") -> DataFrame:
    """lines (line_id, src, dst, line, kind, number, medium) without rings of the kind: roads that end at a ring end at its centre.

    The centre is the mean of the ring's vertices, each once, and its node is the ring's
    smallest. Where all pieces of a ring are tunnels only tunnels are led to the centre,
    and other roads stay as they are; where none is, all roads are; a mixed ring stays. A
    road with both ends at one ring goes. Pieces that form no closed ring stay.
    """
    lines = ws.put(lines, "lines")
    pieces = lines.where(F.col("kind") == kind)
    r = ws.put(rings(pieces, ws).join(pieces.select("line_id", "src", "dst", "line", "medium"), "line_id"), "rings")
    under = F.sum(F.when(F.col("medium") == tunnel, 1).otherwise(0))
    what = r.groupBy("ring").agg(under.alias("under"), F.count(F.lit(1)).alias("n")).where("under = 0 or under = n").select("ring", (F.col("under") > 0).alias("deep"))
    centre = r.select("ring", F.explode("line").alias("v")).distinct().groupBy("ring").agg(F.avg("v.x").alias("cx"), F.avg("v.y").alias("cy"))
    what = ws.put(what.join(centre, "ring"), "centres")
    node = ws.put(ends(r.select("line_id", "src", "dst")).join(r.select("line_id", "ring"), "line_id").select("node", "ring").distinct().join(what, "ring"), "at")
    gone = r.join(what, "ring", "left_semi").select("line_id")
    d = lines.join(gone, "line_id", "left_anti")
    for end in ("src", "dst"):
        meets = node.select(F.col("node").alias(end), F.col("ring").alias(f"r_{end}"), F.col("deep").alias(f"deep_{end}"), F.struct(F.col("cx").alias("x"), F.col("cy").alias("y")).alias(f"c_{end}"))
        d = d.join(meets, end, "left")
        led = F.col(f"r_{end}").isNotNull() & (~F.col(f"deep_{end}") | (F.col("medium") == tunnel))
        d = d.withColumn(f"r_{end}", F.when(led, F.col(f"r_{end}")))
    d = d.where("not coalesce(r_src = r_dst, false)")
    n = F.size("line")
    d = d.withColumn("line", F.when(F.col("r_src").isNotNull(), F.concat(F.array("c_src"), F.slice("line", 2, n))).otherwise(F.col("line")))
    d = d.withColumn("line", F.when(F.col("r_dst").isNotNull(), F.concat(F.slice("line", 1, F.greatest(n - 1, F.lit(0))), F.array("c_dst"))).otherwise(F.col("line")))
    return d.withColumns({"src": F.coalesce("r_src", "src"), "dst": F.coalesce("r_dst", "dst")}).select(*lines.columns)


def equal_parts(lines: DataFrame, keys: list[str], tolerance: int, ws: Workspace) -> DataFrame:
    """(line_id, part) of lines (line_id, x1, y1, x2, y2, keys): joined where ends lie within the tolerance and all keys are equal (null to null); part is the smallest line_id."""
    end = lambda i, x, y: F.struct(F.lit(i).alias("end"), F.col(x).alias("x"), F.col(y).alias("y"))
    e = lines.select("line_id", F.xxhash64(*keys).alias("same"), *[F.col(k).alias(f"k_{k}") for k in keys], F.explode(F.array(end(0, "x1", "y1"), end(1, "x2", "y2"))).alias("e")).select("line_id", "same", *[f"k_{k}" for k in keys], "e.*")
    size = max(1, tolerance)
    at = lambda c: F.floor(F.col(c) / size).cast("bigint")
    home = e.withColumns({"cx": at("x"), "cy": at("y")})
    near = home.withColumn("o", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))).withColumns({"cx": F.col("cx") + F.col("o.i"), "cy": F.col("cy") + F.col("o.j")}).drop("o")
    b = near.select("same", "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in ("line_id", "x", "y", *[f"k_{k}" for k in keys])])
    p = home.join(b, ["same", "cx", "cy"]).where("line_id < b_line_id").where((F.col("x") - F.col("b_x")) * (F.col("x") - F.col("b_x")) + (F.col("y") - F.col("b_y")) * (F.col("y") - F.col("b_y")) <= tolerance * tolerance)
    for k in keys:
        p = p.where(F.col(f"k_{k}").eqNullSafe(F.col(f"b_k_{k}")))
    of = connected_components(p.select("line_id", "b_line_id").distinct(), ws, "line_id", "b_line_id")
    return lines.select("line_id").join(of.select(F.col("id").alias("line_id"), "component"), "line_id", "left").select("line_id", F.coalesce("component", "line_id").alias("part"))
