"""Moves that spread and moves that make room."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquill.operators.arrangement import meeting
from geoquill.operators.gapplan import nearest_on
from geoquill.operators.graph import rounds
from geoquill.operators.spatial import places
from geoquill.workspace import Workspace


def propagated(points: DataFrame, links: DataFrame, reach: int) -> DataFrame:
    """points (id, x, y) plus dx, dy: the mean move of the links (x, y, dx, dy) nearer than reach, weighted by closeness squared and fading to nothing at reach; 0 where there is none.

    A point on a link takes the mean of the links at its place. Places are compared: links of one place go along as their sum and number, and points of one place move alike.
    """
    cell = lambda c: F.floor(F.col(c) / reach).cast("bigint")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    links = links.where("x is not null and y is not null").groupBy("x", "y").agg(F.sum("dx").alias("dx"), F.sum("dy").alias("dy"), F.count(F.lit(1)).alias("n"))
    b = links.select(F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("dx").alias("ldx"), F.col("dy").alias("ldy"), "n", cell("x").alias("cx"), cell("y").alias("cy"), around.alias("o")).withColumns({"cx": F.col("cx") + F.col("o.i"), "cy": F.col("cy") + F.col("o.j")}).drop("o")
    p = places(points).select("x", "y", cell("x").alias("cx"), cell("y").alias("cy")).join(b, ["cx", "cy"])
    d2 = ((F.col("x") - F.col("lx")) * (F.col("x") - F.col("lx")) + (F.col("y") - F.col("ly")) * (F.col("y") - F.col("ly"))).cast("double")
    p = p.withColumn("d2", d2).where(F.col("d2") < reach * reach)
    w, fade = 1 / F.greatest("d2", F.lit(1e-6)), 1 - F.sqrt("d2") / reach
    weight = F.sum(w * F.col("n"))
    mean = p.groupBy("x", "y").agg((F.sum(w * fade * F.col("ldx")) / weight).alias("dx"), (F.sum(w * fade * F.col("ldy")) / weight).alias("dy"))
    return points.join(mean, ["x", "y"], "left").select(*points.columns, F.coalesce("dx", F.lit(0.0)).alias("dx"), F.coalesce("dy", F.lit(0.0)).alias("dy"))


def pushed_vertices(line: Column, x: Column, y: Column, reach: float) -> Column:
    """A line whose vertices nearer than reach to a point stand at reach from it, in the direction they had; one at the point itself goes to the right."""

    def one(v):
        dx, dy = v["x"] - x, v["y"] - y
        d = F.hypot(dx.cast("double"), dy.cast("double"))
        moved = F.when(d == 0, F.struct((x + reach).alias("x"), (y + F.lit(0.0)).alias("y"))).otherwise(F.struct((x + dx / d * reach).alias("x"), (y + dy / d * reach).alias("y")))
        return F.when(d < reach, moved).otherwise(F.struct(v["x"].cast("double").alias("x"), v["y"].cast("double").alias("y")))

    return F.transform(line, one)


def make_room(points: DataFrame, barriers: DataFrame, ws: Workspace, bound: float, most_rounds: int = 12) -> DataFrame:
    """points (id, x, y, need) plus mx, my, moved and short: moved away from barriers (part, ax, ay, bx, by, half) until each is need + half from all.

    In every round a point goes straight away from the barrier that lacks most room, to
    where it has it, but no farther than bound from its first place. Only points that
    lack room go on to the next round. short is what is still lacking (0 where nothing
    is): points between barriers that leave too little room, or that would have to go
    beyond the bound, keep the place where least was lacking and report it.
    """
    widest = barriers.agg(F.max("half")).first()[0] or 0
    farthest = points.agg(F.max("need")).first()[0] or 0
    whole = int(widest + farthest + bound) + 2
    size = max(1, 2 * whole)
    wall = barriers.select(F.col("part").alias("key"), F.floor(F.least("ax", "bx")).cast("bigint").alias("xmin"), F.floor(F.least("ay", "by")).cast("bigint").alias("ymin"), F.ceil(F.greatest("ax", "bx")).cast("bigint").alias("xmax"), F.ceil(F.greatest("ay", "by")).cast("bigint").alias("ymax"))
    box = points.select(F.col("id").alias("key"), *[(F.floor(F.col(c)) + s * whole).cast("bigint").alias(n) for c, s, n in (("x", -1, "xmin"), ("y", -1, "ymin"), ("x", 1, "xmax"), ("y", 1, "ymax"))])
    # a point never leaves this box, so what it may meet is joined once
    near = ws.put(meeting(box, wall, size).select(F.col("a_key").alias("id"), F.col("b_key").alias("part")).join(barriers, "part"), "near")
    state = ws.put(points.select("id", F.col("x").cast("double").alias("x0"), F.col("y").cast("double").alias("y0"), "need", F.col("x").cast("double").alias("mx"), F.col("y").cast("double").alias("my"), F.col("x").cast("double").alias("gx"), F.col("y").cast("double").alias("gy"), F.lit(None).cast("double").alias("least")), "state")
    done = None
    for k in rounds():
        lack = state.select("id", "mx", "my", "need").join(near, "id").withColumns(nearest_on("mx", "my"))
        lack = lack.withColumn("short", F.col("need") + F.col("half") - F.sqrt("d2")).where("short > 1e-9")
        worst = lack.groupBy("id").agg(F.max(F.struct("short", (-F.col("part")).alias("part"), "qx", "qy", "d2", "half", "ax", "ay", "bx", "by")).alias("w"))
        d = ws.put(state.join(worst, "id", "left"), "worst")
        # the best place so far: where least is lacking
        better = F.col("least").isNull() | (F.coalesce("w.short", F.lit(0.0)) < F.col("least"))
        d = d.withColumns({"gx": F.when(better, F.col("mx")).otherwise(F.col("gx")), "gy": F.when(better, F.col("my")).otherwise(F.col("gy")), "least": F.when(better, F.coalesce("w.short", F.lit(0.0))).otherwise(F.col("least"))})
        free = d.where("w is null").select("id", "x0", "y0", "gx", "gy", "least")
        done = free if done is None else done.unionByName(free)
        rest = d.where("w is not null")
        if k + 1 >= most_rounds or rest.isEmpty():
            done = done.unionByName(rest.select("id", "x0", "y0", "gx", "gy", "least"))
            break
        far = F.sqrt("w.d2")
        # on the barrier itself: to its left
        n = F.hypot(F.col("w.bx") - F.col("w.ax"), F.col("w.by") - F.col("w.ay"))
        ux = F.when(far > 1e-9, (F.col("mx") - F.col("w.qx")) / far).otherwise(F.when(n > 0, -(F.col("w.by") - F.col("w.ay")) / n).otherwise(1.0))
        uy = F.when(far > 1e-9, (F.col("my") - F.col("w.qy")) / far).otherwise(F.when(n > 0, (F.col("w.bx") - F.col("w.ax")) / n).otherwise(0.0))
        room = F.col("need") + F.col("w.half")
        tx, ty = F.col("w.qx") + ux * room, F.col("w.qy") + uy * room
        off = F.hypot(tx - F.col("x0"), ty - F.col("y0"))
        back = F.when(off > bound, bound / off).otherwise(1.0)
        state = ws.put(rest.select("id", "x0", "y0", "need", (F.col("x0") + (tx - F.col("x0")) * back).alias("mx"), (F.col("y0") + (ty - F.col("y0")) * back).alias("my"), "gx", "gy", "least"), "state")
    out = done.select("id", F.col("gx").alias("mx"), F.col("gy").alias("my"), F.hypot(F.col("gx") - F.col("x0"), F.col("gy") - F.col("y0")).alias("moved"), F.col("least").alias("short"))
    return points.join(out, "id")
