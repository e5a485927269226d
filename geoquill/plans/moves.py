"""Queries of displacement and of divided roads."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import displacement, parallels
from geoquill.plans.registry import query, work

L = "bigint"


@query("""with l as (select x, y, id % 21 - 10 as dx, id % 13 - 6 as dy from hubs), p as (select p.id, l.dx, l.dy, cast((p.x - l.x) * (p.x - l.x) + (p.y - l.y) * (p.y - l.y) as double) as d2 from pts p join l on (p.x - l.x) * (p.x - l.x) + (p.y - l.y) * (p.y - l.y) < 250000),
m as (select id, sum((1 - sqrt(d2) / 500) * dx / greatest(d2, 0.000001)) / sum(1 / greatest(d2, 0.000001)) as dx, sum((1 - sqrt(d2) / 500) * dy / greatest(d2, 0.000001)) / sum(1 / greatest(d2, 0.000001)) as dy from p group by id)
select p.id, cast(round(1000 * coalesce(m.dx, 0)) as bigint) as dx, cast(round(1000 * coalesce(m.dy, 0)) as bigint) as dy from pts p left join m on m.id = p.id""")
def propagated_moves(t):
    """Points follow the moves of links nearby, less with distance"""
    links = t.hubs.select("x", "y", (F.col("id") % 21 - 10).alias("dx"), (F.col("id") % 13 - 6).alias("dy"))
    p = displacement.propagated(t.pts.select("id", "x", "y"), links, 500)
    return p.select("id", F.round(1000 * F.col("dx")).cast(L).alias("dx"), F.round(1000 * F.col("dy")).cast(L).alias("dy"))


@query(None)
def roomy_points(t):
    """Symbols move away from roads until they have room, no farther than 60; what is still lacking is reported"""
    cat = F.when(F.col("category").isin("E", "R"), 12.0).when(F.col("category").isin("F", "K"), 8.0).otherwise(4.0)
    d = lambda c: F.col(c).cast("double")
    walls = t.lines.select(F.col("line_id").alias("part"), d("x1").alias("ax"), d("y1").alias("ay"), d("x2").alias("bx"), d("y2").alias("by"), cat.alias("half"))
    p = displacement.make_room(t.pts.select("id", d("x").alias("x"), d("y").alias("y"), (F.lit(5.0) + F.col("id") % 3 * 5).alias("need")), walls, work(t), 60.0)
    cents = lambda c: F.round(100 * F.col(c)).cast(L).alias(c)
    return p.select("id", cents("mx"), cents("my"), cents("moved"), cents("short"))


@query("""select h * 4 as line_id, h % 3 <> 0 as merged from (select id as h from hubs) s union all select h * 4 + 2, false from (select id as h from hubs) s""")
def divided_roads(t):
    """The two carriageways of a road become one line; crossing roads of the same number and lone carriageways stay"""
    x, y, h = F.col("x").cast("double"), F.col("y").cast("double"), F.col("id")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    side = F.lit(20.0) + h % 20
    left = F.array(at(0, 0), at(300, 40), at(600, 0))
    right = F.array(at(600, side), at(300, side + 40), at(0, side))
    over = F.array(at(300, -100), at(300, 200))
    row = lambda k, line: F.struct((h * 4 + k).alias("line_id"), line.alias("line"))
    roads = F.when(h % 3 == 0, F.array(row(0, left), row(2, over))).otherwise(F.array(row(0, left), row(1, right), row(2, over)))
    d = t.hubs.select((h + 1).alias("merge_id"), F.explode(roads).alias("r")).select("r.line_id", "merge_id", "r.line")
    return parallels.merge_divided(d, work(t), 45.0).select("line_id", "merged")
