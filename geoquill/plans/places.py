"""Queries of spacing along lines, rings of roads and raster tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import roundabouts, spacing
from geoquill.plans.registry import query, work
from geoquill.sources import rasters

L = "bigint"
_MARKS = "(select distinct (cast(l_suppkey as bigint) * 100000000 + l_orderkey) * 8 + l_linenumber as id, cast(l_suppkey as bigint) as line, (cast(l_orderkey as bigint) * 31 + l_linenumber * 977) % 30011 as dist, cast(l_linenumber as bigint) as size from lineitem)"


def _marks(t):
    k = F.col("l_orderkey").cast(L)
    own = (F.col("l_suppkey").cast(L) * 100000000 + k) * 8 + F.col("l_linenumber")
    return t.lineitem.select(own.alias("id"), F.col("l_suppkey").cast(L).alias("line"), ((k * 31 + F.col("l_linenumber") * 977) % 30011).cast(L).alias("dist"), F.col("l_linenumber").cast(L).alias("size")).distinct()


@query(f"""with recursive m as (select * from {_MARKS} q), p as (select *, size >= 7 as big, row_number() over (partition by line order by dist, id) as n from m),
far as (select a.line, a.n, min(b.n) as f from p a join p b on b.line = a.line and b.n > a.n and b.dist >= a.dist + 400 group by 1, 2),
big as (select line, n, min(n) filter (big) over (partition by line order by n rows between 1 following and unbounded following) as g from p),
step as materialized (select p.*, case when f is null then g when g is null then f else least(f, g) end as nxt from p left join far using (line, n) left join big using (line, n)),
on_ as (select line, n from step where n = 1 union all select s.line, s.nxt from on_ o join step s on s.line = o.line and s.n = o.n where s.nxt is not null)
select s.id from step s join on_ o on o.line = s.line and o.n = s.n left join step x on x.line = s.line and x.n = s.nxt where s.big or not coalesce(x.big, false)""")
def spaced_points(t):
    """Marks along each line that a scan keeps, large ones always, small ones 400 apart"""
    return spacing.spaced(_marks(t), work(t), 400, 7)


@query(f"""with m as (select line, dist // 100 as ladder, id from {_MARKS} q), n as (select ladder, count(distinct id) as n from m group by 1)
select line, ladder from (select line, ladder, row_number() over (partition by line order by n desc, ladder) as k from (select distinct line, ladder, n from m join n using (ladder)) x) y where k = 1""")
def longest_ladders(t):
    """Of the ladders that meet a line the longest"""
    return spacing.longest_ladders(_marks(t).select("line", F.floor(F.col("dist") / 100).alias("ladder"), "id"))


@query("""with ring as (select h, max(u) as any_u, min(u) as all_u from (select src // 8 as h, case when medium = 'U' then 1 else 0 end as u from circles where kind = 'roundabout') q group by 1),
led as (select c.line_id, c.kind, case when s.any_u = s.all_u and (s.any_u = 0 or c.medium = 'U') then s.h * 8 else c.src end as src, case when d.any_u = d.all_u and (d.any_u = 0 or c.medium = 'U') then d.h * 8 else c.dst end as dst,
  coalesce(s.any_u = s.all_u and (s.any_u = 0 or c.medium = 'U') and d.any_u = d.all_u and (d.any_u = 0 or c.medium = 'U') and s.h = d.h, false) as inside, coalesce(s.any_u = s.all_u, false) as whole
  from circles c left join ring s on s.h = c.src // 8 left join ring d on d.h = c.dst // 8)
select line_id, src, dst from led where not (kind = 'roundabout' and whole) and not (kind = 'road' and inside)""")
def collapsed_roundabouts(t):
    """Roundabouts become points, by the medium of their pieces; roads inside one go"""
    point = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    c = t.circles.select("line_id", "src", "dst", F.array(point("x1", "y1"), point("x2", "y2")).alias("line"), "kind", "number", "medium")
    return roundabouts.collapse(c, work(t)).select("line_id", "src", "dst")


@query("""with recursive e as (select line_id, category, medium, x1 as x, y1 as y from lines union all select line_id, category, medium, x2, y2 from lines),
p as (select a.line_id as a, b.line_id as b from e a join e b on a.category = b.category and a.medium = b.medium and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 25),
r(a, b) as (select a, b from p union select r.a, p.b from r join p on p.a = r.b), g as (select a as line_id, min(b) as part from r group by a)
select part, count(*) as members, sum(length_cm) as length_cm from g join lines using (line_id) group by part""")
def merged_equal_lines(t):
    """Lines of equal category and medium whose ends lie within 5, as one, with the attributes of the first"""
    of = roundabouts.equal_parts(t.lines, ["category", "medium"], 5, work(t))
    return of.join(t.lines, "line_id").groupBy("part").agg(F.count(F.lit(1)).alias("members"), F.sum("length_cm").alias("length_cm"))


@query("select id, cast(floor(x / 100) * 3 + floor(y / 100) * 5 as bigint) as z from pts where x between 2000 and 5999 and y between 3000 and 4499")
def tile_window(t):
    """Heights from raster tiles, those only that a window touches"""
    ws = work(t)
    n = t.pts.agg((F.max("x") / 100).cast("int") + 1).first()[0]
    grid = t.spark.range(0, n * n).select((F.col("id") % n).alias("col"), F.floor(F.col("id") / n).alias("row"))
    path = ws.path("tiles")
    rasters.write_tiles(grid.withColumn("z", F.col("col") * 3 + F.col("row") * 5), path, 16, 100.0)
    box = (2000.0, 3000.0, 5999.0, 4499.0)
    cells = rasters.cells(rasters.tiles(t.spark, path, box, 16, 100.0), box)
    at = cells.select((F.col("x") / 100).cast(L).alias("i"), (F.col("y") / 100).cast(L).alias("j"), F.col("z").cast(L).alias("z"))
    p = t.pts.where("x between 2000 and 5999 and y between 3000 and 4499").select("id", F.floor(F.col("x") / 100).alias("i"), F.floor(F.col("y") / 100).alias("j"))
    return p.join(at, ["i", "j"], "left").select("id", "z")
