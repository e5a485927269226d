"""Queries on line networks: cycles, what goes of triangles, heights along lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import elevation, network
from geoquill.plans.registry import query, work

_REACH = "both_ as (select src as a, dst as b from lines union all select dst, src from lines), reach(a, b) as (select distinct a, a from both_ union select r.a, e.b from reach r join both_ e on r.b = e.a), cc as (select a as node, min(b) as component from reach group by a)"


@query(f"with recursive {_REACH}, e as (select cc.component, count(*) as edges from lines l join cc on cc.node = l.src group by 1), v as (select component, count(*) as nodes from cc group by 1) select component, nodes, edges, edges - nodes + 1 as cycles from e join v using (component)")
def cyclic_parts(t):
    """Connected parts with the number of their independent cycles"""
    return network.cyclic_parts(t.lines, work(t))


@query("""with e as (select least(src, dst) as a, greatest(src, dst) as b, class, line_id, row_number() over (partition by least(src, dst), greatest(src, dst) order by class, line_id) as r from lines where src <> dst), o as (select * from e where r = 1),
w as (select unnest([struct_pack(class := x.class, id := x.line_id), struct_pack(class := y.class, id := y.line_id), struct_pack(class := z.class, id := z.line_id)]) as l, x.a, x.b, y.b as c from o x join o y on y.a = x.b join o z on z.a = x.a and z.b = y.b),
m as (select l.id as line_id, row_number() over (partition by a, b, c order by l.class desc, l.id desc) as r from w) select line_id from lines where line_id not in (select line_id from m where r = 1)""")
def triangle_removal(t):
    """N05 with removal: of each triangle the line of the least class goes, of equal ones the greatest line_id"""
    return t.lines.join(network.triangle_losers(t.lines, "class"), "line_id", "left_anti").select("line_id")


def _height(x: str, y: str) -> str:
    return f"(500 - floor({x} / 100) - 2 * floor((10100 - {y}) / 100) + cast(floor({x} / 100) * 31 + floor((10100 - {y}) / 100) * 17 as bigint) % 7)"


@query(f"""select line_id, cast(case when x1 < 10200 and y1 between -99 and 10100 then {_height('x1', 'y1')} end as bigint) as z1, cast(case when x2 < 10200 and y2 between -99 and 10100 then {_height('x2', 'y2')} end as bigint) as z2 from lines""")
def elevated_lines(t):
    """A height at each end of a line; none outside the raster"""
    c = t.spark.range(102).withColumnRenamed("id", "col").crossJoin(t.spark.range(102).withColumnRenamed("id", "row"))
    dem = c.withColumn("z", 500 - F.col("col") - 2 * F.col("row") + (F.col("col") * 31 + F.col("row") * 17) % 7)
    e = t.lines.select("line_id", F.explode(F.array(F.struct(F.lit(1).alias("k"), F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.lit(2).alias("k"), F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("e")).select("line_id", "e.*")
    z = elevation.sample(e, dem, 100, 10100)
    return z.groupBy("line_id").agg(F.max(F.when(F.col("k") == 1, F.col("z"))).alias("z1"), F.max(F.when(F.col("k") == 2, F.col("z"))).alias("z2"))
