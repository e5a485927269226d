"""Queries that take geometries apart, check and mend them, and make new ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.functions import geometry
from geoquill.operators import network, shapes, spatial
from geoquill.plans.registry import query, work

ENDS = ("x1", "y1", "x2", "y2")

_RELATION = """case when a.xmin = b.xmin and a.ymin = b.ymin and a.xmax = b.xmax and a.ymax = b.ymax then 'equals' when a.xmax = b.xmin or b.xmax = a.xmin or a.ymax = b.ymin or b.ymax = a.ymin then 'touches'
when a.xmin <= b.xmin and a.ymin <= b.ymin and a.xmax >= b.xmax and a.ymax >= b.ymax then 'contains' when b.xmin <= a.xmin and b.ymin <= a.ymin and b.xmax >= a.xmax and b.ymax >= a.ymax then 'within' else 'overlaps' end"""


@query(f"select a.id as a_id, b.id as b_id, {_RELATION} as relation from boxes a join boxes b on a.id < b.id and a.xmin <= b.xmax and b.xmin <= a.xmax and a.ymin <= b.ymax and b.ymin <= a.ymax")
def box_relations(t):
    """How boxes that meet lie to each other; all other pairs are disjoint"""
    p = spatial.box_pairs(t.boxes, t.boxes).where("a_id < b_id")
    return p.select("a_id", "b_id", shapes.relation(p).alias("relation"))


@query("""select id, 0 as part, xmin as x1, ymin as y1, xmax as x2, ymin as y2 from boxes union all select id, 1, xmax, ymin, xmax, ymax from boxes
union all select id, 2, xmax, ymax, xmin, ymax from boxes union all select id, 3, xmin, ymax, xmin, ymin from boxes""")
def ring_segments(t):
    """Rings split at their vertices"""
    return shapes.split_at_vertices(t.boxes.withColumn("ring", shapes.ring(t.boxes)), "ring", "id")


@query("select src, row_number() over (partition by src order by line_id) - 1 as part, line_id, x1, y1, x2, y2 from lines")
def single_parts(t):
    """Multipart lines (those that leave one node) as single parts, numbered"""
    multi = t.lines.groupBy("src").agg(F.array_sort(F.collect_list(F.struct("line_id", *ENDS))).alias("parts"))
    return shapes.single_parts(multi, "parts", "src")


@query("""with c as (select col, row, category as p from landuse), v as (select coalesce(a.col + 1, b.col) as col, coalesce(a.row, b.row) as row, a.p as left_part, b.p as right_part from c a full join c b on a.col + 1 = b.col and a.row = b.row),
h as (select coalesce(a.col, b.col) as col, coalesce(a.row + 1, b.row) as row, a.p as left_part, b.p as right_part from c a full join c b on a.col = b.col and a.row + 1 = b.row)
select col, row, 'v' as side, left_part, right_part from v where left_part is distinct from right_part union all select col, row, 'h', left_part, right_part from h where left_part is distinct from right_part""")
def area_borders(t):
    """Borders of areas as lines that know what lies to their left and right"""
    return shapes.cell_borders(t.landuse, "category")


_SEG = "seg as (select id, x as x1, y as y1, x + (id % 7) * 100 - 300 as x2, y + (id % 5) * 90 - 170 as y2 from pts)"


@query(f"""with {_SEG}, det as (select a.id, (a.x2 - a.x1) * (b.y2 - b.y1) - (a.y2 - a.y1) * (b.x2 - b.x1) as d, (b.x1 - a.x1) * (b.y2 - b.y1) - (b.y1 - a.y1) * (b.x2 - b.x1) as t, (b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1) as u
from seg a join seg b on a.id <> b.id and least(a.x1, a.x2) <= greatest(b.x1, b.x2) and least(b.x1, b.x2) <= greatest(a.x1, a.x2) and least(a.y1, a.y2) <= greatest(b.y1, b.y2) and least(b.y1, b.y2) <= greatest(a.y1, a.y2)),
flat as (select a.id, (a.x2 - a.x1) * (a.x2 - a.x1) + (a.y2 - a.y1) * (a.y2 - a.y1) as d, unnest([(b.x1 - a.x1) * (a.x2 - a.x1) + (b.y1 - a.y1) * (a.y2 - a.y1), (b.x2 - a.x1) * (a.x2 - a.x1) + (b.y2 - a.y1) * (a.y2 - a.y1)]) as t
from seg a join seg b on a.id <> b.id and (a.x2 - a.x1) * (b.y2 - b.y1) = (a.y2 - a.y1) * (b.x2 - b.x1) and (b.x1 - a.x1) * (a.y2 - a.y1) = (b.y1 - a.y1) * (a.x2 - a.x1)),
cut as (select distinct id, cast(t * sign(d) as double) / abs(d) as p from det where d <> 0 and t * sign(d) > 0 and t * sign(d) < abs(d) and u * sign(d) >= 0 and u * sign(d) <= abs(d) union select id, cast(t as double) / d from flat where t > 0 and t < d),
every as (select id, p from cut union all select id, 0 from seg), o as (select id, row_number() over (partition by id order by p) - 1 as part, p as a, lead(p, 1, 1) over (partition by id order by p) as b from every)
select id, part, cast(round(1000000 * a) as bigint) as a_ppm, cast(round(1000000 * b) as bigint) as b_ppm from o""")
def planarised(t):
    """Lines cut wherever another crosses or ends on them"""
    x, y, k = F.col("x"), F.col("y"), F.col("id")
    seg = t.pts.select("id", x.alias("x1"), y.alias("y1"), (x + (k % 7) * 100 - 300).alias("x2"), (y + (k % 5) * 90 - 170).alias("y2"))
    ppm = lambda c: F.round(1000000 * F.col(c)).cast("bigint").alias(f"{c}_ppm")
    return shapes.planarise(seg).select("id", "part", ppm("a"), ppm("b"))


_BOW = "bow as (select id, x as ax, y as ay, x + (id % 9) * 10 - 30 as bx, y + (id % 7) * 10 - 20 as by_, x + (id % 11) * 10 - 60 as cx, y + (id % 5) * 10 - 10 as cy, x + (id % 8) * 10 - 20 as dx, y + (id % 13) * 10 - 70 as dy from pts)"
_TURN = "sign(({r}x - {q}x) * ({v}y - {q}y) - ({r}y - {q}y) * ({v}x - {q}x))"
_T = lambda q, r, v: _TURN.format(q=q, r=r, v=v).replace("by ", "by_ ").replace("by)", "by_)")
_BACK = lambda p, q, r: f"(({p}x - {q}x) * ({r}y - {q}y) = ({p}y - {q}y) * ({r}x - {q}x) and ({p}x - {q}x) * ({r}x - {q}x) + ({p}y - {q}y) * ({r}y - {q}y) > 0)".replace("by ", "by_ ").replace("by)", "by_)")


@query(f"""with {_BOW}, k as (select id, cast({_BACK('a', 'b', 'c')} as int) + cast({_BACK('b', 'c', 'd')} as int) + cast(({_T('a', 'b', 'c')} * {_T('a', 'b', 'd')} <= 0 and {_T('c', 'd', 'a')} * {_T('c', 'd', 'b')} <= 0
  and least(ax, bx) <= greatest(cx, dx) and least(cx, dx) <= greatest(ax, bx) and least(ay, by_) <= greatest(cy, dy) and least(cy, dy) <= greatest(ay, by_)) and not (ax = dx and ay = dy) as int) as n
  from bow where not (ax = bx and ay = by_) and not (bx = cx and by_ = cy) and not (cx = dx and cy = dy) and not (ax = dx and ay = dy)) select id, n from k where n > 0""")
def self_crossing_lines(t):
    """Lines of four vertices that cross, touch or run back on themselves"""
    x, y, k = F.col("x"), F.col("y"), F.col("id")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    v = F.array(at(F.lit(0), F.lit(0)), at((k % 9) * 10 - 30, (k % 7) * 10 - 20), at((k % 11) * 10 - 60, (k % 5) * 10 - 10), at((k % 8) * 10 - 20, (k % 13) * 10 - 70))
    lines = t.pts.select("id", v.alias("line")).where("line[0] <> line[1] and line[1] <> line[2] and line[2] <> line[3] and line[0] <> line[3]")
    return shapes.self_crossings(lines, "line")


_FAULTY = "case line_id % 7 when 0 then null when 1 then 'empty' when 2 then 'short' when 3 then 'repeated vertices' when 4 then 'short' else 'fine' end"


def _faulty(t):
    """Lines with faults: no geometry, no vertices, one vertex, vertices that repeat."""
    p, q = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    kind = F.col("line_id") % 7
    line = F.when(kind == 1, F.array().cast("array<struct<x:bigint,y:bigint>>")).when(kind == 2, F.array(p)).when(kind == 3, F.array(p, p, q, q)).when(kind == 4, F.array(p, p)).when(kind > 4, F.array(p, q))
    return t.lines.select("line_id", line.alias("line"))


@query("""select line_id, case line_id % 7 when 0 then 'null geometry' when 1 then 'empty' when 2 then 'short' when 3 then 'repeated vertices' else 'short' end as problem from lines where line_id % 7 < 5""")
def geometry_problems(t):
    """Lines with a problem, and which"""
    return _faulty(t).select("line_id", shapes.problem("line").alias("problem")).where("problem is not null")


@query("select line_id, 2 as vertices, x1, y1, x2, y2 from lines where line_id % 7 in (3, 5, 6)")
def repaired_lines(t):
    """Lines without geometry dropped, repeated vertices joined"""
    d = shapes.repaired(_faulty(t), "line")
    a, b = F.element_at("line", 1), F.element_at("line", -1)
    return d.select("line_id", F.size("line").alias("vertices"), a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


_HOLES = "h as (select a.id, b.id as hole, (a.xmax - a.xmin) * (a.ymax - a.ymin) as area, (b.xmax - b.xmin) * (b.ymax - b.ymin) as hole_area from boxes a join boxes b on b.xmin > a.xmin and b.ymin > a.ymin and b.xmax < a.xmax and b.ymax < a.ymax)"


@query(f"with {_HOLES} select a.id, coalesce(n, 0) as dropped from boxes a left join (select id, count(*) as n from h group by id) g on a.id = g.id")
def filled_islands(t):
    """Outer rings alone, and how many holes each lost"""
    n = shapes.holes(t.boxes, t.boxes).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return t.boxes.select("id").join(n, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("dropped"))


@query(f"with {_HOLES} select id, hole, hole_area from h where hole_area >= 2000 and 100 * hole_area >= 10 * area")
def large_holes(t):
    """Holes that stay when those under 2000 or a tenth of their ring's area go"""
    return shapes.holes(t.boxes, t.boxes).where("hole_area >= 2000 and 100 * hole_area >= 10 * area").select("id", "hole", "hole_area")


@query("""with w as (select *, (case category when 'E' then 20.0 when 'R' then 15.0 when 'F' then 10.0 else 6.0 end) * 1.5 + 2 as half, sqrt(cast((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) as double)) as n from lines where category in ('E', 'R', 'F', 'K'))
select line_id, cast(round(100 * (x1 + (y2 - y1) / n * half)) as bigint) as ax, cast(round(100 * (y1 - (x2 - x1) / n * half)) as bigint) as ay, cast(round(100 * (x2 - (y2 - y1) / n * half)) as bigint) as cx, cast(round(100 * (y2 + (x2 - x1) / n * half)) as bigint) as cy from w""")
def class_buffers(t):
    """Lines widened by a width for each class, times a factor plus an addition, flat at the ends"""
    half = shapes.class_width(F.col("category"), {"E": 20.0, "R": 15.0, "F": 10.0, "K": 6.0}, 1.5, 2.0)
    d = t.lines.where("category in ('E', 'R', 'F', 'K')").select("line_id", shapes.flat_buffer(*[F.col(c) for c in ENDS], half).alias("b"))
    at = lambda i, c: F.round(100 * F.col("b")[i][c]).cast("bigint")
    return d.select("line_id", at(0, "x").alias("ax"), at(0, "y").alias("ay"), at(2, "x").alias("cx"), at(2, "y").alias("cy"))


@query("select id, k * 15 as by, xmin - k * 15 as xmin, ymin - k * 15 as ymin, xmax + k * 15 as xmax, ymax + k * 15 as ymax from boxes, (select unnest([1, 2, 3]) as k) s")
def ring_growth(t):
    """Each box grown by every increment of a plan"""
    d = t.boxes.withColumn("by", F.explode(F.array(*[F.lit(k).cast("bigint") for k in (15, 30, 45)])))
    return d.select("id", "by", (F.col("xmin") - F.col("by")).alias("xmin"), (F.col("ymin") - F.col("by")).alias("ymin"), (F.col("xmax") + F.col("by")).alias("xmax"), (F.col("ymax") + F.col("by")).alias("ymax"))


@query("""with n as (select line_id, x1, y1, x2, y2, sqrt(cast((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) as double)) as n from lines)
select line_id, cast(round(100 * ((x1 + x2) / 2.0 + (y2 - y1) / n * 25)) as bigint) as ax, cast(round(100 * ((y1 + y2) / 2.0 - (x2 - x1) / n * 25)) as bigint) as ay from n""")
def cut_lines(t):
    """Lines across the middle of others"""
    c = t.lines.select("line_id", shapes.cut_line(*[F.col(c) for c in ENDS], F.lit(25)).alias("c"))
    return c.select("line_id", F.round(100 * F.col("c.x1")).cast("bigint").alias("ax"), F.round(100 * F.col("c.y1")).cast("bigint").alias("ay"))


_OUT = "o as (select src as node, line_id, x1 as x, y1 as y, x2 as ox, y2 as oy from lines union all select dst, line_id, x2, y2, x1, y1 from lines)"


@query(f"""with {_OUT}, two as (select node from o group by node having count(*) = 2), p as (select a.node, a.ox - a.x as ax, a.oy - a.y as ay, b.ox - b.x as bx, b.oy - b.y as cy from o a join o b on a.node = b.node and a.line_id < b.line_id where a.node in (select node from two))
select node, cast(round(degrees(acos(greatest(-1.0, least(1.0, (ax * bx + ay * cy) / (sqrt(cast(ax * ax + ay * ay as double)) * sqrt(cast(bx * bx + cy * cy as double)))))))) as bigint) as angle from p""")
def vertex_angles(t):
    """Angles where two lines meet"""
    end = lambda n, x, y, ox, oy: F.struct(F.col(n).alias("node"), F.col("line_id"), F.col(x).alias("x"), F.col(y).alias("y"), F.col(ox).alias("ox"), F.col(oy).alias("oy"))
    e = t.lines.select(F.explode(F.array(end("src", "x1", "y1", "x2", "y2"), end("dst", "x2", "y2", "x1", "y1"))).alias("e")).select("e.*")
    # the two ends of a node are its smallest and greatest line
    two = e.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line_id", "x", "y", "ox", "oy")).alias("a"), F.max(F.struct("line_id", "ox", "oy")).alias("b")).where("n = 2 and a.line_id < b.line_id")
    c = lambda n: F.col(n)
    return two.select("node", F.round(geometry.vertex_angle(c("a.ox"), c("a.oy"), c("a.x"), c("a.y"), c("b.ox"), c("b.oy"))).cast("bigint").alias("angle"))


_DANGLES = "d as (select node from (select src as node from lines union all select dst from lines) e group by node having count(*) = 1)"


@query(f"""with {_DANGLES}, {_OUT}, near as (select o.node, p.x as sx, p.y as sy, row_number() over (partition by o.node order by (o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y), p.id) as r from o join d on d.node = o.node join pts p on (o.x - p.x) * (o.x - p.x) + (o.y - p.y) * (o.y - p.y) <= 3600)
select l.line_id, coalesce(a.sx, l.x1) as x1, coalesce(a.sy, l.y1) as y1, coalesce(b.sx, l.x2) as x2, coalesce(b.sy, l.y2) as y2 from lines l left join near a on a.node = l.src and a.r = 1 left join near b on b.node = l.dst and b.r = 1""")
def snapped_ends(t):
    """Line ends that no other line has go to the nearest target within 60; all other vertices stay"""
    free = network.dangles(t.lines).select("node", "line_id")
    at = t.lines.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("dst").alias("node"), F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("e")).select("e.*")
    ends = at.join(free.select("node"), "node").select(F.col("node").alias("id"), "x", "y")
    to = work(t).put(spatial.nearest(ends, t.pts, 1, 60).select(F.col("a_id").alias("node"), F.col("b_id").alias("id")).join(t.pts.select("id", "x", "y"), "id"), "targets")
    d = t.lines
    for node, x, y in (("src", "x1", "y1"), ("dst", "x2", "y2")):
        d = d.join(to.select(F.col("node").alias(node), F.col("x").alias("sx"), F.col("y").alias("sy")), node, "left").withColumns({x: F.coalesce("sx", x), y: F.coalesce("sy", y)}).drop("sx", "sy")
    return d.select("line_id", *ENDS)


@query("""select distinct l.line_id, b.id as box_id from (select line_id, x1 as x, y1 as y from lines union all select line_id, x2, y2 from lines) l join boxes b on l.x between b.xmin - 20 and b.xmax + 20 and l.y between b.ymin - 20 and b.ymax + 20""")
def attached_ends(t):
    """Lines that end within a tolerance of an area"""
    e = t.lines.select(F.col("line_id").alias("id"), F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p")).select("id", "p.x", "p.y")
    return spatial.points_in_boxes(e, spatial.grow(t.boxes, 20)).select(F.col("point_id").alias("line_id"), "box_id").distinct()
