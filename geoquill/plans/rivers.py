"""Queries of least routes, trees of terminals and directed water."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import routes
from geoquill.plans.registry import query, work

L = "bigint"
_WAYS = "w as (select src as a, dst as b, length_cm as w from lines where src <> dst union all select dst, src, length_cm from lines where src <> dst)"
_SPREAD = f"""{_WAYS}, s as (select node from (select src as node from lines union select dst from lines) n where node % 41 = 0),
r(node, d) using key (node) as (select node, cast(0 as bigint) from s union select w.b, min(r.d + w.w) from r join w on w.a = r.node left join recurring.r k on k.node = w.b where k.d is null or r.d + w.w < k.d group by w.b)"""


def _nodes(t, k: int):
    return t.lines.select(F.explode(F.array("src", "dst")).alias("node")).distinct().where(F.col("node") % k == 0)


@query(f"with recursive {_SPREAD} select node, d as dist from r")
def least_routes(t):
    """Length of the least route from the nearest of many nodes"""
    return routes.routes(t.lines, _nodes(t, 41), work(t)).select("node", F.col("dist").cast(L).alias("dist"))


@query(None)
def terminal_trees(t):
    """Lines that join every part's nodes of one kind by the least tree of least routes"""
    return routes.terminal_tree(t.lines, _nodes(t, 29), work(t))


@query("""with recursive p as (select a.line_id * 64 + b.line_id % 64 as pair, a.line_id as line_a, a.length_cm // 4 as at_a, b.line_id as line_b, b.length_cm // 3 as at_b, a.src as sa, a.dst as da, a.length_cm as wa, b.src as sb, b.dst as db, b.length_cm as wb
  from lines a join lines b on b.src = a.dst where a.line_id % 5 = 0),
w as (select src as a, dst as b, length_cm as w from lines where src <> dst union all select dst, src, length_cm from lines where src <> dst),
s as (select pair, node, min(d) as d from (select pair, sa as node, at_a as d from p union all select pair, da, wa - at_a from p) x group by 1, 2),
r(pair, node, d) using key (pair, node) as (select pair, node, d from s union select r.pair, w.b, min(r.d + w.w) from r join w on w.a = r.node left join recurring.r k on k.node = w.b and k.pair = r.pair where (k.d is null or r.d + w.w < k.d) and r.d + w.w <= 40000 group by r.pair, w.b)
select p.pair, cast(min(r.d + case when r.node = p.sb and r.node = p.db then least(at_b, wb - at_b) when r.node = p.sb then at_b else wb - at_b end) as bigint) as dist from p join r on r.pair = p.pair and r.node in (p.sb, p.db) group by p.pair""")
def place_distances(t):
    """Length of the way between places inside two lines, with part of the first and of the last line"""
    a, b = t.lines.alias("a"), t.lines.alias("b")
    pairs = a.join(b, F.col("b.src") == F.col("a.dst")).where("a.line_id % 5 = 0").selectExpr("a.line_id * 64 + b.line_id % 64 as pair", "a.line_id as line_a", "a.length_cm div 4 as at_a", "b.line_id as line_b", "b.length_cm div 3 as at_b")
    return routes.place_distances(t.lines, work(t).put(pairs), work(t), limit=40000).select("pair", F.col("dist").cast(L).alias("dist"))


_SINKS = """w as (select src as a, dst as b, line_id from lines where src <> dst union all select dst, src, line_id from lines where src <> dst),
r(node, d) using key (node) as (select node, 0 from (select src as node from lines union select dst from lines) n where node % 41 = 0 union select w.b, r.d + 1 from r join w on w.a = r.node left join recurring.r k on k.node = w.b where k.d is null)"""


@query(f"""with recursive {_SINKS}, up as (select w.a as node, w.b as parent, w.line_id, row_number() over (partition by w.a order by w.b, w.line_id) as k from w join r x on x.node = w.a join r y on y.node = w.b and y.d = x.d - 1)
select line_id, node as src, parent as dst from up where k = 1""")
def toward_sinks(t):
    """Lines of the tree of fewest steps, turned towards their sinks"""
    return routes.toward_sinks(t.lines, _nodes(t, 41), work(t))


def _heights(t):
    return t.lines.select(F.explode(F.array("src", "dst")).alias("node")).distinct().select("node", (F.col("node") * 7919 % 101).cast("int").alias("z"))


@query(None)
def drained_lines(t):
    """Lines turned by falls of their own where these are certain, else by the lowest pass to a sink; no cycle is left"""
    return routes.drained(t.lines, _heights(t), _nodes(t, 41), work(t), 40)


@query("""with recursive d as (select line_id, case when line_id % 2 = 1 then dst else src end as a, case when line_id % 2 = 1 then src else dst end as b from lines), r(a, b) as (select distinct a, b from d union select r.a, d.b from r join d on d.a = r.b)
select line_id from d where exists (select 1 from r where r.a = d.b and r.b = d.a)""")
def cyclic_lines(t):
    """Lines that are part of a directed cycle, each turned by the parity of its id"""
    odd = F.col("line_id") % 2 == 1
    d = t.lines.select("line_id", F.when(odd, F.col("dst")).otherwise(F.col("src")).alias("src"), F.when(odd, F.col("src")).otherwise(F.col("dst")).alias("dst"))
    return routes.cyclic_lines(d, work(t))


@query(None)
def guarded_order(t):
    """Strahler's order, not raised where branches of one origin meet again"""
    return routes.guarded_strahler(t.lines, work(t))
