"""Queries of land use: least sizes by category, holes, missing categories, restored attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import landuse
from geoquill.plans.registry import query, work


def _parts(c: str, k: int) -> str:
    """p{k}: cells of the table c with their part; b{k}: borders of parts; the border where cells end has other = null."""
    near = "((x.col = y.col and abs(x.row - y.row) = 1) or (x.row = y.row and abs(x.col - y.col) = 1))"
    return f"""e{k} as materialized (select x.id as a, y.id as b from {c} x join {c} y on x.category is not distinct from y.category and {near}),
r{k}(a, b) as (select id, id from {c} union select r.a, e.b from r{k} r join e{k} e on r.b = e.a),
p{k} as materialized (select c.*, q.part from {c} c join (select a as id, min(b) as part from r{k} group by a) q using (id)),
i{k} as materialized (select x.part, y.part as other, count(*) as len from p{k} x join p{k} y on {near} group by 1, 2),
n{k} as materialized (select part, count(*) as n from p{k} group by 1), s{k} as materialized (select part, sum(len) as len from i{k} group by 1),
b{k} as materialized (select part, other, len from i{k} where part <> other union all select n.part, null, 4 * n.n - coalesce(s.len, 0) from n{k} n left join s{k} s using (part) where 4 * n.n > coalesce(s.len, 0))"""


def _given(losers: str, k: int, out: str) -> str:
    """out: cells after the losers took their neighbours' category."""
    return f"""l{k} as materialized ({losers}), g{k} as (select part, new from (select b.part, x.category as new, row_number() over (partition by b.part order by b.len desc, b.other) as n from b{k} b join (select distinct part, category from p{k}) x on x.part = b.other
  where b.part in (select part from l{k}) and b.other not in (select part from l{k}) and x.category is not null) q where n = 1),
{out} as materialized (select p.id, p.col, p.row, coalesce(g.new, p.category) as category from p{k} p left join g{k} g on g.part = p.part)"""


_LEAST = {"Vann": 3, "Skog": 6, "Myr": 4}


@query(None)
def least_sizes(t):
    """A pass for each category with its own least size, each on what the one before left"""
    return landuse.eliminate_by_category(t.landuse.select("id", "col", "row", "category"), _LEAST, work(t)).select("id", "category")


_COARSE = "(select id, col, row, case when category in ('Skog', 'Myr') then 'Land' else category end as category from landuse)"


@query(f"""with recursive c as materialized (select * from {_COARSE} q), {_parts("c", 0)}, {_given("select part from p0 group by part having count(*) <= 4 and part in (select part from b0 group by part having count(*) = 1 and count(other) = 1)", 0, "d")} select id, category from d""")
def filled_holes(t):
    """Small holes take the category around them"""
    c = F.when(F.col("category").isin("Skog", "Myr"), "Land").otherwise(F.col("category"))
    return landuse.fill_holes(t.landuse.select("id", "col", "row", c.alias("category")), 4, work(t)).select("id", "category")


@query(f"""with recursive c as materialized (select id, col, row, nullif(category, 'Aapent') as category from landuse), {_parts("c", 0)}, {_given("select distinct part from p0 where category is null", 0, "d")} select id, category from d""")
def filled_missing(t):
    """Cells without category take that of the longest border"""
    c = F.when(F.col("category") != "Aapent", F.col("category"))
    return landuse.fill_missing(t.landuse.select("id", "col", "row", c.alias("category")), work(t)).select("id", "category")


@query(f"""with recursive {_parts("landuse", 0)} select part, main, sub from (select part, main, sub, row_number() over (partition by part order by count(*) desc, min(id)) as k from p0 group by part, main, sub) q where k = 1""")
def restored_attributes(t):
    """Dissolved parts with the attributes that most of their cells had"""
    whole = landuse.parts(t.landuse, work(t))
    return landuse.restored(whole, t.landuse, ["main", "sub"])
