"""Queries on short cycles and thinning by class."""

from __future__ import annotations

from geoquill.operators import thinning
from geoquill.plans.registry import query, work

#: Greatest length of a cycle that is broken, least length of a dead end that stays, greatest class that stays as a dead end.
CYCLE, END, KEEP = 60_000, 12_000, 1


@query(f"""with e as (select * from (select least(src, dst) as a, greatest(src, dst) as b, class, line_id, length_cm as w, row_number() over (partition by least(src, dst), greatest(src, dst) order by class, line_id) as r from lines where src <> dst) where r = 1),
s as (select a, b, class, line_id, w from e union all select b, a, class, line_id, w from e),
v as (select p.b as y, q.b as z, p.a as mid, p.w + q.w as w, case when (p.class, p.line_id) > (q.class, q.line_id) then p.class else q.class end as c, case when (p.class, p.line_id) > (q.class, q.line_id) then p.line_id else q.line_id end as l from s p join s q on q.a = p.a and p.b < q.b)
select distinct m.l as line_id from v m join v o on o.y = m.y and o.z = m.z and o.mid <> m.mid and (o.c, o.l) < (m.c, m.l) and o.w + m.w <= {CYCLE}""")
def four_cycle_lines(t):
    """The lines that go of cycles of four, by class, ties by line_id"""
    return thinning.cycle_losers(t.lines, 4, "class", CYCLE)


@query(None)
def without_short_cycles(t):
    """Cycles of one, two, three and four lines broken in this order, each by its line of highest class"""
    return thinning.without_cycles(t.lines.select("line_id", "src", "dst", "class", "length_cm"), work(t), "class", CYCLE)


@query(None)
def thinned_by_class(t):
    """Short cycles broken by class, then dead ends of the lower classes until nothing changes"""
    return thinning.thinned(t.lines.select("line_id", "src", "dst", "class", "length_cm"), work(t), "class", KEEP, CYCLE, END)
