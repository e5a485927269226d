"""Queries that plan and make partitioned runs, and that run categories and steps one after the other."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoquill.operators import overlay, partitioning, spatial
from geoquill.plans.registry import query, work
from geoquill.plans.steps import Category, History, Pipeline, run_categories


@query("""with s as (select unnest([64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384]) as size), c as (select size, cast(floor(x / (1.0 * size)) as bigint) as col, cast(floor(y / (1.0 * size)) as bigint) as row, count(*) as n from pts, s group by 1, 2, 3)
select c.size, c.col, c.row, c.n from c left join c p on p.size = 2 * c.size and p.col = floor(c.col / 2.0) and p.row = floor(c.row / 2.0) where (c.size = 16384 or p.n > 40) and (c.n <= 40 or c.size = 64)""")
def planned_cells(t):
    """Cells of at most 40 rows, split in four where they hold more"""
    return partitioning.quad_cells(t.pts, 40, 16384, 64)


_LOAD = """select s.size, max(n) as most from (select s.size, c.col, r.row, count(*) as n from pts p, (select unnest([125, 250, 500, 1000, 2000]) as size) s, (select unnest(range(-1, 85)) as col) c, (select unnest(range(-1, 85)) as row) r
where c.col between floor((p.x - 100) / s.size) - 1 and floor((p.x + 100) / s.size) and r.row between floor((p.y - 100) / s.size) - 1 and floor((p.y + 100) / s.size)
and ((c.col = floor(p.x / s.size) and r.row = floor(p.y / s.size)) or greatest(c.col * s.size - p.x, p.x - (c.col + 1) * s.size, 0) ** 2 + greatest(r.row * s.size - p.y, p.y - (r.row + 1) * s.size, 0) ** 2 <= 10000) group by 1, 2, 3) s group by 1"""


@query(f"select size, most as load from ({_LOAD}) r where size = coalesce((select max(size) from ({_LOAD}) q where most <= 60), 125)")
def cell_size_search(t):
    """The largest of the sizes tried at which no cell holds more than 60 rows, halo included, or the least one, and how many rows its fullest cell holds"""
    size, load = partitioning.sized_cells(t.pts, 60, 2000, 100, 125)
    return t.spark.range(1).select(F.lit(size).cast("bigint").alias("size"), F.lit(load).cast("bigint").alias("load"))


@query("select h.id from hubs h where exists (select 1 from pts p where p.code = 970 and (h.x - p.x) * (h.x - p.x) + (h.y - p.y) * (h.y - p.y) <= 90000)")
def context_features(t):
    """Context near any of the features that are processed, once each"""
    near = spatial.within_distance(t.hubs, t.pts.where("code = 970"), 300)
    return spatial.select_by_location(t.hubs, near, "a_id").select("id")


def _crowd(frame):
    """Neighbours within 100 of each row of a cell and its halo: one sorted sweep over x."""
    import numpy as np

    f = frame.sort_values(["x", "id"])
    x, y = f["x"].to_numpy(), f["y"].to_numpy()
    lo, hi = np.searchsorted(x, x - 100, "left"), np.searchsorted(x, x + 100, "right")
    n = [int((((x[a:b] - x[i]) ** 2 + (y[a:b] - y[i]) ** 2) <= 10000).sum()) - 1 for i, (a, b) in enumerate(zip(lo, hi, strict=True))]
    return f[["id"]].assign(neighbours=n)


@query("select a.id, (select count(*) from pts b where b.id <> a.id and (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 10000) as neighbours from pts a")
def partitioned_run(t):
    """A function on each cell and its halo; a cell gives rows that it owns only"""
    return partitioning.run_partitioned(t.pts.select("id", "x", "y"), 500, 100, _crowd, "id long, neighbours long")


@query("""select id, col, row, greatest(xmin, col * 500) as x0, greatest(ymin, row * 500) as y0, least(xmax, (col + 1) * 500) as x1, least(ymax, (row + 1) * 500) as y1
from boxes, (select unnest(range(0, 25)) as col) c, (select unnest(range(0, 25)) as row) r where xmin < (col + 1) * 500 and xmax > col * 500 and ymin < (row + 1) * 500 and ymax > row * 500""")
def clipped_output(t):
    """Results cut at the borders of their cells"""
    return partitioning.clip(t.boxes, 500)


def grown(own, cells):
    """A category's cells and those beside them."""
    beside = overlay.cell_neighbours(cells).join(own.select("id"), "id", "left_semi").select(F.col("other").alias("id"))
    return cells.join(own.select("id").union(beside).distinct(), "id", "left_semi").select("id", "col", "row")


def thinned(own):
    """A category's cells that have another of it beside them."""
    return own.join(overlay.cell_neighbours(own).select("id").distinct(), "id", "left_semi")


def _beside(table: str, category: str) -> str:
    """SQL of a table's cells, touched: whether a cell beside has the category."""
    ids = " union ".join(f"select a.id from {table} a join {table} n on n.col = a.col + {dx} and n.row = a.row + {dy} where n.category = '{category}'" for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)))
    return f"select a.*, a.id in ({ids}) as touched from {table} a"


_CELLS = "select id, col, row, case (id * id * 7 + id) % 5 when 0 then 'Skog' when 1 then 'Myr' else 'Vann' end as category"


def _cells(t):
    k = (F.col("id") * F.col("id") * 7 + F.col("id")) % 5
    return t.landuse.select("id", "col", "row", F.when(k == 0, "Skog").when(k == 1, "Myr").otherwise("Vann").alias("category"))


@query(f"""with cells as ({_CELLS} from landuse), myr as ({_beside('cells', 'Myr')}), one as (select id, col, row, case when category <> 'Skog' and touched then 'Myr' else category end as category from myr),
vann as ({_beside('one', 'Vann')}), two as (select id, col, row, case when touched then 'Vann' else category end as category from vann) select id, category from two""")
def category_loop(t):
    """Categories edited in order, each locked then. Myr grows but not over the locked Skog; Vann grows over all that it touches"""
    ws = work(t)
    cats = [Category("Vann", ["grow"], 2), Category("Myr", ["grow"], 1, reinsert=True), Category("Skog", [], 0, accessible=False)]
    return run_categories(_cells(t), cats, {"grow": grown}, History(t.spark, f"{ws.root}/history"), ws.root).select("id", "category")


@query("""select 'Myr' as title, false as accessible, cast(1 as bigint) as done union all select 'Skog', false, 0 union all select 'Vann', false, 1""")
def category_history(t):
    """What the history says of a run that was stopped after its first category and started again"""
    ws = work(t)
    cats = [Category("Vann", ["thin"], 2), Category("Myr", ["grow"], 1, reinsert=True), Category("Skog", [], 0, accessible=False)]
    cells, history = _cells(t), History(t.spark, f"{ws.root}/history")
    try:
        run_categories(cells, cats, {"grow": grown}, history, ws.root)
    except KeyError:  # thin isn't registered yet
        pass
    run_categories(cells, cats, {"grow": grown, "thin": thinned}, history, ws.root)
    return t.spark.createDataFrame([(c.title, c.accessible, c.done) for c in history.restore()], "title string, accessible boolean, done long")


@query("select id, code * 2 as code from pts where code < 800")
def resumed_steps(t):
    """A list of steps run again reads what is finished"""
    steps = [("select", lambda df: df.where("code < 800").select("id", "code")), ("double", lambda df: df.withColumn("code", F.col("code") * 2))]
    p = Pipeline(t.spark, work(t).root, steps[:1])
    p.run(t.pts)
    return Pipeline(t.spark, p.root, steps).run(t.pts)
