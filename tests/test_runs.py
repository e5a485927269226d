"""Category runs that are stopped and started again, planning of cells, and shapes with nulls."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoquill.operators import network, partitioning, shapes
from geoquill.plans.steps import Category, History, Pipeline, run_categories
from geoquill.sources import tables
from geoquill.workspace import Workspace

CELLS = "id long, col long, row long, category string"


def history(spark, tmp_path):
    return History(spark, f"file://{tmp_path}/history")


def test_history_without_a_file(spark, tmp_path):
    h = history(spark, tmp_path)
    assert h.get("newest_version") is None and h.get("unknown") is None and h.get("done", "none") is None
    assert h.restore() == []


def test_history_update_reset_restore(spark, tmp_path):
    h = history(spark, tmp_path)
    cats = [Category("a", ["x", "y"], 1), Category("b", [], 2, accessible=False, reinsert=True)]
    h.save_categories(cats)
    h.update("a", done=1)
    h.update(newest_version="there", preprocessing_operations_completed=2)
    again = History(spark, h.root)
    assert again.get("done", "a") == 1 and again.get("newest_version") == "there" and again.get("preprocessing_operations_completed") == 2
    assert [(c.title, c.done, c.accessible, c.reinsert) for c in again.restore()] == [("a", 1, True, False), ("b", 0, False, True)]
    again.reset()
    assert h.restore() == [] and h.get("newest_version") is None


@pytest.mark.parametrize(("operations", "done", "runs"), [(2, 0, 2), (4, 2, 2), (4, 4, 0)])
def test_category_goes_on_where_it_stopped(spark, tmp_path, operations, done, runs):
    ran = []

    def keep(own):
        ran.append(1)
        return own

    cells = spark.createDataFrame([(1, 0, 0, "a"), (2, 1, 0, "b")], CELLS)
    last = f"file://{tmp_path}/last"
    cells.where("category = 'a'").select("id", "col", "row").write.parquet(last)
    h = history(spark, tmp_path)
    h.save_categories([Category("a", ["keep"] * operations, 1, done=done, last=last if done else None)])
    out = run_categories(cells, [], {"keep": keep}, h, f"file://{tmp_path}/run")
    assert len(ran) == runs and sorted((x.id, x.category) for x in out.collect()) == [(1, "a"), (2, "b")]
    assert h.get("accessible", "a") is False and h.get("done", "a") == operations


def test_steps_go_on_after_two_of_ten(spark, tmp_path):
    ran = []

    def step(i):
        def run(df):
            ran.append(i)
            return df.select((F.col("id") + 1).alias("id"))

        return f"s{i}", run

    steps = [step(i) for i in range(10)]
    Pipeline(spark, f"file://{tmp_path}/p", steps[:2]).run(spark.range(1))
    ran.clear()
    assert Pipeline(spark, f"file://{tmp_path}/p", steps).run(spark.range(1)).first().id == 10
    assert ran == list(range(2, 10))


def test_locked_cells_and_reinsertion(spark, tmp_path):
    cells = spark.createDataFrame([(1, 0, 0, "a"), (2, 1, 0, "lock"), (3, 2, 0, "b"), (4, 3, 0, None)], CELLS)
    everything = {"all": lambda cells: cells.select("id", "col", "row")}
    for reinsert, want in ((True, ["a", "lock", "a", "a"]), (False, ["a"] * 4)):
        cats = [Category("a", ["all"], 1, reinsert=reinsert), Category("lock", [], 2, accessible=False), Category("none", ["all"], 3)]
        out = run_categories(cells, cats, everything, History(spark, f"file://{tmp_path}/{reinsert}/h"), f"file://{tmp_path}/{reinsert}/r")
        assert [x.category for x in out.orderBy("id").collect()] == want


def test_planned_cells(spark):
    r = random.Random(5)
    pts = [(i, r.randrange(-500, 500), int(r.gauss(0, 40))) for i in range(400)]
    got = {(x.size, x.col, x.row): x.n for x in partitioning.quad_cells(spark.createDataFrame(pts, "id long, x long, y long"), 30, 512, 16).collect()}

    def split(size, col, row):
        own = [p for p in pts if p[1] // size == col and p[2] // size == row]
        if len(own) <= 30 or size == 16:
            return {(size, col, row): len(own)} if own else {}
        return {k: v for i in (0, 1) for j in (0, 1) for k, v in split(size // 2, 2 * col + i, 2 * row + j).items()}

    want = {k: v for col, row in {(p[1] // 512, p[2] // 512) for p in pts} for k, v in split(512, col, row).items()}
    assert got == want and sum(got.values()) == len(pts)
    assert partitioning.quad_cells(spark.createDataFrame([], "id long, x long, y long"), 30, 512, 16).count() == 0


def test_shapes_with_faults(spark):
    p, q = (0, 0), (3, 4)
    rows = [(1, None), (2, []), (3, [p]), (4, [p, p]), (5, [p, p, q]), (6, [p, q, p]), (7, [q, p])]
    df = spark.createDataFrame(rows, "id long, line array<struct<x:long,y:long>>")
    assert [x.problem for x in df.select("id", shapes.problem("line").alias("problem")).orderBy("id").collect()] == ["null geometry", "empty", "short", "short", "repeated vertices", None, None]
    assert {x.id: [tuple(v) for v in x.line] for x in shapes.repaired(df, "line").collect()} == {5: [p, q], 6: [p, q, p], 7: [q, p]}
    assert Counter(x.id for x in shapes.split_at_vertices(df, "line", "id").collect()) == {4: 1, 5: 2, 6: 2, 7: 1}
    assert Counter(x.id for x in shapes.single_parts(df, "line", "id").collect()) == {3: 1, 4: 2, 5: 3, 6: 3, 7: 2}


def test_planarise(spark):
    # 2 lies along 4: its ends cut it too
    seg = [(1, 0, 0, 100, 0), (2, 50, -10, 50, 10), (3, 25, 0, 25, 30), (4, 50, -20, 50, 20), (5, 0, 50, 100, 50), (6, 7, 7, 7, 7), (7, 0, 0, 0, 9)]
    got = {}
    for x in shapes.planarise(spark.createDataFrame(seg, "id long, x1 long, y1 long, x2 long, y2 long")).collect():
        got.setdefault(x.id, []).append((x.a, x.b))
    assert {k: sorted(v) for k, v in got.items()} == {1: [(0, 0.25), (0.25, 0.5), (0.5, 1)], 2: [(0, 0.5), (0.5, 1)], 3: [(0, 1)], 4: [(0, 0.25), (0.25, 0.5), (0.5, 0.75), (0.75, 1)], 5: [(0, 1)], 6: [(0, 1)], 7: [(0, 1)]}


def test_cycles_and_triangles(spark):
    lines = [(1, 1, 2, 5), (2, 2, 3, 9), (3, 1, 3, 9), (4, 3, 4, 1), (5, 7, 8, 1), (6, 8, 7, 1), (7, 9, 9, 1)]
    df = spark.createDataFrame(lines, "line_id long, src long, dst long, class int")
    assert [x.line_id for x in network.triangle_losers(df, "class").collect()] == [3]
    assert {x.component: (x.nodes, x.edges, x.cycles) for x in network.cyclic_parts(df, Workspace(spark, "t")).collect()} == {1: (4, 4, 1), 7: (2, 2, 1), 9: (1, 1, 1)}


def test_table_edits(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    assert tables.unique_name(df, "V") == "V_1" and tables.unique_name(df, "w") == "w"
    with pytest.raises(ValueError):
        tables.insert(df, df.withColumnRenamed("v", "w"))
    assert [tuple(x) for x in tables.insert(df, spark.createDataFrame([(2,)], "id int")).orderBy("id").collect()] == [(1, "a"), (2, None)]
    other = spark.createDataFrame([(1, "b", 7)], "id long, v string, n int")
    assert [tuple(x) for x in tables.carry(df, other, "id", {"v": "u", "n": "n"}).collect()] == [(1, "a", "b", 7)]
    assert tables.state(df.limit(0)).first() == (False, 0)
