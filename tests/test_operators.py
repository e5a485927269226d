import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geoquill.functions import codes, geometry
from geoquill.operators import clusters, gaps, network, partitioning, spatial
from geoquill.operators.graph import connected_components
from geoquill.operators.ordering import running_totals
from geoquill.plans.steps import Category, Pipeline, dispatch, edit_categories, recolour
from geoquill.sources import tables
from geoquill.workspace import Workspace, shared_dir


def components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_connected_components(spark, one_task):
    r = random.Random(4)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {x.id: x.component for x in connected_components(df, Workspace(spark, "t"), one_task=one_task).collect()}
    assert got == components([e for e in edges if None not in e and e[0] != e[1]])


def test_connected_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long"), Workspace(spark, "t")).count() == 0


def test_running_totals(spark):
    rows = [(k % 3 if k % 5 else None, k, k % 7 or None) for k in range(50)]
    df = spark.createDataFrame(rows, "g int, k long, v long")
    got = {x.k: (x.row_no, x.before) for x in running_totals(df, Workspace(spark, "t"), ["k"], ["g"], "v", 4).collect()}
    for g, k, _ in rows:
        earlier = [v or 0 for h, j, v in rows if h == g and j < k]
        assert got[k] == (len(earlier), sum(earlier))
    assert running_totals(df.limit(0), Workspace(spark, "t"), ["k"]).count() == 0


def test_within_distance_and_nearest(spark):
    r = random.Random(2)
    pts = [(i, r.randrange(-300, 300), r.randrange(-300, 300)) for i in range(80)]
    df = spark.createDataFrame(pts, "id long, x long, y long")
    want = {(a[0], b[0]) for a in pts for b in pts if (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 90**2}
    assert {(x.a_id, x.b_id) for x in spatial.within_distance(df, df, 90).collect()} == want
    near = {x.a_id: x.d2 for x in spatial.nearest_one(df, df.where("id < 5"), 50, 7).collect()}
    assert near == {a[0]: min((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 for b in pts[:5]) for a in pts}


def test_dbscan_and_independent_set(spark):
    r = random.Random(6)
    pts = [(i, r.randrange(500), r.randrange(500)) for i in range(70)]
    df = spark.createDataFrame(pts, "id long, x long, y long")
    d2 = lambda a, b: (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2
    near = {a[0]: [b[0] for b in pts if d2(a, b) <= 60**2] for a in pts}
    core = {i for i, n in near.items() if len(n) >= 4}
    comp = components([(i, j) for i in core for j in near[i] if j in core])
    want = {i: comp[i] for i in core} | {i: comp[min(j for j in near[i] if j in core)] for i in near if i not in core and any(j in core for j in near[i])}
    assert {x.id: x.cluster for x in clusters.dbscan(df, 60, 4, Workspace(spark, "t")).collect()} == want
    kept = {x.id for x in clusters.independent_set(df, 60, Workspace(spark, "t")).collect()}
    assert all(j == i or j not in kept for i in kept for j in near[i])
    assert all(i in kept or any(j in kept for j in near[i]) for i in near)


def test_strahler(spark):
    # two sources meet twice, a cycle below, a lone line
    lines = [(1, 1, 3), (2, 2, 3), (3, 3, 6), (4, 4, 6), (5, 5, 6), (6, 6, 7), (7, 10, 11), (8, 11, 12), (9, 12, 11), (10, 20, 21)]
    got = {x.line_id: x.strahler for x in network.strahler(spark.createDataFrame(lines, "line_id long, src long, dst long"), Workspace(spark, "t")).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1, 6: 2, 7: 1, 8: 1, 9: 1, 10: 1}


def test_cycles_and_loops(spark):
    lines = [(1, 1, 2), (2, 2, 3), (3, 3, 1), (4, 4, 4), (5, 5, 6), (6, 6, 5), (7, 7, 8), (8, 8, 9), (9, 9, 10), (10, 10, 7)]
    df = spark.createDataFrame(lines, "line_id long, src long, dst long")
    ids = lambda d: sorted(x.line_id for x in d.collect())
    assert ids(network.self_loops(df)) == [4]
    assert ids(network.parallel_lines(df)) == [5, 6]
    assert ids(network.triangle_lines(df)) == [1, 2, 3]
    assert ids(network.quad_lines(df)) == [7, 8, 9, 10]


def test_spanning_forest(spark):
    r = random.Random(8)
    lines = [(i, r.randrange(25), r.randrange(25), r.randrange(10)) for i in range(80)]
    df = spark.createDataFrame(lines, "line_id long, src long, dst long, length_cm long")
    got = {x.line_id for x in network.spanning_forest(df, Workspace(spark, "t")).collect()}
    parent = list(range(25))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    want = set()
    for i, s, d, _ in sorted(lines, key=lambda x: (x[3], x[0])):
        if root(s) != root(d):
            parent[root(s)] = root(d)
            want.add(i)
    assert got == want


def test_gap_acceptance_has_no_cycle(spark):
    c = spark.createDataFrame([(1, 2, 1, 2, 0.1, 1), (2, 3, 2, 3, 0.2, 1), (3, 1, 3, 1, 0.3, 1), (8, 9, 8, 9, 0.9, 1)], "a_id long, b_id long, a_comp long, b_comp long, score double, d2 long")
    assert {(x.a_id, x.accepted, x.reason) for x in gaps.accept(c).collect()} == {(1, True, None), (2, True, None), (3, False, "cycle"), (8, True, None)}


def test_partition_ownership(spark):
    pts = [(1, 50, 50), (2, 99, 50), (3, 150, 150), (4, 320, 20)]
    df = spark.createDataFrame(pts, "id long, x long, y long")
    own = Counter(x.id for x in partitioning.assign(df, 100, 10).where("owned").collect())
    assert own == {1: 1, 2: 1, 3: 1, 4: 1}
    out = partitioning.run_partitioned(df, 100, 10, lambda f: f.assign(n=len(f))[["id", "n"]], "id long, n long")
    assert {(x.id, x.n) for x in out.collect()} == {(1, 2), (2, 2), (3, 1), (4, 1)}
    assert partitioning.cell_size(df, 1, 400, 0) <= 100


def test_steps_resume(spark, tmp_path):
    ran = []

    def double(df):
        ran.append("double")
        return df.select((F.col("id") * 2).alias("id"))

    p = Pipeline(spark, f"file://{tmp_path}", [("double", double), ("big", lambda df: df.where("id > 3"))])
    assert p.done() == 0
    assert sorted(x.id for x in p.run(spark.range(4)).collect()) == [4, 6]
    assert p.done() == 2 and sorted(x.id for x in p.run(spark.range(4)).collect()) == [4, 6]
    assert ran == ["double"]


def test_categories(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, category string")
    seen = []

    def note(df, title, locked):
        seen.append((title, locked))
        return df

    reg = {"note": note, "recolour": lambda df, title: recolour(df, title, "c")}
    out = edit_categories(df, [Category("b", ["note", "recolour"], 2), Category("a", ["note"], 1), Category("x", [], 0, accessible=False)], reg)
    assert seen == [("a", ["x"]), ("b", ["x", "a"])]
    assert [x.category for x in out.orderBy("id").collect()] == ["a", "c"]
    with pytest.raises(KeyError):
        dispatch(reg, "none")


def test_expressions_with_nulls(spark):
    df = spark.createDataFrame([(1, 0, 0, 0, 0), (2, 0, 0, 3, 4), (3, None, 0, 1, 1)], "id int, x1 int, y1 int, x2 int, y2 int")
    c = [F.col(k) for k in ("x1", "y1", "x2", "y2")]
    got = df.select("id", geometry.direction(*c).alias("d"), geometry.trim(*c, 1.0).isNull().alias("t"), codes.local_number(F.lit("1.234,5 m")).alias("n")).orderBy("id").collect()
    assert got[0].d is None and got[0].t and round(got[1].d, 3) == 53.13 and not got[1].t and got[2].d is None
    assert got[0].n == 1234.5


def test_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(1, "a"), (2, None)], "id long, v string").write.parquet(path)
    df = tables.scan(spark, path, ["id"], "id > 1")
    assert [x.id for x in df.collect()] == [2]
    full = tables.scan(spark, path)
    up = tables.update(full, spark.createDataFrame([(2, "z")], "id long, v string"), "id", "v")
    assert {(x.id, x.v) for x in up.collect()} == {(1, "a"), (2, "z")}
    with pytest.raises(ValueError):
        tables.scan(spark, path, schema=spark.createDataFrame([], "other int").schema)
    assert tables.empty_like(full).count() == 0
    assert tables.validate_catalog(["a", "b"], ["b", "c"]) == ({"a"}, {"c"})


def test_shared_dir_is_the_session_setting(spark):
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = shared_dir(spark)
    assert got == own.rstrip("/") if own else got == spark.conf.get("geoquill.local.dir")


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(length=st.floats(1, 500), interval=st.floats(1, 100))
def test_even_positions_cover_the_line(spark, length, interval):
    import math

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from geoquill.functions.geometry import even_positions

    got = SparkSession.getActiveSession().range(1).select(even_positions(F.lit(length), interval).alias("p")).first().p
    assert len(got) == max(1, math.ceil(length / interval)) and got[0].a == 0 and abs(got[-1].b - length) < 1e-9 * length
    assert all(x.b == y.a for x, y in zip(got, got[1:])) and max(x.b - x.a for x in got) <= interval * (1 + 1e-9)


def test_whole_priority_order_places_every_line(spark):
    from geoquill.plans import catalog
    from geoquill.sources.fixtures import Tables

    sf = "/root/testdata/sf0.01"
    got = [x.place for x in catalog.queries()["priority_order_all"](spark, sf).collect()]
    assert sorted(got) == list(range(1, Tables(spark, sf).lines.count() + 1))


def test_line_editing_and_conflicts_cover_every_row(spark):
    from geoquill.plans import catalog
    from geoquill.sources.fixtures import Tables

    sf = "/root/testdata/sf0.01"
    t, q = Tables(spark, sf), catalog.queries()
    assert q["line_editing_all"](spark, sf).count() == t.lines.count()
    boxes = [tuple(x) for x in t.boxes.select("id", "class", "xmin", "ymin", "xmax", "ymax").collect()]
    by_class = {}
    for x in boxes:
        by_class.setdefault(x[1], []).append(x)
    want = {i: sum(b[0] != i and b[2] < xmax and xmin < b[4] and b[3] < ymax and ymin < b[5] for b in by_class[c]) for i, c, xmin, ymin, xmax, ymax in boxes}
    assert {x.id: x.same_class for x in q["conflicts_in_class_all"](spark, sf).collect()} == want


def test_ids_that_are_not_covered_stand_in_no_docstring():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    listed = set(re.findall(r"\b[LN][0-9]{2}\b", (root / "README.md").read_text().split("## Not covered")[1]))
    claimed = {x for p in (root / "geoquill/plans").glob("*.py") for x in re.findall(r"\b[LN][0-9]{2}\b", p.read_text())}
    assert {"L04", "N20", "N42"} <= listed and not listed & claimed


def test_candidates_rank_other_components_only(spark):
    """Four dangles of one component stand nearer to one another than a foreign one."""
    from geoquill.operators import gaps
    from geoquill.workspace import Workspace

    star = [(k, 0, k, 0, 0, *p) for k, p in enumerate([(10, 0), (0, 10), (-10, 0), (0, -10)], 1)]
    rows = [*star, (9, 20, 21, 25, 0, 90, 0)]
    lines = spark.createDataFrame([(*r, 1000) for r in rows], "line_id long, src long, dst long, x1 long, y1 long, x2 long, y2 long, length_cm long")
    for k in (1, 2, 9):
        got = {(x.a_id, x.b_id) for x in gaps.candidates(lines, 40, k, Workspace(spark, "t")).collect()}
        assert {(a, 20) for a in (1, 2, 3, 4)} - {(3, 20)} <= got and all((a < 9) != (b < 9) for a, b in got), got


def test_nearest_one_goes_on_until_all_have_one(spark):
    from geoquill.operators import spatial

    a = spark.createDataFrame([(1, 0, 0), (2, 13_000, 0), (3, 10_000_000, 5), (4, None, 0)], "id long, x long, y long")
    b = spark.createDataFrame([(7, 0, 1)], "id long, x long, y long")
    got = {x.a_id: x.d2 for x in spatial.nearest_one(a, b, 400).collect()}
    assert got == {1: 1, 2: 13_000**2 + 1, 3: 10_000_000**2 + 16}
    assert {x.a_id for x in spatial.nearest_one(a, b, 400, 2).collect()} == {1}
    assert spatial.nearest_one(a, b.limit(0), 400).count() == 0


def test_walk_follows_the_line():
    from geoquill.functions.kernels import walk

    path = [(0, 0), (100, 0), (100, 100), (0, 100), (0, 200)]
    parts = [(k, k, k + 1, *path[k], *path[k + 1]) for k in range(4)]
    parts[2] = (2, 3, 2, *path[3], *path[2])
    assert walk([parts[i] for i in (2, 0, 3, 1)]) == path
    ring = [(1, 5, 6, 0, 0, 1, 0), (2, 6, 7, 1, 0, 1, 1), (3, 7, 5, 1, 1, 0, 0)]
    assert walk(ring) == [(0, 0), (1, 0), (1, 1), (0, 0)]


def test_rounds_end_with_an_error():
    import pytest

    from geoquill.operators.graph import rounds

    with pytest.raises(RuntimeError):
        list(rounds(3))


def test_deep_river_has_its_order(spark):
    """Two arms that meet far below their sources: order 2 from there on."""
    from geoquill.operators import network
    from geoquill.workspace import Workspace

    arms = [(k, k, k + 1) for k in range(6)] + [(10 + k, 100 + k, 101 + k if k < 5 else 6) for k in range(6)] + [(30, 6, 7)]
    got = {x.line_id: x.strahler for x in network.strahler(spark.createDataFrame(arms, "line_id long, src long, dst long"), Workspace(spark, "t")).collect()}
    assert got == {k: 2 if k == 30 else 1 for k, *_ in arms}


def test_updates_set_nulls_and_keep_one_row_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "id long, v string")
    got = tables.update(df, spark.createDataFrame([(1, None), (2, "x"), (2, "y"), (2, None), (9, "z")], "id long, v string"), "id", "v")
    assert sorted(got.collect(), key=str) == sorted([(1, None), (2, "y"), (3, "c"), (None, "d")], key=str)


def test_cells_that_cannot_hold_fewer_are_reported(spark):
    df = spark.createDataFrame([(k, 5, 5) for k in range(10)], "id long, x long, y long")
    assert partitioning.sized_cells(df, 3, 64, 0) == (1, 10)
    with pytest.raises(ValueError):
        partitioning.cell_size(df, 3, 64, 0)


def test_segments_are_cut_where_others_lie_along_them(spark):
    from geoquill.operators import shapes

    df = spark.createDataFrame([(1, 0, 0, 100, 0), (2, 50, 0, 150, 0), (3, 300, 0, 300, 9)], "id long, x1 long, y1 long, x2 long, y2 long")
    assert sorted(tuple(x) for x in shapes.planarise(df).collect()) == [(1, 0, 0.0, 0.5), (1, 1, 0.5, 1.0), (2, 0, 0.0, 0.5), (2, 1, 0.5, 1.0), (3, 0, 0.0, 1.0)]


def test_lines_that_cross_themselves(spark):
    from geoquill.operators import shapes

    p = lambda *v: [{"x": x, "y": y} for x, y in v]
    rows = [(1, p((0, 0), (10, 10), (10, 0), (0, 10))), (2, p((0, 0), (10, 0), (10, 10), (0, 0))), (3, p((0, 0), (10, 0), (4, 0))), (4, p((0, 0), (9, 0))), (5, p((0, 0), (10, 0), (10, 5), (5, 0), (5, -9))), (6, None)]
    got = {x.id: x.n for x in shapes.self_crossings(spark.createDataFrame(rows, "id long, line array<struct<x:bigint,y:bigint>>"), "line").collect()}
    assert set(got) == {1, 3, 5} and got[1] == got[3] == 1
