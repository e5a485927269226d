"""Keys, copies and graphs of the larger tables."""

import random

from pyspark.sql import functions as F

from geoquill.sources.fixtures import DERIVED, Tables, without_overflow


def cube(k, a, b):
    v = k * k * k * a + k * b
    return v % 10007 if v >= 0 else -(-v % 10007)


def test_cubes_of_large_keys(spark, tmp_path):
    """900,000 customers: a bigint overflows at k * k * k * 17."""
    keys = [0, 1, 10007, 899_999, 7_200_000, 50_000_000, -5, -900_001]
    spark.createDataFrame([(k, 1, "BUILDING", 1.0) for k in keys], "c_custkey long, c_nationkey int, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, 5, "SMALL") for k in keys], "p_partkey long, p_size int, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    t = Tables(spark, str(tmp_path))
    assert {r.id: r.y for r in t.pts.collect()} == {k: cube(k, 17, 104729) for k in keys}
    assert {r.id: r.ymin for r in t.boxes.collect()} == {k: cube(k, 13, 3571) for k in keys}
    assert t.tracks.count() == len(keys) and t.diamonds.where("cy is null").count() == 0


def test_no_cube_is_left():
    assert not [n for n, q in DERIVED.items() if " * k * k" in without_overflow(q).replace("(k * k * ", "(")]


def components(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def test_components_of_many_tasks(spark, monkeypatch):
    """Edges past one task's share: chains over all tasks, a hub that every task knows, and random links."""
    from geoquill.operators import graph
    from geoquill.workspace import Workspace

    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(400) if i % 57]
    hub = [(1000, 1001 + i) for i in range(200)]
    far = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(160)]
    edges = [(a, b) for a, b in chain + hub + far if a != b]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "src long, dst long")
    monkeypatch.setattr(graph, "ONE_TASK", 20)
    got = {x.id: x.component for x in graph.connected_components(df, Workspace(spark, "t"), one_task=0).collect()}
    assert got == components(edges)
    greater_first = df.selectExpr("greatest(src, dst) a", "least(src, dst) b").distinct()
    assert {x.id: x.component for x in graph._stars(greater_first, Workspace(spark, "t"), None).collect()} == components(edges)

    def no_steps(*a):
        raise AssertionError("near ids need no star steps")

    monkeypatch.setattr(graph, "_stars", no_steps)
    one = {x.id: x.component for x in graph.connected_components(spark.createDataFrame(chain, "src long, dst long"), Workspace(spark, "t"), one_task=20).collect()}
    assert one == components(chain)


BOXES = "id long, xmin long, ymin long, xmax long, ymax long"


def some_boxes(seed):
    rng = random.Random(seed)
    at = [(rng.randrange(-30, 90) * 10, rng.randrange(-30, 90) * 10) for _ in range(12)]
    rows = [(i, *rng.choice(at), rng.randrange(1, 30) * 10, rng.randrange(1, 30) * 10) for i in range(70)]
    return [(i, x, y, x + w, y + h) for i, x, y, w, h in rows]


def test_boxes_of_one_corner(spark):
    """Copies and boxes of one corner: centres, touching sides and parts, against all pairs."""
    from geoquill.operators import overlay, spatial
    from geoquill.workspace import Workspace

    rows = some_boxes(5)
    df = spark.createDataFrame([*rows, (900, None, 3, 5, 6)], BOXES)
    both = [(a, b) for a in rows for b in rows if a[0] != b[0]]
    inside = {a[0] for a, b in both if 2 * b[1] <= a[1] + a[3] <= 2 * b[3] and 2 * b[2] <= a[2] + a[4] <= 2 * b[4]}
    assert sorted(r.id for r in spatial.centres_in_others(df).collect()) == sorted(inside)
    meets = [(a, b) for a, b in both if a[0] < b[0] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]]
    touch = [(a[0], b[0]) for a, b in meets if a[3] == b[1] or b[3] == a[1] or a[4] == b[2] or b[4] == a[2]]
    assert sorted((r.a_id, r.b_id) for r in spatial.touching_boxes(df).collect()) == touch and touch
    of = components([(a[0], b[0]) for a, b in meets])
    assert {r.id: r.part for r in overlay.dissolve_boxes(df, Workspace(spark, "t")).collect()} == {i: of.get(i, i) for i in [900, *(r[0] for r in rows)]}
    assert spatial.outer_boxes(df).count() < len(rows) / 1.5


def test_copies_of_places(spark):
    """Copies of a place are compared once, and each copy gets the result."""
    from geoquill.operators import spatial

    rng = random.Random(8)
    at = [(rng.randrange(500), rng.randrange(500)) for _ in range(9)]
    a, b = ([(i, *rng.choice(at)) for i in range(80)] for _ in "ab")
    near = {}
    for i, x, y in a:
        d = min(((x - u) ** 2 + (y - v) ** 2, j) for j, u, v in b)
        if d[0] <= 150**2:
            near[i] = (d[1], d[0])
    df = [spark.createDataFrame([*p, (999, None, 5)], "id long, x long, y long") for p in (a, b)]
    assert {r.a_id: (r.b_id, r.d2) for r in spatial.nearest_place(*df, 150).collect()} == near
    assert spatial.places(df[0]).count() <= 9


def slow_merge(points, limit):
    p = [(float(x), float(y), 1) for _, x, y in sorted(points)]
    while True:
        d = [((p[j][0] - p[i][0]) ** 2 + (p[j][1] - p[i][1]) ** 2, i, j) for i in range(len(p)) for j in range(i + 1, len(p))]
        d = [x for x in d if x[0] < limit * limit + 1e-9]
        if not d:
            return sorted(p)
        _, i, j = min(d)
        n = p[i][2] + p[j][2]
        p[i] = ((p[i][0] * p[i][2] + p[j][0] * p[j][2]) / n, (p[i][1] * p[i][2] + p[j][1] * p[j][2]) / n, n)
        del p[j]


def test_merging_copies(spark):
    """Nearest pairs first, as all pairs say; then 30,000 points on 300 places, whose search of all pairs would not end."""
    from geoquill.operators import clusters

    rng = random.Random(2)
    points = [(i, rng.randrange(-40, 40) * 10, rng.randrange(-40, 40) * 10) for i in range(90)] + [(100 + i, 50, 50) for i in range(5)]
    df = spark.createDataFrame([("A", *p) for p in points], "objtype string, id long, x long, y long")
    assert sorted((r.x, r.y, r.members) for r in clusters.merge_nearest(df, {"A": 100}).collect()) == slow_merge(points, 100)
    many = spark.range(30_000).select(F.lit("B").alias("objtype"), "id", (F.col("id") % 300 * 50).alias("x"), F.lit(0).alias("y"))
    assert {(r.members) for r in clusters.merge_nearest(many, {"B": 20}).collect()} == {100}


def test_strahler_over_ranges(spark, monkeypatch):
    """Ranges of few lines give what one task gives; a path of 60 lines takes as many rounds as it changes ranges."""
    from geoquill.operators import network
    from geoquill.workspace import Workspace

    rng = random.Random(4)
    rows = [(i, i, i + 1) for i in range(60)] + [(100 + i, a, a + rng.randrange(1, 9)) for i, a in enumerate(rng.choices(range(100, 160), k=70))] + [(200, 300, 301), (201, 301, 300), (202, 301, 302)]
    order, left = {}, True
    while left:
        done = {s for _, s, _ in rows if s not in order and all(x in order for _, x, d in rows if d == s)}
        left = bool(done)
        for s in done:
            flow = sorted((order[x] for _, x, d in rows if d == s), reverse=True)
            order[s] = 1 if not flow else flow[0] + (len(flow) > 1 and flow[0] == flow[1])
    df = spark.createDataFrame(rows, "line_id long, src long, dst long")
    for size in (25, 10**6):
        monkeypatch.setattr(network, "STRAHLER_LINES", size)
        got = {r.line_id: r.strahler for r in network.strahler(df, Workspace(spark, "t"), limit=20).collect()}
        assert got == {i: order.get(s, 1) for i, s, _ in rows}
