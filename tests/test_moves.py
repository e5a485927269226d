"""Displacement and divided roads."""

import math
import random

from pyspark.sql import functions as F

from geoquill.operators import displacement, parallels
from geoquill.workspace import Workspace


def far(px, py, ax, ay, bx, by):
    l2 = (bx - ax) ** 2 + (by - ay) ** 2
    t = max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / l2)) if l2 else 0
    return math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay))


def test_moves_fade_with_distance(spark):
    links = spark.createDataFrame([(0, 0, 10, 0), (1000, 0, 0, 20)], "x long, y long, dx long, dy long")
    pts = spark.createDataFrame([(k, k * 50, 0) for k in range(21)] + [(99, 5000, 5000)], "id long, x long, y long")
    got = {x.id: (x.dx, x.dy) for x in displacement.propagated(pts, links, 400).collect()}
    assert got[0] == (10.0, 0.0) and got[99] == (0.0, 0.0) and got[20] == (0.0, 20.0)
    size = [got[k][0] for k in range(10)]
    assert all(a > b or a == b == 0 for a, b in zip(size, size[1:])) and got[7][0] > 0 and got[8][0] == 0


def test_vertices_are_pushed_away(spark):
    df = spark.createDataFrame([([{"x": 0, "y": 0}, {"x": 3, "y": 4}, {"x": 30, "y": 0}],)], "line array<struct<x:bigint,y:bigint>>")
    got = [(p.x, p.y) for p in df.select(displacement.pushed_vertices(F.col("line"), F.lit(0), F.lit(0), 10.0).alias("v")).first().v]
    assert got == [(10, 0), (6, 8), (30, 0)]


def test_points_find_room_or_report_what_is_lacking(spark):
    r = random.Random(3)
    walls = [(k, *(r.uniform(0, 400) for _ in range(4)), r.choice([2.0, 5.0])) for k in range(12)] + [(50, 600.0, 0.0, 600.0, 100.0, 2.0), (51, 610.0, 0.0, 610.0, 100.0, 2.0)]
    pts = [(k, r.uniform(0, 400), r.uniform(0, 400), r.choice([4.0, 12.0])) for k in range(80)] + [(500, 605.0, 50.0, 60.0), (501, 600.0, 50.0, 3.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double, need double")
    got = displacement.make_room(df, spark.createDataFrame(walls, "part long, ax double, ay double, bx double, by double, half double"), Workspace(spark, "t"), 40.0).collect()
    assert len(got) == len(pts)
    lack = lambda p, x, y: max(p.need + h - far(x, y, a, b, c, d) for _, a, b, c, d, h in walls)
    for p in got:
        assert p.moved <= 40 + 1e-6 and abs(max(0.0, lack(p, p.mx, p.my)) - p.short) < 1e-6
        assert p.short <= max(0.0, lack(p, p.x, p.y)) + 1e-9
        assert p.moved == 0 or lack(p, p.x, p.y) > 0
    of = {p.id: p for p in got}
    assert of[501].short == 0 and of[500].short > 0
    crowded = [p for p in got if lack(p, p.x, p.y) > 0]
    assert sum(p.short == 0 for p in crowded) > 0.7 * len(crowded)


def test_carriageways_become_one_line(spark):
    p = lambda *v: [{"x": float(x), "y": float(y)} for x, y in v]
    rows = [(1, 7, p((0, 0), (100, 10), (200, 0))), (2, 7, p((200, 20), (100, 30), (0, 20))), (3, 7, p((100, -100), (100, 130))), (4, 0, p((0, 30), (200, 30))), (5, 8, p((0, 40), (200, 40))), (6, None, p((0, 5), (200, 5))), (7, 7, p((0, 60), (200, 60))), (8, 9, p((0, 500), (300, 500))), (9, 9, p((250, 510), (900, 510)))]
    df = spark.createDataFrame(rows, "line_id long, merge_id long, line array<struct<x:double,y:double>>")
    got = {x.line_id: x for x in parallels.merge_divided(df, Workspace(spark, "t"), 45).collect()}
    assert set(got) == {1, 3, 4, 5, 6, 7, 8, 9} and [k for k, x in got.items() if x.merged] == [1]
    assert [(round(v.x, 6), round(v.y, 6)) for v in got[1].line] == [(0, 10), (100, 20), (200, 10)]
