"""Spacing along lines, rings of roads, raster tiles."""

import random

from pyspark.sql import functions as F

from geoquill.operators import roundabouts, spacing
from geoquill.sources import rasters
from geoquill.workspace import Workspace


def scan(points, least, large):
    gone, current = set(), None
    for p in sorted(points, key=lambda p: (p[2], p[0])):
        big = p[3] >= large
        if current is None or (big and current[3] >= large):
            current = p
        elif big:
            gone.add(current[0])
            current = p
        elif p[2] - current[2] < least:
            gone.add(p[0])
        else:
            current = p
    return {p[0] for p in points} - gone


def test_spacing_equals_the_scan(spark):
    r = random.Random(7)
    rows = [(k, k % 9, r.randrange(400), r.choice([1, 2, 3, 3, 5])) for k in range(500)] + [(1000 + k, 50, k, 1) for k in range(300)] + [(2000, 60, 5, 1), (2001, None, 5, 1), (2002, 61, None, 9)]
    got = {x.id for x in spacing.spaced(spark.createDataFrame(rows, "id long, line long, dist long, size int"), Workspace(spark, "t"), 20, 5).collect()}
    want = set().union(*(scan([p for p in rows if p[1] == line], 20, 5) for line in {p[1] for p in rows if p[1] is not None and p[2] is not None and p[1] != 61}))
    assert got == want


def test_longest_ladder_of_each_line(spark):
    rows = [(1, "a", 1), (2, "a", 2), (1, "b", 3), (1, "c", 4), (3, "c", 5), (3, "d", 6), (3, "d", 7)]
    got = {tuple(x) for x in spacing.longest_ladders(spark.createDataFrame(rows, "line long, ladder string, id long")).collect()}
    assert got == {(1, "a"), (2, "a"), (3, "c")}


def test_rings_become_points(spark):
    p = lambda *v: [{"x": float(x), "y": float(y)} for x, y in v]
    ring = lambda base, number, media, x: [(base + k, base + k, base + (k + 1) % 4, p((x, 0), (x + 1, 1)), "roundabout", number, media[k % len(media)]) for k in range(4)]
    square = [(1, 1, 2, p((0, 0), (2, 0)), "roundabout", 7, "T"), (2, 2, 3, p((2, 0), (2, 2)), "roundabout", 7, "T"), (3, 3, 4, p((2, 2), (0, 2)), "roundabout", 7, "T"), (4, 4, 1, p((0, 2), (0, 0)), "roundabout", 7, "T")]
    roads = [(10, 1, 90, p((0, 0), (-3, -1), (-9, 0)), "road", 1, "T"), (11, 91, 3, p((9, 9), (2, 2)), "road", 1, "U"), (12, 2, 4, p((2, 0), (0, 2)), "road", 1, "T"), (13, 90, 91, p((0, 9), (9, 9)), "road", 1, "T"), (14, 102, 90, p((5, 5), (0, 9)), "road", 1, "T"), (15, 103, 90, p((5, 6), (0, 9)), "road", 1, "U"), (16, 203, 90, p((5, 5), (0, 9)), "road", 1, "T")]
    open_ = [(300, 300, 301, p((0, 0), (1, 1)), "roundabout", 7, "T"), (301, 301, 302, p((1, 1), (2, 2)), "roundabout", 7, "T"), (302, 3, 400, p((2, 2), (8, 8)), "roundabout", 8, "T")]
    rows = square + roads + ring(100, 5, "U", 50) + ring(200, 5, "UT", 70) + open_
    df = spark.createDataFrame(rows, "line_id long, src long, dst long, line array<struct<x:double,y:double>>, kind string, number int, medium string")
    got = {x.line_id: x for x in roundabouts.collapse(df, Workspace(spark, "t")).collect()}
    at = lambda k: [(v.x, v.y) for v in got[k].line]
    assert not set(got) & {1, 2, 3, 4, 12, 100, 101, 102, 103} and {200, 201, 202, 203, 300, 301, 302, 13} <= set(got)
    assert at(10) == [(1, 1), (-3, -1), (-9, 0)] and got[10].src == 1 and at(11) == [(9, 9), (1, 1)] and got[11].dst == 1
    assert got[14].src == 102 and at(14)[0] == (5, 5)  # a road above a ring of tunnels
    assert got[15].src == 100 and at(15)[0] == (50.5, 0.5) and got[16].src == 203
    assert at(302) == [(1, 1), (8, 8)]  # of another number: a road like others


def test_tiles_are_found_by_place_and_read_in_windows(spark, tmp_path):
    c = spark.range(-20, 40).withColumnRenamed("id", "col").crossJoin(spark.range(-10, 30).withColumnRenamed("id", "row")).withColumn("z", (F.col("col") * 3 + F.col("row") * 5).cast("double")).where("not (col = 3 and row = 3)")
    path = f"file://{tmp_path}/tiles"
    rasters.write_tiles(c, path, 16, 2.0)
    assert rasters.tiles(spark, path).count() == 5 * 3
    box = (-5.0, 20.0, 40.0, 31.0)
    found = rasters.tiles(spark, path, box, 16, 2.0)
    assert sorted((x.tx, x.ty) for x in found.collect()) == [(-1, 0), (0, 0), (1, 0)]
    grid = rasters.cells(found, box)
    got = {(x.x, x.y): x.z for x in grid.collect()}
    assert got == {(2.0 * i, 2.0 * j): 3.0 * i + 5 * j for i in range(-20, 40) for j in range(-10, 30) if 2 * i <= 40 and 2 * i + 2 >= -5 and 2 * j <= 31 and 2 * j + 2 >= 20}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "tx#" in plan.split("PartitionFilters: [")[1]
    pts = spark.createDataFrame([(1, 31.9, 13.0), (2, 0.2, 0.4), (3, 7.5, 7.0), (4, 500.0, 0.0)], "id long, x double, y double")
    z = {x.id: x.z for x in rasters.bilinear(pts, rasters.cells(rasters.tiles(spark, path)), 2.0).collect()}
    plane = lambda x, y: 3 * (x / 2 - 0.5) + 5 * (y / 2 - 0.5)
    assert abs(z[1] - plane(31.9, 13.0)) < 1e-9 and abs(z[2] - plane(0.2, 0.4)) < 1e-9 and z[3] is None and z[4] is None
