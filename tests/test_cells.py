"""Connected cells over tiles, against floods, and what is written for them."""

import random
from collections import Counter

from geoquill.operators import cells as tiles
from geoquill.workspace import Workspace

SCHEMA = "id long, col long, row long, category string"
BESIDE = ((0, 1), (1, 0), (0, -1), (-1, 0))


def flooded(rows):
    at = {}
    for i, x, y, k in rows:
        at.setdefault((x, y, k), []).append(i)
    kind, out = {i: (x, y, k) for i, x, y, k in rows}, {}
    for i in sorted(kind):
        if i in out:
            continue
        todo = [i]
        out[i] = i
        while todo:
            x, y, k = kind[todo.pop()]
            for u, v in BESIDE:
                for o in at.get((x + u, y + v, k), ()) if k is not None else ():
                    if o not in out:
                        out[o] = i
                        todo.append(o)
    return out


def test_parts_over_seams_and_copies(spark, monkeypatch):
    """Tiles of three cells, negative places, missing kinds, several cells of one place, and a place far away."""
    monkeypatch.setattr(tiles, "TILE", 3)
    monkeypatch.setattr(tiles, "TASK", 20)
    r = random.Random(7)
    rows = [(i, r.randrange(-8, 9), r.randrange(-8, 9), r.choice(["a", "a", "b", "c", None])) for i in range(340)]
    rows += [(900, 2**40, -(2**41), "a"), (901, 2**40 + 1, -(2**41), "a")]
    r.shuffle(rows)
    ws, want = Workspace(spark, "t"), flooded(rows)
    df = spark.createDataFrame([*rows, (950, None, 3, "a"), (951, 4, None, "b")], SCHEMA)
    got = {x.id: x.part for x in tiles.connected_cells(df, ws, "category").collect()}
    assert got == {**want, 950: 950, 951: 951}
    at = {}
    for i, x, y, _ in rows:
        at.setdefault((x, y), []).append(i)
    sides = Counter((want[i], want[o]) for i, x, y, _ in rows for u, v in BESIDE for o in at.get((x + u, y + v), ()))
    whole = spark.createDataFrame([(i, x, y, want[i]) for i, x, y, _ in rows], "id long, col long, row long, part long")
    assert {(x.part, x.other): x.len for x in tiles.shared_sides(whole).collect()} == sides
    assert tiles.connected_cells(df.limit(0), ws, "category").isEmpty() and tiles.shared_sides(whole.limit(0)).isEmpty()


def test_only_seams_are_joined(spark, monkeypatch):
    """40,000 cells of one kind: links between cells don't reach the components, only those between tiles."""
    asked = []
    whole = tiles.connected_components
    monkeypatch.setattr(tiles, "connected_components", lambda links, *a: asked.append(links.count()) or whole(links, *a))
    df = spark.range(40_000).selectExpr("id", "id % 40 as col", "id div 40 as row", "'a' as category")
    assert tiles.connected_cells(df, Workspace(spark, "t"), "category").select("part").distinct().count() == 1
    assert asked[0] <= 2 * 4


def test_forest_over_ranges(spark, monkeypatch):
    """Ranges of about 30 lines, on a lattice with chains over all ranges, against Kruskal; few rounds, and what is left after the first is small."""
    from geoquill.operators import network

    r = random.Random(11)
    rows = [(i, a, a + r.choice([1, 7, 8]), r.choice([1, 2, 2, 3, None])) for i, a in enumerate(r.choices(range(200), k=500))]
    rows += [(500 + i, r.randrange(210), r.randrange(210), r.randrange(4)) for i in range(40)] + [(600, 1, None, 1), (601, 5, 5, 0)]
    parent, want = {}, set()

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, s, d, _ in sorted(rows, key=lambda x: (-1 if x[3] is None else x[3], x[0])):
        if d is not None and root(s) != root(d):
            parent[root(s)] = root(d)
            want.add(i)
    df = spark.createDataFrame(rows, "line_id long, src long, dst long, length_cm long")
    counts = []
    ws = Workspace(spark, "t")
    put = ws.put
    monkeypatch.setattr(ws, "put", lambda d, name="t": (counts.append((x := put(d, name)).count()), x)[1] if name == "edges" else put(d, name))
    monkeypatch.setattr(network, "FOREST_LINES", 30)
    got = [x.line_id for x in network.spanning_forest(df, ws, limit=8).collect()]
    assert sorted(got) == sorted(want)
    monkeypatch.setattr(network, "FOREST_LINES", 10**6)
    assert {x.line_id for x in network.spanning_forest(df, ws, limit=2).collect()} == want
