"""Land use on cells against passes in plain Python."""

import random
from collections import Counter

from geoquill.operators import landuse
from geoquill.workspace import Workspace


def parts(cells):
    """id of the part of each place, by flooding."""
    out = {}
    for at in sorted(cells, key=lambda p: cells[p][0]):
        if at in out:
            continue
        todo = [at]
        out[at] = cells[at][0]
        while todo:
            x, y = todo.pop()
            for o in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if o in cells and o not in out and cells[o][1] == cells[at][1]:
                    out[o] = cells[at][0]
                    todo.append(o)
    return out


def recolour(cells, losing):
    """losing(part cells, {other part or None: border}) tells which parts go."""
    of = parts(cells)
    border, kind, size = {}, {}, Counter(of.values())
    for (x, y), p in of.items():
        kind[p] = cells[x, y][1]
        for o in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
            if of.get(o) != p:
                border.setdefault(p, Counter())[of.get(o)] += 1
    gone = {p for p in size if losing(kind[p], size[p], border.get(p, {}))}
    new = {}
    for p in gone:
        best = [(n, -o, kind[o]) for o, n in border[p].items() if o is not None and o not in gone and kind[o] is not None]
        if best:
            new[p] = max(best)[2]
    return {at: (k, new.get(of[at], c)) for at, (k, c) in cells.items()}


def frame(spark, cells):
    return spark.createDataFrame([(k, x, y, c) for (x, y), (k, c) in cells.items()], "id long, col long, row long, category string")


def test_passes_by_category_holes_and_missing(spark):
    r = random.Random(2)
    cells = {(x, y): (y * 30 + x, r.choice(["a", "a", "a", "b", "c", None])) for x in range(30) for y in range(12) if r.random() < 0.96}
    for x in range(10, 15):
        for y in range(3, 8):
            cells[x, y] = (y * 30 + x, "c" if (x, y) == (12, 5) else "a")
    ws = Workspace(spark, "t")
    got = lambda d: {x.id: x.category for x in d.collect()}
    want = cells
    for kind, n in {"b": 3, "c": 2, "a": 4}.items():
        want = recolour(want, lambda k, size, b, kind=kind, n=n: k == kind and size < n)
    assert got(landuse.eliminate_by_category(frame(spark, cells), {"b": 3, "c": 2, "a": 4}, ws)) == dict(want.values())
    want = recolour(cells, lambda k, size, b: size <= 3 and len(b) == 1 and None not in b)
    assert got(landuse.fill_holes(frame(spark, cells), 3, ws)) == dict(want.values()) and want != cells
    want = recolour(cells, lambda k, size, b: k is None)
    assert got(landuse.fill_missing(frame(spark, cells), ws)) == dict(want.values()) and want != cells


def test_attributes_of_most_cells_come_back(spark):
    cells = {(x, 0): (x, "a" if x < 5 else "b") for x in range(8)}
    whole = landuse.parts(frame(spark, cells), Workspace(spark, "t"))
    own = spark.createDataFrame([(0, "p", 1), (1, "q", 1), (2, "q", 1), (3, "q", 2), (4, "p", 1), (5, "z", None), (6, "y", 3), (7, None, 9)], "id long, main string, sub int")
    assert {(x.part, x.main, x.sub) for x in landuse.restored(whole, own, ["main", "sub"]).collect()} == {(0, "p", 1), (5, "z", None)}
