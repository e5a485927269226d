"""Short cycles and thinning by class against plain searches."""

import random

import pytest

from geoquill.operators import thinning
from geoquill.workspace import Workspace

SCHEMA = "line_id long, src long, dst long, class long, length_cm long"


def losers(lines, size, longest):
    """Every simple cycle by depth-first walks; of parallel lines the lowest in cycles of three and four."""
    use = lines
    if size > 2:
        best = {}
        for x in lines:
            k = (min(x[1], x[2]), max(x[1], x[2]))
            if x[1] != x[2] and (k not in best or (x[3], x[0]) < (best[k][3], best[k][0])):
                best[k] = x
        use = list(best.values())
    out = set()

    def walk(start, at, path, nodes):
        for x in use:
            if x in path or at not in (x[1], x[2]) or (x[1] == x[2]) != (size == 1):
                continue
            to = x[2] if x[1] == at else x[1]
            if len(path) + 1 == size:
                if to == start and sum(y[4] for y in [*path, x]) <= longest:
                    out.add(max([*path, x], key=lambda y: (y[3], y[0]))[0])
            elif to not in nodes:
                walk(start, to, [*path, x], nodes | {to})

    for n in {v for x in lines for v in x[1:3]}:
        walk(n, n, [], {n})
    return out


def broken(lines, longest):
    for size in (1, 2, 3, 4):
        while gone := losers(lines, size, longest):
            lines = [x for x in lines if x[0] not in gone]
    return lines


def thin(lines, keep, longest, least):
    lines = broken(lines, longest)
    while True:
        at = [v for x in lines for v in x[1:3]]
        gone = {x[0] for x in lines if x[3] > keep and x[4] < least and any(at.count(v) == 1 for v in x[1:3])}
        if not gone:
            return lines
        lines = [x for x in lines if x[0] not in gone]


def parts(lines):
    of = {v: v for x in lines for v in x[1:3]}
    for _ in of:
        for x in lines:
            of[x[1]] = of[x[2]] = min(of[x[1]], of[x[2]])
    return of


def random_lines(seed):
    r = random.Random(seed)
    return [(k, r.randrange(9), r.randrange(9), r.randrange(3), r.randrange(1, 9)) for k in range(22)]


@pytest.mark.parametrize("seed", range(3))
def test_cycles_of_each_size(spark, seed):
    lines = random_lines(seed)
    d = spark.createDataFrame(lines, SCHEMA)
    for size in (1, 2, 3, 4):
        for longest in (12, 1000):
            got = [x.line_id for x in thinning.cycle_losers(d, size, "class", longest).collect()]
            assert len(got) == len(set(got)) and set(got) == losers(lines, size, longest), (size, longest)


def test_sequence_and_thinning(spark):
    lines = random_lines(7)
    d = spark.createDataFrame(lines, SCHEMA)
    got = [tuple(x) for x in thinning.without_cycles(d, Workspace(spark, "t"), "class", 18).collect()]
    assert sorted(got) == broken(lines, 18) and len(got) < len(lines)
    assert {v: c for v, c in parts(lines).items() if v in parts(got)} == parts(got)
    got = [tuple(x) for x in thinning.thinned(d, Workspace(spark, "t"), "class", 0, 18, 6).collect()]
    assert sorted(got) == thin(lines, 0, 18, 6)


def test_nulls_and_no_rows(spark):
    d = spark.createDataFrame([(1, None, 2, 1, 1), (2, 2, None, 1, 1), (3, 2, 2, None, 1), (4, 2, 2, 1, None)], SCHEMA)
    for size in (1, 2, 3, 4):
        assert thinning.cycle_losers(d, size, "class", 10).count() == 0
    assert thinning.without_cycles(d.limit(0), Workspace(spark, "t"), "class", 10).count() == 0
