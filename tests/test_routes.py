"""Routes, trees of terminals and rivers against brute force."""

import heapq
import random
from itertools import combinations

import pytest

from geoquill.operators import routes
from geoquill.workspace import Workspace

LINE = "line_id long, src long, dst long, w long"


def network(seed, nodes=40, edges=60, most=9):
    r = random.Random(seed)
    return [(k, r.randrange(nodes), r.randrange(nodes), r.randrange(0 if seed % 2 else 1, most)) for k in range(edges)]


def dijkstra(rows, start, combine):
    at, heap = {}, [(d, n) for n, d in start.items()]
    near = {}
    for k, a, b, w in rows:
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    heapq.heapify(heap)
    while heap:
        d, n = heapq.heappop(heap)
        if n in at:
            continue
        at[n] = d
        for m, w in near.get(n, ()):
            heapq.heappush(heap, (combine(d, w), m))
    return at


@pytest.mark.parametrize("seed, band, by", [(1, None, "sum"), (2, 2.0, "sum"), (3, 1000.0, "max")])
def test_routes_equal_dijkstra(spark, seed, band, by):
    rows = network(seed)
    df = spark.createDataFrame(rows, LINE)
    start = {0: 0, 7: 3, 99: 0}
    got = routes.routes(df, spark.createDataFrame(list(start.items()), "node long, dist long"), Workspace(spark, "t"), "w", band, by).collect()
    want = dijkstra(rows, start, (lambda d, w: d + w) if by == "sum" else max)
    assert {x.node: x.dist for x in got} == want
    of, line = {x.node: x for x in got}, {k: {a, b, w} for k, a, b, w in rows}
    for x in got:
        if x.parent is not None:
            p = of[x.parent]
            w = next(w for k, a, b, w in rows if k == x.via)
            assert {x.node, x.parent} <= line[x.via] and x.source == p.source
            assert (x.dist, x.hops) == (p.dist + w, p.hops + 1) if by == "sum" else (x.dist == max(p.dist, w) and (p.dist, p.hops) < (x.dist, x.hops))


def test_routes_stop_at_the_limit_and_need_no_source(spark):
    df = spark.createDataFrame([(k, k, k + 1, 2) for k in range(20)], LINE)
    one = spark.createDataFrame([(0,)], "node long")
    assert routes.routes(df, one, Workspace(spark, "t"), "w", limit=9).count() == 5
    assert routes.routes(df, one.limit(0), Workspace(spark, "t"), "w").count() == 0


def test_places_on_lines(spark):
    rows = [(1, 10, 11, 8), (2, 11, 12, 5), (3, 10, 12, 20), (4, 50, 51, 9)]
    pairs = [(1, 1, 2, 2, 1), (2, 1, 6, 1, 1), (3, 3, 1, 3, 19), (4, 1, 0, 4, 0), (5, 3, 9, 2, 5)]
    got = {x.pair: x.dist for x in routes.place_distances(spark.createDataFrame(rows, LINE), spark.createDataFrame(pairs, "pair long, line_a long, at_a long, line_b long, at_b long"), Workspace(spark, "t"), "w").collect()}
    assert got == {1: 7, 2: 5, 3: 15, 4: None, 5: 11}


@pytest.mark.parametrize("seed", [2, 4])
def test_terminal_tree_weighs_as_the_metric_closure(spark, seed):
    rows = [r for r in network(seed, 30, 50) if r[1] != r[2]]
    terminals = random.Random(seed).sample(range(30), 7)
    got = {x.line_id for x in routes.terminal_tree(spark.createDataFrame(rows, LINE), spark.createDataFrame([(t,) for t in terminals], "node long"), Workspace(spark, "t"), "w").collect()}
    dist = {t: dijkstra(rows, {t: 0}, lambda d, w: d + w) for t in terminals}
    parent = {t: t for t in terminals}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    total = 0
    for d, a, b in sorted((dist[a][b], a, b) for a, b in combinations(terminals, 2) if b in dist[a]):
        if root(a) != root(b):
            parent[root(a)] = root(b)
            total += d
    own = [r for r in rows if r[0] in got]
    assert sum(r[3] for r in own) <= total  # the ways of the closure may share lines
    for a, b in combinations(terminals, 2):
        assert (b in dijkstra(own, {a: 0}, max)) == (b in dist[a])
    nodes = {n for r in own for n in r[1:3]}
    parts = len({min(dijkstra(own, {n: 0}, max)) for n in nodes})
    assert len(own) == len(nodes) - parts  # a forest
    ends = [n for r in own for n in r[1:3]]
    assert all(ends.count(n) > 1 or n in terminals for n in nodes)  # that ends at terminals


def reaches(rows):
    out = {}
    for _, a, b in rows:
        out.setdefault(a, set()).add(b)
    seen = {}
    for n in {n for r in rows for n in r[1:]}:
        todo, at = [n], set()
        while todo:
            for m in out.get(todo.pop(), ()):
                if m not in at:
                    at.add(m)
                    todo.append(m)
        seen[n] = at
    return seen


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_in_directed_cycles(spark, seed):
    r = random.Random(seed)
    rows = [(k, r.randrange(30), r.randrange(30)) for k in range(45)]
    got = {x.line_id for x in routes.cyclic_lines(spark.createDataFrame(rows, "line_id long, src long, dst long"), Workspace(spark, "t")).collect()}
    down = reaches(rows)
    assert got == {k for k, a, b in rows if a in down[b] or a == b} and got


@pytest.mark.parametrize("seed, least", [(1, 0), (3, 3)])
def test_all_water_reaches_a_sink(spark, seed, least):
    r = random.Random(seed)
    rows = [(k, r.randrange(35), r.randrange(35)) for k in range(55)]
    z = {n: r.randrange(12) if r.random() < 0.9 else None for n in range(35)}
    sinks = [0, 5]
    got = routes.drained(spark.createDataFrame(rows, "line_id long, src long, dst long"), spark.createDataFrame(list(z.items()), "node long, z int"), spark.createDataFrame([(s,) for s in sinks], "node long"), Workspace(spark, "t"), least).collect()
    way = [(x.line_id, x.src, x.dst) for x in got]
    down = reaches(way)
    assert all(n not in d for n, d in down.items())  # no cycle
    there = dijkstra([(*x, 0) for x in rows], {s: 0 for s in sinks}, max)
    assert {k for k, *_ in way} == {k for k, a, b in rows if a != b and a in there}
    if not least:
        assert all(n in sinks or d & set(sinks) for n, d in down.items())
    for x in got:
        if x.certain:
            assert z[x.src] - z[x.dst] >= least


def brute_strahler(rows):
    """By sets of all nodes above, in topological order."""
    into, nodes = {}, {n for r in rows for n in r[1:]}
    for k, a, b in rows:
        into.setdefault(b, []).append((k, a))
    above, order, todo = {}, {}, sorted(nodes)
    while todo:
        for n in todo:
            if all(a in above for _, a in into.get(n, ())):
                break
        todo.remove(n)
        own = into.get(n, [])
        above[n] = {x for _, a in own for x in (*above[a], a)}
        m = max((order[k] for k, _ in own), default=1)
        if sum(order[k] == m for k, _ in own) > 1 and not any(above[a] & above[b] for (_, a), (_, b) in combinations(own, 2)):
            m += 1
        order |= {k: m for k, a, _ in rows if a == n}
    return order


@pytest.mark.parametrize("seed", [2, 4])
def test_strahler_with_the_guard(spark, seed):
    r = random.Random(seed)
    rows = [(k, *sorted(r.sample(range(40), 2))) for k in range(38 + 6 * seed)]
    got = {x.line_id: x.strahler for x in routes.guarded_strahler(spark.createDataFrame(rows, "line_id long, src long, dst long"), Workspace(spark, "t")).collect()}
    assert got == brute_strahler(rows)


def test_a_braid_does_not_raise_the_order(spark):
    braid = [(0, 0, 1), (1, 1, 2), (2, 1, 3), (3, 2, 4), (4, 3, 4), (5, 4, 5)]
    run = lambda rows: {x.line_id: x.strahler for x in routes.guarded_strahler(spark.createDataFrame(rows, "line_id long, src long, dst long"), Workspace(spark, "t")).collect()}
    assert set(run(braid).values()) == {1}
    assert run([(1, 1, 3), (2, 2, 3), (3, 3, 4)])[3] == 2
    assert run([(1, 1, 2), (2, 2, 1), (3, 2, 5)]) == {1: 1, 2: 1, 3: 1}


def test_lines_are_turned_towards_sinks(spark):
    rows = [(1, 5, 3), (2, 3, 9), (3, 9, 5), (4, 7, 5), (5, 5, 7), (6, 20, 21)]
    got = routes.toward_sinks(spark.createDataFrame(rows, "line_id long, src long, dst long"), spark.createDataFrame([(3,)], "node long"), Workspace(spark, "t")).collect()
    assert sorted(tuple(x) for x in got) == [(1, 5, 3), (2, 9, 3), (4, 7, 5)]
