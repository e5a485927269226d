"""Network operators on lines (line_id, src, dst)."""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoquill.operators.graph import connected_components, rounds
from geoquill.workspace import Workspace


#: Lines that one task of strahler takes.
STRAHLER_LINES = 200_000
#: Lines that one task of spanning_forest takes, about.
FOREST_LINES = 500_000


def ends(lines: DataFrame) -> DataFrame:
    """(node, line_id), one row for each end."""
    return lines.select(F.explode(F.array("src", "dst")).alias("node"), "line_id")


def degrees(lines: DataFrame) -> DataFrame:
    return ends(lines).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def dangles(lines: DataFrame) -> DataFrame:
    """(node, line_id) of ends that no other line has."""
    return ends(lines).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("line_id")).where("n = 1").select("node", "line_id")


def line_components(lines: DataFrame, ws: Workspace) -> DataFrame:
    """(line_id, component): component is the smallest node of the connected part."""
    of = connected_components(lines.select("src", "dst"), ws)
    return lines.select("line_id", "src").join(of.select(F.col("id").alias("src"), "component"), "src", "left").select("line_id", F.coalesce("component", "src").alias("component"))


def isolated_lines(lines: DataFrame, ws: Workspace, max_lines: int, base: int, add: int, length: str = "length_cm") -> DataFrame:
    """Lines without those of components of at most max_lines lines that are shorter than base + add * lines."""
    of = lines.join(line_components(lines, ws), "line_id")
    w = of.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("total")).where((F.col("n") <= max_lines) & (F.col("total") < base + add * F.col("n")))
    return of.join(w.select("component"), "component", "left_anti").select(*lines.columns)


def self_loops(lines: DataFrame) -> DataFrame:
    return lines.where("src = dst").select("line_id")


def _pairs(lines: DataFrame) -> DataFrame:
    return lines.where("src <> dst").select("line_id", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))


def parallel_lines(lines: DataFrame) -> DataFrame:
    """Lines whose ends another line joins too."""
    p = _pairs(lines)
    return p.join(p.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b"), ["a", "b"], "left_semi").select("line_id")


def _both(lines: DataFrame) -> DataFrame:
    e = _pairs(lines).select("a", "b").distinct()
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def triangle_lines(lines: DataFrame) -> DataFrame:
    """Lines of simple cycles of three nodes: neighbours of both ends, by equi-joins."""
    p = _pairs(lines)
    n = _both(lines)
    x = p.join(n.select("a", F.col("b").alias("c")), "a").join(n.select(F.col("a").alias("b"), F.col("b").alias("c")), ["b", "c"])
    return x.select("line_id").distinct()


def quad_lines(lines: DataFrame) -> DataFrame:
    """Lines a-b of simple cycles a-b-c-d of four nodes."""
    p, n = _pairs(lines), _both(lines)
    bc = n.select(F.col("a").alias("b"), F.col("b").alias("c"))
    ad = n.select("a", F.col("b").alias("d"))
    cd = n.select(F.col("a").alias("c"), F.col("b").alias("d"))
    x = p.join(bc, "b").where("c <> a").join(ad, "a").where("d <> b and d <> c").join(cd, ["c", "d"])
    return x.select("line_id").distinct()


def paths(lines: DataFrame, starts: DataFrame, max_steps: int, previous_rule: bool = False) -> DataFrame:
    """(start, node, steps, path) of all simple paths of up to max_steps edges from the starts (node).

    With previous_rule a step may not lead to a neighbour of the node before.
    """
    n = _both(lines)
    at = starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("steps"), F.array("node").alias("path"))
    out = at
    for _ in range(max_steps):
        step = at.join(n.select(F.col("a").alias("node"), F.col("b").alias("next")), "node").where(~F.array_contains("path", F.col("next")))
        if previous_rule:
            step = step.withColumn("before", F.when(F.size("path") > 1, F.element_at("path", -2)))
            step = step.join(n.select(F.col("a").alias("before"), F.col("b").alias("next")), ["before", "next"], "left_anti")
        at = step.select("start", F.col("next").alias("node"), F.col("steps") + 1, F.concat("path", F.array("next")).alias("path")).toDF("start", "node", "steps", "path")
        out = out.unionByName(at)
    return out


def bfs(lines: DataFrame, starts: DataFrame, ws: Workspace, limit: int | None = None) -> DataFrame:
    """(node, level, parent): steps from the nearest start, and the smallest node one step nearer; limit: levels wanted, by default all."""
    n = ws.put(_both(lines), "edges")
    out = ws.put(starts.select("node", F.lit(0).alias("level"), F.lit(None).cast("bigint").alias("parent")).distinct(), "bfs")
    front = out
    for level in count(1) if limit is None else range(1, limit + 1):
        new = front.select(F.col("node").alias("a")).join(n, "a").groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        new = ws.put(new.join(out.select("node"), "node", "left_anti").select("node", F.lit(level).alias("level"), "parent"), "front")
        if new.isEmpty():
            break
        out, front = out.unionByName(new), new
    return out


def strahler(lines: DataFrame, ws: Workspace, limit: int | None = None) -> DataFrame:
    """(line_id, strahler) of directed lines src -> dst: 1 at sources; one more than the greatest inflow where two have it.

    Lines that never are settled (in or below cycles) have 1. Nodes are dealt to ranges of their ids. A round gives each range's task the lines that
    end there and what is known of their sources; it goes on by itself as far as it can, so rounds are as many as the longest path changes ranges.
    """
    e = ws.put(lines.select("line_id", "src", "dst"), "lines")
    usable = e.where("src is not null and dst is not null")
    count_of = usable.count()
    parts = max(1, -(-count_of // STRAHLER_LINES))
    cuts = sorted({c for c in usable.approxQuantile("dst", [i / parts for i in range(1, parts)], 0.001)}) if parts > 1 else []
    part = F.lit(0)
    for i, c in enumerate(cuts, 1):
        part = F.when(F.col("dst") > c, i).otherwise(part)
    known = ws.put(usable.select(F.col("src").alias("node")).distinct().join(usable.select(F.col("dst").alias("node")).distinct(), "node", "left_anti").select("node", F.lit(1).alias("order")), "orders")
    left = ws.put(usable.select("src", "dst", part.cast("int").alias("part"), F.lit(None).cast("int").alias("order")), "inflows")
    schema = "src long, dst long, part int, order int, settled int"
    new = known
    for _ in rounds(limit):
        told = left.join(new.select(F.col("node").alias("src"), F.col("order").alias("o")), "src", "left").select("src", "dst", "part", F.coalesce("order", "o").alias("order"))
        # parts that hear nothing have nothing to do; all rows of a node's inflow share a part
        out = ws.put(told.groupBy("part").applyInArrow(_settle, schema), "inflows")
        new = ws.put(out.where("settled is not null").groupBy(F.col("dst").alias("node")).agg(F.first("settled").alias("order")), "orders")
        if new.isEmpty():
            break
        known, left = known.unionByName(new), out.where("settled is null").drop("settled")
    done = e.join(known.select(F.col("node").alias("src"), "order"), "src", "left")
    return done.select("line_id", F.coalesce("order", F.lit(1)).alias("strahler"))


def _settle(rows: pa.Table) -> pa.Table:
    """Inflows (src, dst, part, order of src) of a range with what follows inside it: order of further sources, and settled, the order of dst."""
    src, dst, order = (rows.column(c).to_pylist() for c in ("src", "dst", "order"))
    need: dict[int, int] = {}
    out: dict[int, list[int]] = {}
    for i, (s, d) in enumerate(zip(src, dst, strict=True)):
        need[d] = need.get(d, 0) + 1
        out.setdefault(s, []).append(i)
    best: dict[int, tuple[int, int]] = {}
    settled: dict[int, int] = {}
    todo = [i for i, o in enumerate(order) if o is not None]
    while todo:
        i = todo.pop()
        d, o = dst[i], order[i]
        m, n = best.get(d, (0, 0))
        best[d] = (o, 1) if o > m else (m, n + (o == m))
        need[d] -= 1
        if not need[d]:
            m, n = best[d]
            settled[d] = m + (n > 1)
            for k in out.get(d, ()):
                order[k] = settled[d]
                todo.append(k)
    return rows.set_column(rows.schema.get_field_index("order"), "order", pa.array(order, pa.int32())).append_column("settled", pa.array([settled.get(d) for d in dst], pa.int32()))


def chains(lines: DataFrame, ws: Workspace) -> DataFrame:
    """(line_id, chain): lines joined through nodes that exactly two lines meet; chain is the smallest line_id."""
    two = ends(lines).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("src"), F.max("line_id").alias("dst")).where("n = 2 and src <> dst")
    of = connected_components(two.select("src", "dst"), ws)
    return lines.select("line_id").join(of.withColumnRenamed("id", "line_id"), "line_id", "left").select("line_id", F.coalesce("component", "line_id").alias("chain"))


def spanning_forest(lines: DataFrame, ws: Workspace, weight: str = "length_cm", limit: int | None = None) -> DataFrame:
    """line_id of the least spanning forest; ties by line_id.

    Nodes are dealt to ranges of their ids, and a range's task has every line that ends in it. It goes through them by weight: where all nodes of a
    part lie in the range, its lightest line out belongs to the forest, and a line inside a part never does. What is left lies between parts of several
    ranges; those parts are the nodes of the next round.
    """
    e = lines.where("src <> dst").select("line_id", F.col("src").cast("bigint").alias("a"), F.col("dst").cast("bigint").alias("b"), F.col(weight).alias("w"))
    cur, taken = ws.put(e, "edges"), None
    kind = {f.name: f.dataType.simpleString() for f in cur.schema}
    schema = f"line_id {kind['line_id']}, a long, b long, w {kind['w']}, two boolean, status int"
    for _ in rounds(limit):
        n = cur.count()
        if not n:
            break
        parts = -(-n // FOREST_LINES)
        cuts = sorted({int(c) for c in cur.approxQuantile("a", [i / parts for i in range(1, parts)], 0.001)}) if parts > 1 else []
        owner = lambda c: F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < F.col(c))) if cuts else F.lit(0)
        dealt = cur.withColumns({"pa": owner("a"), "pb": owner("b")}).withColumn("part", F.explode(F.array_distinct(F.array("pa", "pb"))))
        out = ws.put(dealt.groupBy("part").applyInArrow(_grow, schema), "grown")
        got = out.where("status = 1").select("line_id")
        taken = got if taken is None else taken.unionByName(got)
        # lines of two tasks are open where neither has settled them
        both = out.where("two and status < 3").groupBy("line_id").agg(F.max("status").alias("status"), F.min(F.struct("a", "b", "w")).alias("e")).where("status = 0").select("line_id", "e.*")
        left = out.where("status = 0 and not two").select("line_id", "a", "b", "w").unionByName(both)
        of = connected_components(out.where("status = 3").select("a", "b"), ws, "a", "b")
        for c in ("a", "b"):
            left = left.join(of.select(F.col("id").alias(c), F.col("component").alias("of")), c, "left").withColumn(c, F.coalesce("of", c)).drop("of")
        # of several lines between two parts only the lightest can be wanted
        left = left.where("a <> b").groupBy(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q")).agg(F.min(F.struct("w", "line_id")).alias("k"))
        new = ws.put(left.select("k.line_id", F.col("p").alias("a"), F.col("q").alias("b"), "k.w"), "edges")
        ws.drop(cur)
        cur = new
    return taken.distinct() if taken is not None else lines.select("line_id").limit(0)


def _grow(rows: pa.Table) -> pa.Table:
    """Lines (line_id, a, b, w) of a range with their status: 1 of the forest, 2 not, 0 open, between the parts a and b; 3: a link between a node that another range has and its part here."""
    rows = rows.take(pc.sort_indices(rows.select(["w", "line_id"]), sort_keys=[("w", "ascending"), ("line_id", "ascending")], null_placement="at_start"))
    a, b, pa_, pb, part = (rows.column(c).to_numpy() for c in ("a", "b", "pa", "pb", "part"))
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    far = np.zeros(len(ids), bool)
    far[at[np.concatenate([pa_ != part, pb != part])]] = True
    foreign, up, status = far.tolist(), list(range(len(ids))), []

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        x, y = root(x), root(y)
        if x == y:
            status.append(2)
        elif foreign[x] and foreign[y]:
            status.append(0)
        else:
            status.append(1)
            x, y = min(x, y), max(x, y)
            up[y] = x
            foreign[x] = foreign[x] or foreign[y]
    label = ids[np.array([root(x) for x in range(len(ids))], np.int64)]
    status, two = np.array(status, np.int32), pa_ != pb
    own = pa.table({"line_id": rows.column("line_id"), "a": label[at[: len(a)]], "b": label[at[len(a) :]], "w": rows.column("w"), "two": two, "status": status})
    own = own.filter(pa.array((status < 2) | two))
    # nodes of lines that two ranges have
    edge = np.unique(np.concatenate([at[: len(a)][two], at[len(a) :][two]]))
    m = len(edge)
    links = pa.table({"line_id": pa.nulls(m, own.schema.field("line_id").type), "a": ids[edge], "b": label[edge], "w": pa.nulls(m, own.schema.field("w").type), "two": np.ones(m, bool), "status": np.full(m, 3, np.int32)})
    return pa.concat_tables([own, links])


def prune_dead_ends(lines: DataFrame, ws: Workspace, least: int, limit: int | None = None) -> DataFrame:
    """Lines without dead ends shorter than least, again and again until none is left; lone lines count as dead ends."""
    cur = ws.put(lines, "lines")
    for _ in rounds(limit):
        short = ends(cur).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("line_id").alias("line_id")).where("n = 1").select("line_id").distinct().join(cur.where(F.col("length_cm") < least).select("line_id"), "line_id", "left_semi")
        gone = ws.put(short, "gone")
        if gone.isEmpty():
            break
        new = ws.put(cur.join(gone, "line_id", "left_anti").select(*lines.columns), "lines")
        ws.drop(cur)
        cur = new
    return cur


def collapse_rings(lines: DataFrame, rings: DataFrame) -> DataFrame:
    """(line_id, src, dst) with the nodes of each ring (ring, node) replaced by the ring's smallest node; what joins a ring to itself goes."""
    to = rings.join(rings.groupBy("ring").agg(F.min("node").alias("centre")), "ring").select("node", "centre")
    a, b = to.toDF("src", "s"), to.toDF("dst", "d")
    out = lines.join(a, "src", "left").join(b, "dst", "left").select("line_id", F.coalesce("s", "src").alias("src"), F.coalesce("d", "dst").alias("dst"), (F.col("s").isNotNull() & (F.col("s") == F.col("d"))).alias("inside"))
    return out.where("inside is null or not inside").drop("inside")


def triangle_losers(lines: DataFrame, rank: str) -> DataFrame:
    """(line_id): of each simple cycle of three nodes the line of highest rank, ties by the greatest line_id; parallel lines count as the one of lowest rank."""
    p = _pairs(lines.select("line_id", "src", "dst")).join(lines.select("line_id", rank), "line_id")
    e = p.groupBy("a", "b").agg(F.min(F.struct(F.col(rank).alias("r"), "line_id")).alias("l"))
    ab, bc, ac = e.select("a", "b", F.col("l").alias("l1")), e.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("l").alias("l2")), e.select("a", F.col("b").alias("c"), F.col("l").alias("l3"))
    # ends are in ascending order, so each cycle a < b < c comes once
    return ab.join(bc, "b").join(ac, ["a", "c"]).select(F.greatest("l1", "l2", "l3").alias("l")).select("l.line_id").distinct()


def cyclic_parts(lines: DataFrame, ws: Workspace) -> DataFrame:
    """(component, nodes, edges, cycles) of connected parts; cycles is the number of independent ones, loops and parallel lines included."""
    of = lines.select("line_id", "src", "dst").join(line_components(lines, ws), "line_id")
    edges = of.groupBy("component").agg(F.count(F.lit(1)).alias("edges"))
    nodes = of.select("component", F.explode(F.array("src", "dst")).alias("node")).distinct().groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))
    return edges.join(nodes, "component").select("component", "nodes", "edges", (F.col("edges") - F.col("nodes") + 1).alias("cycles"))
