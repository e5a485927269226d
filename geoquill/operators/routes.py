"""Least routes in weighted networks, trees that join terminals, and directions of rivers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.operators.graph import rounds
from geoquill.operators.network import spanning_forest
from geoquill.workspace import Workspace


def both_ways(lines: DataFrame, weight: str) -> DataFrame:
    """(a, b, w, line_id): each line from both its ends; loops and null weights left out."""
    e = lines.where(f"src <> dst and {weight} is not null").select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col(weight).alias("w"), "line_id")
    return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"), "w", "line_id"))


def routes(lines: DataFrame, sources: DataFrame, ws: Workspace, weight: str = "length_cm", band: float | None = None, by: str = "sum", limit: float | None = None) -> DataFrame:
    """(node, dist, hops, source, parent, via) of every node that a source reaches: its least route from the best source.

    lines: (line_id, src, dst, weight >= 0), travelled both ways; sources: (node) or
    (node, dist) with a start value. by: sum adds weights along a route, max takes the
    greatest (for heights: the lowest pass). Ties go to fewer hops, the smaller source,
    parent and line. limit leaves out routes that are longer. By max, hops may count
    another route of the same dist; dist, then hops, always fall towards the source.

    Nodes are settled in bands of the distance (band, by default sixteen mean weights): the
    rounds inside a band go on from nodes that improved in it, and a settled band is
    written once and not read again but to keep nodes from coming back.
    """
    e = ws.put(both_ways(lines, weight), "ways")
    kind = e.schema["w"].dataType
    start = sources.select("node", (F.col("dist") if "dist" in sources.columns else F.lit(0)).cast(kind).alias("dist")).where("node is not null")
    if band is None:
        band = 16 * float(e.agg(F.avg("w")).first()[0] or 1) or 1.0
    key = ["dist", "hops", "source", "parent", "via", "fresh"]
    least = lambda d: d.groupBy("node").agg(F.min(F.struct(*key)).alias("k")).select("node", "k.*")
    none = F.lit(None).cast("bigint")
    pending = ws.put(least(start.select("node", "dist", F.lit(0).alias("hops"), F.col("node").cast("bigint").alias("source"), none.alias("parent"), none.alias("via"), F.lit(1).alias("fresh"))), "pending")
    settled = None
    top = 0.0
    for _ in rounds():
        low = pending.agg(F.min("dist"), F.min(F.when(F.col("fresh") == 1, F.col("dist")))).first()
        if low[0] is None:
            break
        if low[1] is None or low[1] >= top:
            # nothing of this band improves any more
            done = pending.where(F.col("dist") < top) if top else pending.limit(0)
            part = ws.put(done, "settled")
            settled = part if settled is None else settled.unionByName(part)
            pending = ws.put(pending.where(F.col("dist") >= top), "pending")
            low = pending.agg(F.min("dist")).first()
            if low[0] is None:
                break
            top = (low[0] // band + 1) * band
            continue
        now = (F.col("fresh") == 1) & (F.col("dist") < top)
        front = pending.where(now)
        there = F.col("dist") + F.col("w") if by == "sum" else F.greatest("dist", "w")
        new = front.join(e, F.col("node") == F.col("a")).select(F.col("b").alias("node"), there.cast(kind).alias("dist"), (F.col("hops") + 1).alias("hops"), "source", F.col("a").alias("parent"), F.col("line_id").cast("bigint").alias("via"), F.lit(1).alias("fresh"))
        if limit is not None:
            new = new.where(F.col("dist") <= limit)
        new = new.join(settled.select("node"), "node", "left_anti") if settled is not None else new
        # an old row equals the best new one only where nothing improved: 0 goes before 1
        kept = pending.withColumn("fresh", F.when(now, 0).otherwise(F.col("fresh")))
        merged = ws.put(least(kept.unionByName(new)), "pending")
        ws.drop(pending)
        pending = merged
    out = settled if settled is not None else pending
    return out.drop("fresh")


def place_distances(lines: DataFrame, pairs: DataFrame, ws: Workspace, weight: str = "length_cm", limit: float | None = None) -> DataFrame:
    """(pair, dist) of pairs (pair, line_a, at_a, line_b, at_b) of places on lines: along the network, with part of the first and of the last line; null where there is no way.

    Each pair is searched in a copy of the network's nodes of its own, so many pairs go
    at once; give a limit where networks are large.
    """
    ends = lines.select("line_id", "src", "dst", F.col(weight).alias("w"))
    p = pairs.join(ends.select(F.col("line_id").alias("line_a"), F.col("src").alias("sa"), F.col("dst").alias("da"), F.col("w").alias("wa")), "line_a").join(ends.select(F.col("line_id").alias("line_b"), F.col("src").alias("sb"), F.col("dst").alias("db"), F.col("w").alias("wb")), "line_b")
    p = ws.put(p, "pairs")
    e = both_ways(lines, weight)
    at = ws.put(p.select("pair", F.explode(F.array(F.struct(F.col("sa").alias("node"), F.col("at_a").alias("dist")), F.struct(F.col("da").alias("node"), (F.col("wa") - F.col("at_a")).alias("dist")))).alias("s"), F.lit(1).alias("fresh")).select("pair", "s.*", "fresh").groupBy("pair", "node").agg(F.min("dist").alias("dist"), F.max("fresh").alias("fresh")), "at")
    e = ws.put(e, "ways")
    for _ in rounds():
        new = at.where("fresh = 1").join(e, F.col("node") == F.col("a")).select("pair", F.col("b").alias("node"), (F.col("dist") + F.col("w")).alias("dist"))
        new = new.where(F.col("dist") <= limit) if limit is not None else new
        both = at.select("pair", "node", "dist", F.lit(0).alias("fresh")).unionByName(new.withColumn("fresh", F.lit(1)))
        nxt = ws.put(both.groupBy("pair", "node").agg(F.min(F.struct("dist", "fresh")).alias("k")).select("pair", "node", "k.*"), "at")
        ws.drop(at)
        at = nxt
        if at.where("fresh = 1").isEmpty():
            break
    goal = p.select("pair", F.explode(F.array(F.struct(F.col("sb").alias("node"), F.col("at_b").alias("rest")), F.struct(F.col("db").alias("node"), (F.col("wb") - F.col("at_b")).alias("rest")))).alias("g")).select("pair", "g.*")
    over = goal.join(at, ["pair", "node"]).groupBy("pair").agg(F.min(F.col("dist") + F.col("rest")).alias("over"))
    along = F.when(F.col("line_a") == F.col("line_b"), F.abs(F.col("at_a") - F.col("at_b")))
    return pairs.join(over, "pair", "left").select("pair", F.when(along.isNotNull(), F.least(along, "over")).otherwise(F.col("over")).alias("dist"))


def terminal_tree(lines: DataFrame, terminals: DataFrame, ws: Workspace, weight: str = "length_cm") -> DataFrame:
    """line_id of lines that join the terminals (node) of each connected part: the least spanning tree of their distances, laid out along least routes.

    Every node belongs to its nearest terminal; a line between two such cells stands for
    a way between their terminals, and the least forest of cells over these lines has
    the weight of the least forest over all distances. Both ends of its lines are then
    followed back to their terminals, in as many rounds as the logarithm of the longest way.
    """
    r = ws.put(routes(lines, terminals, ws, weight), "cells")
    at = lambda end: r.select(F.col("node").alias(end), F.col("source").alias(f"s_{end}"), F.col("dist").alias(f"d_{end}"))
    between = lines.where(f"src <> dst and {weight} is not null").join(at("src"), "src").join(at("dst"), "dst").where("s_src <> s_dst")
    cells = ws.put(between.select("line_id", F.col("s_src").alias("src"), F.col("s_dst").alias("dst"), (F.col("d_src") + F.col(weight) + F.col("d_dst")).alias("w"), F.col("src").alias("end_a"), F.col("dst").alias("end_b")), "between")
    tree = ws.put(cells.join(spanning_forest(cells, ws, "w"), "line_id", "left_semi"), "tree")
    up = ws.put(r.where("parent is not null").select("node", F.col("parent").alias("to")), "up")
    on = ws.put(tree.select(F.explode(F.array("end_a", "end_b")).alias("node")).distinct(), "on")
    for _ in rounds(62):
        more = ws.put(on.unionByName(on.join(up, "node").select(F.col("to").alias("node"))).distinct(), "on")
        up2 = ws.put(up.join(up.select(F.col("node").alias("to"), F.col("to").alias("to2")), "to").select("node", F.col("to2").alias("to")), "up")
        ws.drop(on, up)
        on, up = more, up2
        if up.isEmpty():
            break
    ways = r.join(on, "node", "left_semi").where("via is not null").select(F.col("via").alias("line_id"))
    return ways.unionByName(tree.select(F.col("line_id").cast("bigint").alias("line_id"))).distinct()


# --- rivers ---------------------------------------------------------------------------------------


def toward_sinks(lines: DataFrame, sinks: DataFrame, ws: Workspace) -> DataFrame:
    """(line_id, src, dst): lines of a tree of fewest steps to the sinks (node), each turned towards them; other lines are left out.

    Of several next nodes the smallest is taken, of parallel lines the smallest line_id.
    """
    d = lines.select("line_id", "src", "dst", F.lit(1).alias("one"))
    far = ws.put(routes(d, sinks.select("node"), ws, "one").select("node", "hops"), "steps")
    at = lambda c, n: far.select(F.col("node").alias(c), F.col("hops").alias(n))
    up = both_ways(d, "one").join(at("a", "ha"), "a").join(at("b", "hb"), "b").where("hb = ha - 1").groupBy("a").agg(F.min(F.struct("b", "line_id")).alias("m"))
    return up.select(F.col("m.line_id").alias("line_id"), F.col("a").alias("src"), F.col("m.b").alias("dst"))


def drained(lines: DataFrame, heights: DataFrame, sinks: DataFrame, ws: Workspace, least: int = 0) -> DataFrame:
    """(line_id, src, dst, certain) of lines that can reach a sink, turned so that all water does.

    heights: (node, z). A line is certain where its ends differ by at least `least`
    (if more than 0) and it keeps falling that way unless that would close a cycle. All
    others go by the flood: each node has the lowest pass over which it reaches a sink,
    then the fewest steps; lines lead to the smaller of these, so no cycle comes of them
    and every node that isn't a sink has a way on. A certain line that leads against
    the flood is kept only if it doesn't join nodes that lie in one cycle with it.
    """
    z = lambda end: heights.select(F.col("node").alias(end), F.col("z").alias(f"z_{end}"))
    e = lines.where("src <> dst").select("line_id", "src", "dst").join(z("src"), "src", "left").join(z("dst"), "dst", "left")
    e = ws.put(e.withColumn("pass", F.greatest("z_src", "z_dst", F.lit(-(2**31)))), "passes")
    start = sinks.join(heights, "node", "left").select("node", F.coalesce("z", F.lit(-(2**31))).alias("dist"))
    r = ws.put(routes(e, start, ws, "pass", by="max", band=float(2**40)), "flood")
    key = lambda end: r.select(F.col("node").alias(end), F.struct("dist", "hops", "node").alias(f"k_{end}"))
    f = e.join(key("src"), "src").join(key("dst"), "dst")
    sure = (F.abs(F.col("z_src") - F.col("z_dst")) >= least) & F.lit(least > 0)
    f = f.withColumn("certain", F.coalesce(sure, F.lit(False)))
    down = F.when(F.col("certain"), F.col("z_src") > F.col("z_dst")).otherwise(F.col("k_src") > F.col("k_dst"))
    turn = lambda c: (F.when(c, F.col("src")).otherwise(F.col("dst")).alias("src"), F.when(c, F.col("dst")).otherwise(F.col("src")).alias("dst"))
    f = ws.put(f.withColumn("flood", F.col("k_src") > F.col("k_dst")).withColumn("down", down), "turned")
    d = ws.put(f.select("line_id", *turn(F.col("down")), "certain", (F.col("certain") & (F.col("down") != F.col("flood"))).alias("against")), "directed")
    bad = cyclic_lines(d, ws)
    back = d.join(bad, "line_id", "left_semi").where("against").select("line_id")
    back = ws.put(back, "back")
    return f.join(back.withColumn("back", F.lit(True)), "line_id", "left").select("line_id", *turn(F.when(F.col("back"), F.col("flood")).otherwise(F.col("down"))), (F.col("certain") & F.col("back").isNull()).alias("certain"))


def cyclic_lines(lines: DataFrame, ws: Workspace) -> DataFrame:
    """line_id of directed lines (src -> dst) that are part of a directed cycle: those inside a strongly connected part.

    Lines that lead to an end or come from a start are trimmed, again and again. What
    is left is divided by its smallest reached node, forwards and backwards; a part that
    has both in common is one cycle system, lines between parts are dropped, and the
    rest goes on.
    """
    e = ws.put(lines.where("src <> dst").select("line_id", "src", "dst"), "lines")
    found = lines.where("src = dst").select("line_id")
    for _ in rounds():
        for _ in rounds():
            n = ws.put(e.join(e.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").join(e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi"), "trimmed")
            same = n.count() == e.count()
            ws.drop(e)
            e = n
            if same:
                break
        if e.isEmpty():
            return found
        fore, back = _smallest(e, "src", "dst", ws), _smallest(e, "dst", "src", ws)
        colour = ws.put(fore.join(back.withColumnRenamed("low", "back"), "node"), "colours")
        both = e.join(colour.select(F.col("node").alias("src"), F.col("low").alias("fs"), F.col("back").alias("bs")), "src").join(colour.select(F.col("node").alias("dst"), F.col("low").alias("fd"), F.col("back").alias("bd")), "dst")
        both = ws.put(both.where("fs = fd and bs = bd"), "within")
        # reached from, and reaching, the same smallest node
        whole = ws.put(both.where("fs = bs").select("line_id"), "whole")
        found = found.unionByName(whole)
        e = ws.put(both.where("fs <> bs").select("line_id", "src", "dst"), "lines")


def _smallest(e: DataFrame, a: str, b: str, ws: Workspace) -> DataFrame:
    """(node, low): the smallest node from which there is a way along a -> b, itself included."""
    s = ws.put(e.select(F.explode(F.array("src", "dst")).alias("node")).distinct().select("node", F.col("node").alias("low"), F.lit(True).alias("fresh")), "low")
    for _ in rounds():
        new = s.where("fresh").join(e, F.col("node") == F.col(a)).select(F.col(b).alias("node"), "low")
        both = s.select("node", "low", F.lit(0).alias("k")).unionByName(new.withColumn("k", F.lit(1)))
        nxt = ws.put(both.groupBy("node").agg(F.min(F.struct("low", "k")).alias("m")).select("node", "m.low", (F.col("m.k") == 1).alias("fresh")), "low")
        ws.drop(s)
        s = nxt
        if s.where("fresh").isEmpty():
            return s.select("node", "low")


def guarded_strahler(lines: DataFrame, ws: Workspace) -> DataFrame:
    """(line_id, strahler) of directed lines without cycles: as Strahler's order, but a node where branches of a common origin meet doesn't raise it.

    Branches share an origin where some node lies above the upper ends of two of them.
    Such a node exists if and only if a parting (a node with several ways on) does, so
    only partings travel down as sets: small, but for networks of braids. Every round
    settles the nodes all of whose inflows are known. Lines in or below cycles have 1.
    """
    e = ws.put(lines.where("src is not null and dst is not null").select("line_id", "src", "dst"), "lines")
    need = e.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("need"))
    ways = e.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("ways"))
    node = ws.put(ways.join(need, "node", "full").select("node", F.coalesce("ways", F.lit(0)).alias("ways"), F.coalesce("need", F.lit(0)).alias("need")), "nodes")
    empty = F.array().cast("array<bigint>")
    ready = ws.put(node.where("need = 0").select("node", "ways", "need", F.lit(1).alias("order"), empty.alias("above")), "ready")
    inbox, out = None, None
    for _ in rounds():
        own = F.when(F.col("ways") > 1, F.array(F.col("node").cast("bigint"))).otherwise(empty)
        sent = F.array_union("above", own)
        # a start has nothing above it that another branch could share
        tested = F.when(F.col("need") > 0, sent).otherwise(F.col("above"))
        mail = ws.put(ready.select(F.col("node").alias("src"), "order", sent.alias("sent"), tested.alias("tested")).join(e, "src"), "mail")
        if mail.isEmpty():
            break
        out = mail.select("line_id", "order") if out is None else out.unionByName(mail.select("line_id", "order"))
        new = mail.select("line_id", F.col("dst").alias("node"), "order", "sent", "tested")
        inbox = new if inbox is None else inbox.unionByName(new)
        full = inbox.groupBy("node").agg(F.count(F.lit(1)).alias("have"), F.max("order").alias("top"), F.collect_list(F.struct("order", "tested")).alias("branches"), F.flatten(F.collect_list("sent")).alias("all")).join(node, "node").where("have = need")
        tie = F.size(F.filter("branches", lambda b: b["order"] == F.col("top"))) > 1
        # in two branches: what stands in the joined lists more than once, each list being a set
        every = F.flatten(F.transform("branches", lambda b: b["tested"]))
        shared = F.size(every) > F.size(F.array_distinct(every))
        order = F.when(tie & ~shared, F.col("top") + 1).otherwise(F.col("top"))
        ready = ws.put(full.select("node", "ways", "need", order.alias("order"), F.array_distinct("all").alias("above")), "ready")
        inbox = ws.put(inbox.join(ready.select("node"), "node", "left_anti"), "inbox")
    known = e.select("line_id").join(out, "line_id", "left") if out is not None else e.select("line_id", F.lit(None).cast("int").alias("order"))
    return known.select("line_id", F.coalesce("order", F.lit(1)).alias("strahler"))
