"""Graph operators on edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.workspace import Workspace, partitions


#: Edges up to which one task joins them in memory; more are dealt to tasks of twice as many.
ONE_TASK = 250_000


def rounds(limit: int | None = None) -> Iterator[int]:
    """0, 1, 2, ... for loops that end themselves; an error past the limit, so no unfinished result is returned."""
    k = 0
    while limit is None or k < limit:
        yield k
        k += 1
    raise RuntimeError(f"not finished after {limit} rounds")


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    ids = list(parent)
    for i in range(0, len(ids), 10_000):
        part = ids[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["id", "component"])


def connected_components(edges: DataFrame, ws: Workspace, src: str = "src", dst: str = "dst", limit: int | None = None, one_task: int = ONE_TASK) -> DataFrame:
    """(id, component) of every node that has an edge; component is the smallest id reachable.

    Few edges, by count, are joined by one task. More are dealt to tasks by ranges of their smaller end; each task joins its own, so that only
    nodes which several tasks know link what those found. Where ids that are near each other are linked, as in cells or along lines, few links are left.
    Links go the same way; where they are more than half of the edges, alternating large-star and small-star steps join them: each node hands its
    neighbours the smallest node it knows, so chains halve and hubs only ever keep one edge for each neighbour. Loops and null ends are ignored; a
    node with a loop only is left out.
    """
    e = edges.where(f"{src} is not null and {dst} is not null and {src} <> {dst}").select(F.greatest(src, dst).cast("bigint").alias("a"), F.least(src, dst).cast("bigint").alias("b"))
    e = ws.put(e, "edges")
    n = e.count()
    if n <= one_task:
        return e.coalesce(1).mapInArrow(_union_find, "id long, component long")
    parts = max(partitions(e.sparkSession), -(-n // (2 * ONE_TASK)))
    stars = e.repartitionByRange(parts, "b", "a").mapInArrow(_union_find, "id long, component long")
    # a node has at most one local component for each task
    local = ws.put(stars.groupBy("id").agg(F.collect_set("component").alias("c")).select("id", F.array_min("c").alias("m"), F.when(F.size("c") > 1, F.col("c")).alias("c")), "local")
    ws.drop(e)
    links = ws.put(local.where("c is not null").select(F.explode("c").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), "links")
    if 2 * links.count() <= n:
        of = connected_components(links, ws, "a", "b", limit, one_task)
    else:
        of = _stars(links, ws, limit)
    return local.select("id", "m").join(of.toDF("m", "component"), "m", "left").select("id", F.coalesce("component", "m").alias("component"))


def _stars(e: DataFrame, ws: Workspace, limit: int | None) -> DataFrame:
    """(id, component) of distinct edges a > b by alternating star steps. Minima are summed up before they are shuffled; every round is a written table."""
    known = None
    for _ in rounds(limit):
        seen = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == known or not seen.n:
            break
        known = (seen.n, seen.h)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        big = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = ws.put(small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        ws.drop(e)
        e = new
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
