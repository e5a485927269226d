"""Connected cells and their borders, tile by tile: cells are dealt out by square tiles, and only what lies on two sides of a seam is joined.

A task compares its own cells by sorted places; no pair of cells is written but those
across seams, which are as the root of a tile's cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.operators.graph import connected_components
from geoquill.workspace import Workspace, partitions

#: Side of a tile in cells, and cells that a task takes, about.
TILE, TASK = 256, 1_000_000
SIDES = ((0, 1), (1, 0), (0, -1), (-1, 0))


def _tiled(cells: DataFrame, rows: int) -> DataFrame:
    """cells (col, row and others) dealt by tile."""
    tile = [F.floor(F.col(c) / TILE) for c in ("col", "row")]
    return cells.repartition(max(partitions(cells.sparkSession), -(-rows // TASK)), *tile)


def _read(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    own = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(own).combine_chunks() if own else None


def _beside(col: np.ndarray, row: np.ndarray, kind: np.ndarray, tile: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """order, and (lo, hi) for each side: order[lo:hi] are the cells of a cell's kind and tile that lie there."""
    cols, c = np.unique(col, return_inverse=True)
    rows, r = np.unique(row, return_inverse=True)
    kinds = int(kind.max()) + 1
    # ranks, so that a place and kind is one small number whatever the extent
    lines, line = np.unique(r * kinds + kind, return_inverse=True)
    place = line * len(cols) + c
    order = np.argsort(place, kind="stable")
    place = place[order]

    def find(values: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(values, want), len(values) - 1)
        return at, values[at] == want

    sides = []
    for i, j in SIDES:
        x, there = find(cols, col + i)
        y, has = find(rows, row + j)
        there &= has & (col // tile == (col + i) // tile) & (row // tile == (row + j) // tile)
        z, has = find(lines, y * kinds + kind)
        want = np.where(there & has, z * len(cols) + x, -1)
        sides.append((np.searchsorted(place, want), np.searchsorted(place, want, side="right")))
    return order, sides


def _labels(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each of the items 0 to len(ids) - 1 reaches by the links a, b."""
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    up, (a, b) = np.arange(len(ids)), (rank[a], rank[b])
    while len(a):
        x, y = up[a], up[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up, up[up]):
            up = up[up]
    return np.sort(ids)[up[rank]]


def _joined(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Cells plus label: the smallest id of the connected cells of equal gq_kind inside the tile; a null kind joins nothing."""
    t = _read(batches)
    if t is None:
        return
    ids, col, row = (t.column(c).to_numpy() for c in ("id", "col", "row"))
    codes = t.column("gq_kind").combine_chunks().dictionary_encode()
    codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
    kind = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    own, links = np.flatnonzero(kind >= 0), []
    if len(own):
        order, sides = _beside(col[own], row[own], kind[own], tile)
        for lo, hi in sides:
            has = np.flatnonzero(hi > lo)
            # each cell and the first of those beside it: copies of a place hang together by what they all lie beside
            links.append((own[has], own[order[lo[has]]]))
    a, b = (np.concatenate([x[i] for x in links]) if links else np.empty(0, np.int64) for i in (0, 1))
    yield from t.append_column("gq_label", pa.array(_labels(ids, a, b))).to_batches(max_chunksize=50_000)


def _across(seam: DataFrame, *keep: str) -> DataFrame:
    """Cells on seams with the places beside them in other tiles, as to_col and to_row."""
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in SIDES]))
    s = seam.select(*keep, "col", "row", o.alias("o")).select(*keep, "col", "row", (F.col("col") + F.col("o.i")).alias("to_col"), (F.col("row") + F.col("o.j")).alias("to_row"))
    tile = lambda c: F.floor(F.col(c) / TILE)
    return s.where((tile("col") != tile("to_col")) | (tile("row") != tile("to_row"))).drop("col", "row")


def _seam(cells: DataFrame) -> DataFrame:
    c, r = F.pmod("col", F.lit(TILE)), F.pmod("row", F.lit(TILE))
    return cells.where(c.isin(0, TILE - 1) | r.isin(0, TILE - 1))


def connected_cells(cells: DataFrame, ws: Workspace, by: str) -> DataFrame:
    """cells (id, col, row, by and others), ids unique, plus part: connected cells of equal `by`; part is the smallest id. A null id, `by`, col or row joins nothing."""
    names = cells.columns
    c = cells.withColumns({k: F.col(k).cast("bigint") for k in ("id", "col", "row")}).withColumn("gq_kind", F.col(by).cast("string"))
    placed, tile = c.where("id is not null and col is not null and row is not null"), TILE
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in placed.schema) + "gq_label bigint"
    local = ws.put(_tiled(placed, placed.count()).mapInArrow(lambda x: _joined(x, tile), schema), "labels")
    seam = _seam(local).where("gq_kind is not null").select("gq_label", "gq_kind", "col", "row")
    beside = seam.select(F.col("gq_label").alias("other"), F.col("col").alias("to_col"), F.col("row").alias("to_row"), "gq_kind")
    links = _across(seam, "gq_label", "gq_kind").join(beside, ["to_col", "to_row", "gq_kind"]).where("gq_label <> other").select("gq_label", "other").distinct()
    of = connected_components(links, ws, "gq_label", "other")
    got = local.join(of.select(F.col("id").alias("gq_label"), F.col("component").alias("gq_of")), "gq_label", "left").select(*names, F.coalesce("gq_of", "gq_label").alias("part"))
    return got.unionByName(c.where("id is null or col is null or row is null").select(*names, F.col("id").alias("part")))


def _counted(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """(part, other, len) of pairs of cells beside each other in a tile."""
    t = _read(batches)
    if t is None:
        return
    col, row, part = (t.column(c).to_numpy() for c in ("col", "row", "part"))
    found = []
    order, sides = _beside(col, row, np.zeros(len(col), np.int64), tile)
    for lo, hi in sides:
        n = hi - lo
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        x, y = np.repeat(part, n), part[order[at]]
        o = np.lexsort((y, x))
        x, y = x[o], y[o]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        first = np.flatnonzero(new)
        found.append((x[first], y[first], np.diff(first, append=len(x))))
    for x, y, n in found:
        yield from pa.table({"part": pa.array(x), "other": pa.array(y), "len": pa.array(n)}).to_batches(max_chunksize=50_000)


def shared_sides(whole: DataFrame, rows: int | None = None) -> DataFrame:
    """(part, other, len): pairs of cells (col, row, part) beside each other, by part, also of one part with itself. rows: their number, where it is known."""
    w = whole.where("part is not null and col is not null and row is not null").select(F.col("col").cast("bigint").alias("col"), F.col("row").cast("bigint").alias("row"), "part")
    tile = TILE
    inner = _tiled(w, w.count() if rows is None else rows).mapInArrow(lambda x: _counted(x, tile), "part long, other long, len long")
    seam = _seam(w)
    beside = seam.select(F.col("part").alias("other"), F.col("col").alias("to_col"), F.col("row").alias("to_row"))
    outer = _across(seam, "part").join(beside, ["to_col", "to_row"]).select("part", "other", F.lit(1).cast("bigint").alias("len"))
    return inner.unionByName(outer).groupBy("part", "other").agg(F.sum("len").alias("len"))
