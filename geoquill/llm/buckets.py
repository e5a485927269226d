"""Links and groups of like items from shared bucket keys, whatever the size of a bucket.

Comparing all pairs of a bucket costs the square of its size. Only the groups that
links form are wanted, so each round compares the members of a bucket with one
member, its pivot, and goes on with the buckets that still hold several groups:
first the smallest id, then members with many links, which are the centres of
groups of near copies. What is left after ROUNDS is compared exhaustively, block
by block, on signatures; nothing but plausible pairs of different groups leaves a
task. So every pair that shares a key is compared, or is in one group already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from geoquill.operators.graph import connected_components
from geoquill.workspace import Workspace, partitions

ROUNDS = 3
#: Members of a block in the exhaustive comparison.
BLOCK = 1024
#: Parts that the items compared with one pivot are dealt to.
SALT = 16
#: Bits of a filter for each key, about, and at most in all (32 MB).
BITS, MOST = 16, 2**28


def mostly_of(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """rows whose key (long) is in keys, and few others: the keys go out as bits of a filter, so that a join after it shuffles few rows."""
    size = min(MOST, 2 ** max(16, (BITS * keys.count()).bit_length()))
    bit = lambda: F.pmod(F.xxhash64(key), F.lit(size))
    words = keys.select(bit().alias("b")).groupBy(F.shiftright("b", 3).alias("at")).agg(F.bit_or(F.expr("shiftleft(1, cast(b & 7 as int))")).cast("short").alias("bits")).toArrow()
    table = np.zeros(size // 8, np.uint8)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy().astype(np.uint8)

    @pandas_udf("boolean")
    def has(b: pd.Series) -> pd.Series:
        v = b.to_numpy()
        return pd.Series((table[v >> 3] >> (v & 7).astype(np.uint8)) & 1 == 1)

    return rows.where(has(bit()))


def _plausible(pairs: DataFrame, sigs: DataFrame, plausible: Callable) -> DataFrame:
    """pairs (a, b) whose signatures may belong to linked items."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ok = plausible(*(_matrix(b.column(k)) for k in (2, 3)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    left, right = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(look, "a long, b long")


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def verified(pairs: DataFrame, payloads: DataFrame, prepare: Callable, same: Callable) -> DataFrame:
    """pairs (a, b) that same() confirms; items come to their pivot in SALT parts and stream past it."""
    n = partitions(pairs.sparkSession)
    p = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)).cast("int"))
    pay = payloads.select(F.col("id").alias("x"), "payload")
    items = p.join(pay, p.b == pay.x).select("a", "salt", "b", "payload")
    pivots = p.select("a", "salt").distinct().join(pay, F.col("a") == pay.x).select("a", "salt", F.lit(None).cast("long").alias("b"), "payload")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, None
        for batch in batches:
            links = []
            for a, b, payload in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                data = prepare(payload.as_buffer().to_pybytes())
                if b is None:
                    pivot, own = a, data
                elif a == pivot and same(own, data):
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = items.unionByName(pivots).repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(compare, "a long, b long")


def _blocks(m: DataFrame, sigs: DataFrame) -> DataFrame:
    """(key, i, j, id, c, own, sig): members (key, id, c) once for each pair of blocks (i <= j) of their bucket that has theirs (own)."""
    spans = m.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rows = m.join(spans, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    rows = rows.join(sigs, "id").select("key", "i", "j", "id", "c", "own", "sig")
    return rows.repartition(partitions(m.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")


def _chunked(sig: np.ndarray, i: np.ndarray, j: np.ndarray, plausible: Callable) -> np.ndarray:
    """plausible of rows i and j of sig, some megabytes at a time."""
    n = max(1, 4_000_000 // max(1, sig.shape[1]))
    return np.concatenate([plausible(sig[i[k : k + n]], sig[j[k : k + n]]) for k in range(0, len(i), n)]) if len(i) else np.zeros(0, bool)


def _screen(b: DataFrame, sigs: DataFrame, plausible: Callable) -> DataFrame:
    """ids of members (key, id) that have a plausible partner in a bucket; whole buckets are compared, no pair leaves a task."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def found() -> set[int]:
            sig = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), -1)
            own = np.array([r[2] for r in rows])
            n, apart = len(rows), group[1] != group[2]
            has = np.zeros(n, bool)

            def against(some: np.ndarray) -> None:
                i, j = np.repeat(some, n), np.tile(np.arange(n), len(some))
                fit = (i != j) & (own[i] != own[j]) if apart else i != j
                i, j = i[fit], j[fit]
                may = _chunked(sig, i, j, plausible)
                has[i[may]] = has[j[may]] = True

            # like items mostly meet in the first comparisons; who has a partner needs no further ones
            for k in range(0, n, 16):
                at = np.arange(k, min(k + 16, n))
                against(at[~has[at]])
            return {rows[k][0] for k in np.flatnonzero(has)}

        for batch in batches:
            ids: set[int] = set()
            for key, i, j, id_, _, own, sig in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (key, i, j) != group:
                    if group:
                        ids |= found()
                    group, rows = (key, i, j), []
                rows.append((id_, sig, own))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], names=["id"])
        if group:
            yield pa.RecordBatch.from_arrays([pa.array(found(), pa.int64())], names=["id"])

    return _blocks(b.withColumn("c", F.col("id")), sigs).mapInArrow(look, "id long").distinct()


def _exhaustive(m: DataFrame, sigs: DataFrame, plausible: Callable, first: Callable | None = None) -> DataFrame:
    """Plausible pairs of different groups among members (key, id, c) of the buckets that are left, each in the first key that it shares."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, left, right = None, [], []

        def found() -> pa.RecordBatch:
            x = left + right
            c, ids, mine = (np.array([r[k] for r in x]) for k in (1, 0, 3))
            sig = np.frombuffer(b"".join(r[2] for r in x), np.uint8).reshape(len(x), -1)
            look_at = (c[:, None] != c) & (ids[:, None] < ids)
            if group[1] != group[2]:
                look_at &= mine[:, None] != mine
            i, j = np.nonzero(look_at)
            may = _chunked(sig, i, j, plausible)
            i, j = i[may], j[may]
            if first:
                own = _chunked(sig, i, j, lambda a, b: first(a, b, group[0]))
                i, j = i[own], j[own]
            return pa.RecordBatch.from_arrays([pa.array(ids[k], pa.int64()) for k in (i, j)], names=["a", "b"])

        for b in batches:
            for key, i, j, id_, c, own, sig in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (key, i, j) != group:
                    if group:
                        yield found()
                    group, left, right = (key, i, j), [], []
                (left if own == i else right).append((id_, c, sig, own))
        if group:
            yield found()

    pairs = _blocks(m, sigs).mapInArrow(look, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(ws: Workspace, members: DataFrame | list[DataFrame], sigs: DataFrame, payloads: DataFrame | Callable, plausible: Callable, prepare: Callable, same: Callable, screen: bool = False, first: Callable | None = None) -> DataFrame:
    """(id, component) of all items that have a link.

    members: key, id, or a list of such frames without common keys, which are joined in turn; sigs: id, sig (binary, one length); payloads: id, payload
    (binary), or a function that gives them for a frame of ids.
    plausible(sigs, sigs) -> mask of pairs worth confirming; same(prepare(payload),
    prepare(payload)) -> whether two items are linked. Ids are longs without nulls;
    repeated rows do no harm. screen: look at all signatures of a bucket first and go
    on with items that have a plausible partner, so few payloads are fetched.
    first(sigs, sigs, key) -> mask of pairs of which key is the first that they share;
    without it pairs leave the exhaustive comparison once for each key they share.
    """
    # Keys are made twice rather than written: most belong to one item only.
    parts, many = [], isinstance(members, list)
    of = [F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot"), F.bit_xor(F.xxhash64("id")).alias("set")]

    def once(own: DataFrame, left: DataFrame) -> DataFrame:
        """Members of the keys that are left; of many frames, keys with the same members become one."""
        x = own.join(left, "key")
        return x.select(F.col("set").alias("key"), "id", "n", "pivot").dropDuplicates(["key", "id"]) if many else x.select("key", "id", "n", "pivot")

    for m in members if many else [members]:
        m = m.select("key", "id")
        b = ws.put(once(m, m.groupBy("key").agg(*of).where("n > 1")), "shared")
        ws.release()
        if screen:
            some = ws.put(_screen(b.select("key", "id"), sigs.select("id", "sig"), plausible), "screened")
            own = b.select("key", "id").join(some, "id", "left_semi")
            few = ws.put(once(own, own.groupBy("key").agg(*of).where("n > 1")), "shared")
            ws.drop(b, some)
            b = few
            ws.release()
        parts.append(b)
    b = parts[0]
    if many:
        b = ws.put(reduce(DataFrame.unionByName, parts).dropDuplicates(["key", "id"]), "shared")
        ws.drop(*parts)
        ws.release()
    ids = ws.put(b.select("id").distinct(), "ids")
    s = ws.put(sigs.select("id", "sig").join(ids, "id", "left_semi"), "sigs")
    pay = ws.put(payloads(ids).select("id", "payload") if callable(payloads) else payloads.select("id", "payload").join(ids, "id", "left_semi"), "payloads")
    ws.release()
    pairs = b.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links, used = None, b.select("key", F.col("pivot").alias("id")).distinct()
    for k in range(ROUNDS + 1):
        likely = ws.put(_plausible(pairs, s, plausible), "likely")
        new = ws.put(verified(likely, pay, prepare, same).distinct(), "links")
        links = new if links is None else links.unionByName(new)
        comp = ws.put(connected_components(links, ws, "a", "b"), "components")
        ws.drop(likely)
        ws.release()
        if k == ROUNDS:
            break
        open_ = b.where(f"n > {k + 2}").select("key", "id").join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
        keys = open_.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("key")
        open_ = ws.put(open_.join(keys, "key", "left_semi"), "open")
        if open_.isEmpty():
            break
        if k + 1 == ROUNDS:
            pairs = ws.put(_exhaustive(open_, s, plausible, first), "pairs")
            continue
        degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("d"))
        fresh = open_.join(used, ["key", "id"], "left_anti").join(degree, "id", "left")
        pivot = ws.put(fresh.groupBy("key").agg(F.max(F.struct(F.coalesce("d", F.lit(0)).alias("d"), F.xxhash64(F.lit(k), "id").alias("h"), "id", "c")).alias("p")).select("key", F.col("p.id").alias("pivot"), F.col("p.c").alias("pc")), "pivots")
        used = used.unionByName(pivot.select("key", F.col("pivot").alias("id")))
        pairs = open_.join(pivot, "key").where("c <> pc").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    return comp
