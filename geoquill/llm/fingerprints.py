"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A text is its paragraphs: lines, and inside a line sentences. The k-th occurrence
of a paragraph is one key of 64 bits. A sketch has `cells` cells of (count, xor of
keys, xor of checks); a key goes to three of them. Two sketches of one size
subtract cell by cell; peeling cells that hold one key recovers the keys that only
one text has. Where peeling gets stuck, both sketches are made again twice as large.

The fingerprint that is stored has FIRST cells and can be loaded, subtracted and
peeled without its text; many sketches are peeled at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquill.workspace import Workspace, partitions

#: Cells of a stored fingerprint; those of larger sketches are its doubles.
FIRST = 24
_CUT = re.compile(rb"\n+|(?<=[.!?])[ \t]+")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def paragraph_keys(text: bytes) -> np.ndarray:
    """Distinct 64-bit keys of the paragraphs; white space at the ends and empty paragraphs don't count."""
    seen: dict[bytes, int] = {}
    keys = []
    for p in _CUT.split(text):
        p = p.strip()
        if p:
            n = seen.get(p, 0)
            seen[p] = n + 1
            keys.append(xxhash.xxh3_64_intdigest(p, n))
    return np.unique(np.array(keys, np.uint64))


def _spread(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[salt]
    x = (x ^ (x >> np.uint64(29))) * _MIX[(salt + 1) % 4]
    return x ^ (x >> np.uint64(32))


def places(keys: np.ndarray, cells: int) -> np.ndarray:
    """Three different cells for each key: one in each third of the sketch."""
    third = np.uint64(cells // 3)
    return np.stack([(_spread(keys, s) % third + np.uint64(s) * third).astype(np.int64) for s in range(3)])


def check(keys: np.ndarray) -> np.ndarray:
    return _spread(keys, 3)


class Sketches:
    """Sketches of one size, side by side in three arrays."""

    def __init__(self, n: int, cells: int):
        self.cells = cells
        self.count = np.zeros(n * cells, np.int64)
        self.keys = np.zeros(n * cells, np.uint64)
        self.checks = np.zeros(n * cells, np.uint64)

    def put(self, which: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        at = (places(keys, self.cells) + which * self.cells).ravel()
        np.add.at(self.count, at, np.tile(np.broadcast_to(sign, keys.shape), 3))
        np.bitwise_xor.at(self.keys, at, np.tile(keys, 3))
        np.bitwise_xor.at(self.checks, at, np.tile(self.check(keys), 3))

    def check(self, keys: np.ndarray) -> np.ndarray:
        return check(keys)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sketch, key, sign) of every recovered key, and for each sketch whether all were recovered. Empties the cells."""
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            pure = look[(np.abs(self.count[look]) == 1) & (self.check(self.keys[look]) == self.checks[look])]
            if not len(pure):
                break
            which, keys, sign = pure // self.cells, self.keys[pure], self.count[pure]
            _, first = np.unique(np.stack([which.astype(np.uint64), keys]), axis=1, return_index=True)
            which, keys, sign = which[first], keys[first], sign[first]
            got.append((which, keys, sign))
            self.put(which, keys, -sign)
            look = np.unique(places(keys, self.cells) + which * self.cells)
        n = len(self.count) // self.cells
        left = (self.count != 0) | (self.keys != 0)
        done = ~left.reshape(n, self.cells).any(axis=1)
        parts = [np.concatenate(x) for x in zip(*got, strict=True)] if got else [np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)]
        return (*parts, done)

    def stored(self, i: int, n_keys: int) -> bytes:
        """The stored form: cells, keys, and the arrays of one sketch. Counts are kept modulo 2**16 and checks modulo 2**32, which Loaded knows."""
        s = slice(i * self.cells, (i + 1) * self.cells)
        raw = np.array([self.cells, n_keys], "<u4").tobytes() + (self.count[s] & 0xFFFF).astype("<u2").tobytes() + self.keys[s].astype("<u8").tobytes() + self.checks[s].astype("<u4").tobytes()
        return raw


class Loaded(Sketches):
    """One sketch from its stored form: as good for subtracting and peeling, since what differs is counted modulo 2**16 too."""

    def __init__(self, raw: bytes):
        self.cells, self.n_keys = (int(x) for x in np.frombuffer(raw, "<u4", 2))
        c = self.cells
        self.count = np.frombuffer(raw, "<u2", c, 8).astype(np.int64)
        self.keys = np.frombuffer(raw, "<u8", c, 8 + 2 * c).astype(np.uint64)
        self.checks = np.frombuffer(raw, "<u4", c, 8 + 10 * c).astype(np.uint64)

    def check(self, keys: np.ndarray) -> np.ndarray:
        return check(keys) & np.uint64(0xFFFFFFFF)

    def difference(self, other: Loaded) -> tuple[np.ndarray, np.ndarray] | None:
        """Keys that only this and only the other sketch holds; None where peeling gets stuck, or sizes differ: then both texts need larger sketches."""
        if self.cells != other.cells:
            return None
        rest = Loaded.__new__(Loaded)
        rest.cells = self.cells
        rest.count = (self.count - other.count + 0x8000) % 0x10000 - 0x8000
        rest.keys, rest.checks = self.keys ^ other.keys, self.checks ^ other.checks
        _, keys, sign, done = rest.peel()
        return (keys[sign > 0], keys[sign < 0]) if done[0] else None


def stored_likeness(df: DataFrame, a: str = "fingerprint", b: str = "edited_fingerprint", name: str = "gq_likeness") -> DataFrame:
    """df plus the likeness of two stored fingerprints (base64), from these alone; null where they differ by more than their cells tell, and where one is null."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def likeness_of(x, y):
        def one(p, q):
            if p is None or q is None:
                return None
            p, q = Loaded(p), Loaded(q)
            found = p.difference(q)
            return None if found is None else likeness(p.n_keys, q.n_keys, len(found[0]), len(found[1]))

        import pandas as pd

        return pd.Series([one(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    got = df.withColumn(name, likeness_of(F.unbase64(a), F.unbase64(b)))
    return got.withColumn(name, F.when(~F.isnan(name), F.col(name)))


def sketches(keys: list[np.ndarray], cells: int) -> Sketches:
    out = Sketches(len(keys), cells)
    if keys:
        out.put(np.repeat(np.arange(len(keys)), [len(k) for k in keys]), np.concatenate(keys), 1)
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], first: int = FIRST, made: tuple[Sketches, Sketches] | None = None) -> list[tuple[list[int], list[int]]]:
    """For each pair the keys that only the first and only the second has, by subtracting and peeling; made: the first sketches of both sides, if they are there."""
    out: list = [None] * len(a)
    todo, cells = list(range(len(a))), first
    while todo:
        x, y = made or (sketches([a[i] for i in todo], cells), sketches([b[i] for i in todo], cells))
        made = None
        which, keys, sign, done = x.minus(y).peel()
        order = np.argsort(which, kind="stable")
        at = np.searchsorted(which[order], np.arange(len(todo) + 1))
        for j, i in enumerate(todo):
            if done[j]:
                own = order[at[j] : at[j + 1]]
                out[i] = (keys[own[sign[own] > 0]], keys[own[sign[own] < 0]])
        todo, cells = [i for i, d in zip(todo, done, strict=True) if not d], cells * 2
    return out


def likeness(n_a: int, n_b: int, only_a: int, only_b: int) -> float:
    """Shared keys by all keys; two texts without paragraphs are alike."""
    shared, every = n_a - only_a, n_a + only_b
    return shared / every if every else 1.0


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(rows: list[tuple], first: int = FIRST) -> pa.RecordBatch:
    """rows: (doc_id, text, next text)."""
    new = [edited(t, f) for _, t, f in rows]
    sets = [[paragraph_keys(x.encode()) for x in col] for col in ([t for _, t, _ in rows], new, [f for _, _, f in rows])]
    own, changed = sketches(sets[0], first), sketches(sets[1], first)
    made = (changed, sketches(sets[2], first))
    near = [[likeness(len(a), len(b), len(x), len(y)) for a, b, (x, y) in zip(sets[0], other, differences(sets[0], other, first, (own, m)), strict=True)] for other, m in zip(sets[1:], made, strict=True)]
    cols = [
        pa.array([r[0] for r in rows], pa.int64()),
        pa.array([len(r[1]) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).digest() for x in new], pa.binary()),
        pa.array([own.stored(i, len(k)) for i, k in enumerate(sets[0])], pa.binary()),
        pa.array([changed.stored(i, len(k)) for i, k in enumerate(sets[1])], pa.binary()),
        *(pa.array(x, pa.float64()) for x in near),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


OUT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
#: Characters of documents that are compared at once.
CHUNK = 1_500_000


def edit_fingerprints(docs: DataFrame, n: int | None = None, first: int = FIRST) -> DataFrame:
    """Fingerprint of each text and of its edited text, and their likeness to it and to the next document.

    The next document follows in order of doc_id, of repeated ids by a hash of the
    text, null ids first; the first follows the last. A null text is empty. One row for each row of docs; the only
    document is its own next.

    Documents are range-partitioned once. Inside a partition each meets its next
    as they stream by; the first and last of each partition are put aside and
    meet each other in a second, far smaller pass of the same kind.
    """
    ws = Workspace(docs.sparkSession, "fingerprints")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    out = _next_pass(d, ws, n or partitions(docs.sparkSession), first)
    return out.withColumns({"edited_sha256": F.lower(F.hex("edited_sha256")), "fingerprint": F.base64("fingerprint"), "edited_fingerprint": F.base64("edited_fingerprint")})


def _next_pass(d: DataFrame, ws: Workspace, n: int, first: int) -> DataFrame:
    kind = T.StructType([*T.StructType.fromDDL(OUT).fields, *T.StructType.fromDDL("gq_first boolean, gq_last boolean, gq_text string, gq_tie long").fields])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def aside(doc, text, tie, is_first, is_last) -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), *none, pa.array([is_first]), pa.array([is_last]), pa.array([text]), pa.array([tie], pa.int64())], names=kind.names)

        def done(rows) -> pa.RecordBatch:
            got = compare(rows, first)
            return pa.RecordBatch.from_arrays([*got.columns, *(pa.nulls(len(rows), t) for t in (pa.bool_(), pa.bool_(), pa.string(), pa.int64()))], names=kind.names)

        last, rows, size, head = None, [], 0, None
        for b in batches:
            for doc, text, tie in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last is None:
                    head = (doc, text, tie)
                else:
                    rows.append((*last[:2], text))
                    size += len(text) + len(last[1])
                    if size >= CHUNK:
                        yield done(rows)
                        rows, size = [], 0
                last = (doc, text, tie)
        if rows:
            yield done(rows)
        if last is not None:
            yield aside(*head, True, False)
            yield aside(*last, False, True)

    out = ws.put(d.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").mapInArrow(pairs, kind), "pairs")
    inner = out.where("gq_last is null").select(*T.StructType.fromDDL(OUT).names)
    # At most two rows for each partition: the window's one task sees far fewer rows than any task above.
    edge = out.where("gq_last is not null")
    order = Window.orderBy("doc_id", "gq_tie", "gq_last")
    ends = edge.withColumn("gq_next", F.lead("gq_text").over(order)).withColumn("gq_zero", F.first("gq_text").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ends = ends.where("gq_last").select("doc_id", F.col("gq_text").alias("text"), F.coalesce("gq_next", "gq_zero").alias("next"))
    more = ends.mapInArrow(lambda batches: (compare(list(zip(*(c.to_pylist() for c in b.columns), strict=True)), first) for b in batches if b.num_rows), OUT)
    return inner.unionByName(more)

