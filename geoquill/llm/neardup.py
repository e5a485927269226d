"""Near-duplicate documents by SetSketch registers.

A register keeps, of all shingles, the smallest of exponentially distributed hash
values, truncated to a power of BASE: registers of a union are the larger of two,
and the chance that two sets agree in one is close to their Jaccard similarity.
Bands of ROWS registers are bucket keys. For a candidate pair the similarity is
estimated by maximum likelihood from how many registers are larger, smaller and
equal, given both set sizes; what may reach the threshold is confirmed on the full
sets. Documents with equal sets are one node throughout.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.llm.buckets import groups, mostly_of
from geoquill.llm.text import space_words
from geoquill.workspace import Workspace

BASE, RATE = 1.1, 20.0
ROWS, BANDS = 7, 36
#: Registers: those of the bands, and more for the estimate.
BANDED = ROWS * BANDS
REGISTERS = 3 * BANDED
_MULT = np.random.default_rng(20).integers(1, 2**31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)
_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: Standard errors of the estimate by which a pair may fall short of the threshold and still be confirmed.
SLACK = 4.0


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of k-word shingles; of all words where there are fewer; empty without words."""
    words = space_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    x = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        x = (x ^ (x >> np.uint64(31))) * _P[0] + h[j : j + len(x)]
    x = (x ^ (x >> np.uint64(30))) * _P[1]
    x = (x ^ (x >> np.uint64(27))) * _P[2]
    return np.unique(x ^ (x >> np.uint64(31)))


def registers(keys: np.ndarray) -> np.ndarray:
    low, keys = np.full(REGISTERS, 2**32 - 1, np.uint32), (keys >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(keys), 256):
        np.minimum(low, (keys[i : i + 256, None] * _MULT).min(axis=0), out=low)
    value = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, 255).astype(np.uint8)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One key for each band: its registers and its number, side by side in 62 bits."""
    out = np.arange(BANDS, dtype=np.int64)
    for column in regs[:BANDED].reshape(BANDS, ROWS).T:
        out = (out << 8) | column
    return out


def first_band(a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    """Whether the band of key is the first that signatures a and b share."""
    equal = (a[:, 4 : 4 + BANDED] == b[:, 4 : 4 + BANDED]).reshape(len(a), BANDS, ROWS).all(axis=2)
    return equal.argmax(axis=1) == key >> 8 * ROWS


def estimate(n_a: np.ndarray, n_b: np.ndarray, larger: np.ndarray, smaller: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from set sizes and the registers that are larger and smaller in a."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = chance(u - v * j), chance(v - u * j)
        rest = np.maximum(1 - p - q, 1e-12)
        return larger * np.log(np.maximum(p, 1e-12)) + smaller * np.log(np.maximum(q, 1e-12)) + (m - larger - smaller) * np.log(rest)

    golden = (np.sqrt(5) - 1) / 2
    for _ in range(24):
        x, y = hi - golden * (hi - lo), lo + golden * (hi - lo)
        up = likelihood(x) < likelihood(y)
        lo, hi = np.where(up, x, lo), np.where(up, hi, y)
    return (lo + hi) / 2


def _signature(n: int, regs: np.ndarray) -> bytes:
    return np.array([n], "<u4").tobytes() + regs.tobytes()


def plausible(percent: int):
    """Whether two signatures may have the similarity, SLACK standard errors taken off, and set sizes that allow it.

    Sets of that similarity agree in a register with a chance that hardly depends
    on their sizes, so pairs with too few equal registers need no estimate.
    """
    t = percent / 100
    equal = 1 + 2 * np.log1p(-(1 - t) / 2 * (BASE - 1) / BASE) / np.log(BASE) - 0.01
    least = [m * equal - (SLACK + 1) * np.sqrt(m * equal * (1 - equal)) for m in (BANDED, REGISTERS)]
    cut = t - SLACK * np.sqrt(t * (1 - t) / REGISTERS)

    def may(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n_a, n_b = (np.ascontiguousarray(x[:, :4]).view("<u4")[:, 0].astype(np.float64) for x in (a, b))
        at = np.flatnonzero(np.minimum(n_a, n_b) >= t * np.maximum(n_a, n_b))
        at = at[(a[at, 4 : 4 + BANDED] == b[at, 4 : 4 + BANDED]).sum(axis=1) >= least[0]]
        ra, rb = a[at, 4:], b[at, 4:]
        enough = (ra == rb).sum(axis=1) >= least[1]
        at, ra, rb = at[enough], ra[enough], rb[enough]
        out = np.zeros(len(a), bool)
        if len(at):
            out[at] = estimate(n_a[at], n_b[at], (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)) >= cut
        return out

    return may


def confirm(percent: int):
    def same(a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= percent * (len(a) + len(b) - both)

    return same


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked to it, itself included), kept: one row for each row of docs.

    Documents link where 100 * intersection >= percent * union of their shingle
    sets. Texts without words link with nothing. Rows that repeat a doc_id are
    judged by their own text; null ids count for nothing as component_id, and a
    row without id is kept only where no document of its component has one.
    """
    return _marked(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _row_key():
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit("")))


def _marked(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    ws = Workspace(docs.sparkSession, "neardup")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(2).to_pylist():
                keys = shingle_set(text, shingle)
                if len(keys):
                    node = int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "little", signed=True)
                    rows.append((len(keys), node, _signature(len(keys), registers(keys))))
                else:
                    rows.append((0, None, None))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["doc_id", "row_key", "n_shingles", "node", "sig"])

    d = ws.put(docs.select("doc_id", _row_key().alias("row_key"), F.col("text").cast("binary").alias("text")).mapInArrow(sketch, "doc_id long, row_key long, n_shingles long, node long, sig binary"), "sketches")
    nodes = ws.put(d.where("node is not null").groupBy(F.col("node").alias("id")).agg(F.min("row_key").alias("row_key"), F.first("sig").alias("sig")), "nodes")
    # signatures are most of the table, and those of the nodes are enough
    marks = ws.put(d.select("doc_id", "row_key", "n_shingles", "node"), "marks")
    ws.drop(d)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                k = np.stack([band_keys(np.frombuffer(s, np.uint8)[4:]) for s in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], names=["key", "id"])

    members = nodes.select("id", "sig").mapInArrow(keys, "key long, id long")

    def texts(ids: DataFrame) -> DataFrame:
        want = ws.put(nodes.select("row_key", "id").join(ids, "id", "left_semi"), "wanted")
        return mostly_of(docs.select(_row_key().alias("row_key"), F.col("text").cast("binary").alias("payload")), "row_key", want).join(want, "row_key")

    comp = groups(ws, members, nodes, texts, plausible(percent), lambda t: shingle_set(t, shingle), confirm(percent), first=first_band)
    of = marks.join(comp.withColumnRenamed("id", "node"), "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = of.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("least"))
    out = of.join(least, "c", "left").withColumn("component_id", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of docs, with their columns, whose document is kept: one document of each component."""
    kept = _marked(docs, shingle, percent).where("kept").select(F.col("row_key").alias("gq_row_key")).distinct()
    return docs.withColumn("gq_row_key", _row_key()).join(kept, "gq_row_key", "left_semi").drop("gq_row_key")
