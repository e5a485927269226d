"""Product quantisation: vectors as the numbers of their parts' nearest codebook entries.

Vectors are integers (each component times 256, rounded down), so distances are
exact and runs agree. Codebooks are refined in rounds: every part is assigned to
its nearest entry, then entries become the rounded mean of their parts. Only
codebooks, of fixed size, and their sums pass the driver.

The nearest entry is found by partial distances: the dimensions with the greatest
spread over the codebook come first, and an entry is dropped as soon as what it has
gathered exceeds the complete distance of the best entry so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquill.workspace import Workspace

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Integer components go up to this either way, so that distances and their sums stay exact in 64 bits.
MOST = 1 << 26
#: Vectors compared at once.
CHUNK = 2048


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Where each part begins and ends; equal parts where dim can be divided."""
    return [(i * dim // parts, (i + 1) * dim // parts) for i in range(parts)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of x the nearest row of book (ties: the first) and its squared distance, by partial distances."""
    n, dim = x.shape
    if not dim or not n:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-book.var(axis=0), kind="stable")
    x, book = x[:, order], book[:, order]
    sums = (x[:, :1] - book[:, 0]) ** 2
    # the entry that is nearest in the first dimension is completed first
    guess = sums.argmin(axis=1)
    best = ((x - book[guess]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= best[:, None])
    sums = sums[row, entry]
    for d in range(1, dim):
        sums = sums + (x[row, d] - book[entry, d]) ** 2
        alive = sums <= best[row]
        if d < dim - 1 and len(row) > 2 * n:
            # another one completed: the best of those left in each row, so that more can go
            row, entry, sums = row[alive], entry[alive], sums[alive]
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            low = np.minimum.reduceat(sums, first)
            at = np.flatnonzero(sums == np.repeat(low, np.diff(np.r_[first, len(row)])))
            r, e = row[at], entry[at]
            np.minimum.at(best, r, ((x[r] - book[e]) ** 2).sum(axis=1))
            alive = sums <= best[row]
        row, entry, sums = row[alive], entry[alive], sums[alive]
    first = np.full(n, len(row))
    # rows come in order, entries of a row too; the first that has the row's least distance wins
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    low = np.minimum.reduceat(sums, starts)
    hit = np.flatnonzero(sums == np.repeat(low, np.diff(np.r_[starts, len(row)])))
    np.minimum.at(first, row[hit], hit)
    return entry[first], sums[first]


def assign(x: np.ndarray, books: list[np.ndarray], ends: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """codes and distances, a column for each part."""
    got = [nearest(x[:, a:z], book) for (a, z), book in zip(ends, books, strict=True)]
    return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)


def usable(df: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is there and has only finite components, none of them null."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(F.col(column).isNotNull() & ~bad)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _refined(rows: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """Codebooks after one round. Each task sends one sum for each number of the codebooks, at most."""
    ends = bounds(dim, len(books))
    size = len(books[0])
    sent = rows.sparkSession.sparkContext.broadcast((books, ends))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, ends = sent.value
        sums, used = np.zeros((size, dim), np.int64), np.zeros((size, len(ends)), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, CHUNK):
                x = integers(_matrix(b.column(0).slice(i, CHUNK), dim))
                codes, _ = assign(x, books, ends)
                for p, (a, z) in enumerate(ends):
                    np.add.at(sums[:, a:z], codes[:, p], x[:, a:z])
                    used[:, p] += np.bincount(codes[:, p], minlength=size)
        flat = np.concatenate([sums.ravel(), used.ravel()])
        k = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(flat[k])], names=["k", "s"])

    got = rows.select("gq_vector").mapInArrow(add, "k long, s long").groupBy("k").agg(F.sum("s").alias("s")).toArrow()
    flat = np.zeros(size * (dim + len(ends)), np.int64)
    flat[got.column("k").to_numpy()] = got.column("s").to_numpy()
    sums, used = flat[: size * dim].reshape(size, dim), flat[size * dim :].reshape(size, len(ends))
    out = []
    for p, (a, z) in enumerate(ends):
        n = used[:, p : p + 1]
        out.append(np.where(n > 0, sums[:, a:z] // np.maximum(n, 1), books[p]))
    return out


def compress(df: DataFrame, vector: str = "embedding", key: str = "vec_id", keep: list[str] | None = None, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(keep plus gq_codes array<int> and gq_error long: the squared distances to its entries; the codebooks, one for each part).

    Rows whose vector is null, or has a null or non-finite component, are left out,
    and so are vectors of another length than the first's. The first entries are the
    vectors of the smallest keys (null last; of equal keys the smaller vectors), fewer
    than `entries` if there are fewer rows. Rows that repeat count and are coded each.
    Components beyond 2**26 / 256 count as that. An empty table gives no rows.
    """
    keep = [c for c in df.columns if c != vector] if keep is None else keep
    spark = df.sparkSession
    rows = usable(df, vector).select(*keep, F.col(key).alias("gq_key"), F.col(vector).cast("array<double>").alias("gq_vector"))
    seeds = rows.orderBy(F.col("gq_key").asc_nulls_last(), "gq_vector").select("gq_vector").limit(entries).collect()
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("gq_codes", T.ArrayType(T.IntegerType())), T.StructField("gq_error", T.LongType())])
    if not seeds:
        return spark.createDataFrame([], schema), [np.zeros((0, 0), np.int64)] * parts
    dim = len(seeds[0][0])
    rows = rows.where(F.size("gq_vector") == dim)
    first = integers(np.array([s[0] for s in seeds if len(s[0]) == dim], np.float64).reshape(-1, dim))
    if len(first) < len(seeds):
        more = rows.orderBy(F.col("gq_key").asc_nulls_last(), "gq_vector").select("gq_vector").limit(entries).collect()
        first = integers(np.array([s[0] for s in more], np.float64).reshape(-1, dim))
    ends = bounds(dim, parts)
    books = [first[:, a:z] for a, z in ends]
    for _ in range(rounds):
        books = _refined(rows, books, dim)
    sent = spark.sparkContext.broadcast((books, ends))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, CHUNK):
                s = b.slice(i, CHUNK)
                codes, errors = assign(integers(_matrix(s.column(s.num_columns - 1), dim)), *sent.value)
                at = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * parts)
                yield pa.RecordBatch.from_arrays([*s.columns[:-1], pa.ListArray.from_arrays(at, pa.array(codes.ravel().astype(np.int32))), pa.array(errors.sum(axis=1))], names=[*s.schema.names[:-1], "gq_codes", "gq_error"])

    return rows.select(*keep, "gq_vector").mapInArrow(code, schema), books


def hex_code(codes) -> F.Column:
    """Two hex digits for each code."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all components as decimals, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def with_group_sum(df: DataFrame, group: str, value: str, name: str, ws: Workspace, hot: int = 1000) -> DataFrame:
    """df plus the sum of value over the rows of equal group; null is a group.

    A group that holds a thousandth (1 / hot) of the rows or more is hot. There are at
    most `hot` of these, so their sums are broadcast, and their rows are not shuffled.
    The others are joined by group, none of which is large.
    """
    df = ws.put(df, "rows")
    sums = ws.put(df.groupBy(F.col(group).alias("gq_g")).agg(F.sum(value).cast("long").alias(name), F.count(F.lit(1)).alias("gq_n")), "sums")
    total = df.count()
    many = F.broadcast(sums.where(F.col("gq_n") * hot >= total).drop("gq_n").limit(hot))
    on = F.col(group).eqNullSafe(F.col("gq_g"))
    few = sums.where(F.col("gq_n") * hot < total).drop("gq_n")
    rest = df.join(many.select("gq_g"), on, "left_anti").join(few, on).drop("gq_g")
    return df.join(many, on).drop("gq_g").unionByName(rest)
