"""Importance resampling of documents towards the word statistics of a target set.

Every document gets a weight, the mean gain of its hashed word runs, and a random
term of its own (the Gumbel trick), so that the highest scores are a weighted draw
without replacement. How many are drawn is known from a count; the last key that
is drawn is found by radix selection: the key (score, doc_id, row) is a string of
16-bit digits, and each pass counts one digit among the rows that share the digits
found so far. Rows above that key are drawn; only they are sorted.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoquill.llm.text import alnum_words
from geoquill.operators.ordering import running_totals
from geoquill.workspace import Workspace

BUCKETS = 10_000
DIGIT = 16


def buckets_of(text: bytes | None, n: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Words of a text, and the bucket of each feature: all words, then all pairs of neighbours joined by a space."""
    words = alnum_words(text)
    one = list(map(crc32, words))
    # crc32 goes on where it stopped: the first word, the space, the second word
    two = map(crc32, words[1:], map(crc32, repeat(b" "), one))
    return len(words), np.fromiter((*one, *two), np.int64, max(0, 2 * len(words) - 1)) % n


def bucket_counts(docs: DataFrame, n: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket; n numbers come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                total += np.bincount(buckets_of(text, n)[1], minlength=n)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["bucket", "n"])

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log ratio of each bucket's shares in target and source, one added to each count, rounded down."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """A thousand times a Gumbel variate that depends on seed and id alone, rounded down; a null id is the empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, keep: list[str], seed: int = 7) -> DataFrame:
    """keep plus gq_words, gq_features, gq_weight, gq_score and gq_row, a number of the row that no other has."""
    sent, n = docs.sparkSession.sparkContext.broadcast(gain), len(gain)
    more = "gq_words long, gq_features long, gq_weight long, gq_score long, gq_row long"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out = []
            for doc, text in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                words, at = buckets_of(text, n)
                weight = int(sent.value[at].sum()) // len(at) if len(at) else 0
                out.append((words, len(at), weight, weight + noise(seed, doc), row))
                row += 1
            cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *cols], names=[*b.schema.names[:-2], *(f.split()[0] for f in more.split(", "))])

    schema = T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL(more).fields])
    return docs.select(*keep, F.col("doc_id").cast("long").alias("gq_id"), F.col("text").cast("binary").alias("gq_text")).mapInArrow(score, schema)


def _digits(score: Column, doc_id: Column, row: Column) -> list[Column]:
    """Digits of the key, most significant first: high scores, then small ids (null before all), then rows come first."""
    out = [F.when(doc_id.isNull(), 0).otherwise(1)]
    low = F.lit(-(1 << 63))
    # the sign bit turned makes signed order unsigned; all bits of the score turned make it fall
    words = [F.bitwise_not(score.bitwiseXOR(low)), F.coalesce(doc_id.bitwiseXOR(low), F.lit(0).cast("long")), row]
    parts = [[F.shiftrightunsigned(w, s).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int") for s in range(64 - DIGIT, -1, -DIGIT)] for w in words]
    return [*parts[0], *out, *parts[1], *parts[2]]


def kth_key(keys: DataFrame, k: int) -> list[int]:
    """The digits of the k-th smallest key (k from 1) of the frame's columns, which are the digits; as many as decide.

    A pass counts one digit of the rows that are still in question: at most 65,536
    numbers come to the driver, whatever the table. Digits that all rows share are
    not counted. The list ends where every row with that beginning is drawn.
    """
    cols = keys.columns
    ends = keys.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    found: list[int] = []
    rest = keys
    for i, c in enumerate(cols):
        if ends[f"lo{i}"] == ends[f"hi{i}"]:
            found.append(ends[f"lo{i}"])
            continue
        rows = sorted((r[0], r[1]) for r in rest.groupBy(c).count().collect())
        for digit, n in rows:
            if k <= n:
                break
            k -= n
        found.append(digit)
        if k == n:
            break
        rest = rest.where(F.col(c) == digit)
    return found


def draw(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, seed: int = 7, keep: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """docs (all columns, or keep) plus gq_words, gq_features, gq_weight, gq_score and gq_rank: 1, 2, 3... of the drawn rows, null for the others.

    Of the N rows with at least least_words words, the floor(share * N / 100) highest
    scores are drawn; ties go to the smaller doc_id, null before all, then to either
    row. Null and empty texts have no features and weight 0. Rows that repeat are
    scored, counted and drawn each. Without target texts all gains come from the
    source alone; an empty docs gives no rows. Both tables are read as columns text
    and doc_id; names that begin with gq_ are reserved.
    """
    keep = docs.columns if keep is None else keep
    ws = Workspace(docs.sparkSession, "resample")
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = docs if "doc_id" in keep else docs.withColumn("gq_id", F.col("doc_id"))
    rows = ws.put(scored(rows, gain, keep if "doc_id" in keep else [*keep, "gq_id"], seed), "scored")
    doc = F.col("doc_id" if "doc_id" in keep else "gq_id").cast("long")
    fit = rows.where(F.col("gq_words") >= least_words)
    k = share * fit.count() // 100
    none = F.lit(None).cast("long").alias("gq_rank")
    out = [*keep, "gq_words", "gq_features", "gq_weight", "gq_score"]
    if not k:
        return rows.select(*out, none)
    digits = _digits(F.col("gq_score"), doc, F.col("gq_row"))
    last = kth_key(fit.select(*[d.alias(f"d{i}") for i, d in enumerate(digits)]), k)
    drawn = F.lit(True)  # at the last digit found, every row of it is drawn
    for digit, at in reversed(list(zip(digits, last, strict=False))):
        drawn = (digit < at) | ((digit == at) & drawn)
    drawn = (F.col("gq_words") >= least_words) & drawn
    order = {"gq_a": -F.col("gq_score"), "gq_b": doc}
    packed = rows.where(drawn).withColumns(order).select(F.struct(*out).alias("gq_all"), *order, "gq_row")
    top = running_totals(packed, ws, [*order, "gq_row"])
    return top.select("gq_all.*", (F.col("row_no") + 1).alias("gq_rank")).unionByName(rows.where(~drawn).select(*out, none))
