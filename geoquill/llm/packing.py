"""Packing by optimal length buckets.

The histogram of document lengths is summed up over all documents. Dynamic
programming chooses the bucket boundaries, each a length that occurs, for which
the tokens padded up to the boundary are fewest. Inside each bucket documents,
in order of id, fill batches whose padded size stays within a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquill.operators.ordering import running_totals
from geoquill.workspace import Workspace


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most `buckets` boundaries, ascending, the last being the greatest length, with the least padding.

    Ties go to the smaller boundary. Padding of one bucket satisfies the quadrangle
    inequality, so each row of the table is filled by divide and conquer.
    """
    order = np.argsort(lengths)
    x, c = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(x)
    if not n:
        return []
    docs, tokens = np.concatenate([[0], np.cumsum(c)]), np.concatenate([[0], np.cumsum(c * x)])

    def pad(i, j):
        """Lengths i to j - 1 in one bucket."""
        return x[j - 1] * (docs[j] - docs[i]) - (tokens[j] - tokens[i])

    best = pad(0, np.arange(1, n + 1))
    best = np.concatenate([[0], best])
    came = []
    for _ in range(1, min(buckets, n)):
        new, start = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            cost = best[i] + pad(i, mid)
            k = int(np.argmin(cost))
            new[mid], start[mid] = cost[k], i[k]
            todo += [(lo, mid - 1, a, int(i[k])), (mid + 1, hi, int(i[k]), b)]
        came.append(start)
        best = new
    out, j = [], n
    for start in reversed(came):
        out.append(int(x[j - 1]))
        j = int(start[j])
        if j == 0:
            break
    if j:
        out.append(int(x[j - 1]))
    return sorted(out)


def word_count(text: Column) -> Column:
    """Words that white space (space, U+0009 to U+000D) divides, plus one for the end; a null text has the end only."""
    return (F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")) + 1).cast("long")


def pack(docs: DataFrame, length: Column, buckets: int = 16, budget: int = 65_536, keep: list[str] | None = None) -> DataFrame:
    """keep columns (doc_id) plus n_tokens, bucket_length, batch, slot, batch_docs, padding.

    One row for each row of docs, repeated and null ids included. A document longer
    than the budget is a batch of its own; none is cut or dropped. Batches are
    numbered from 0 inside each bucket. The histogram that comes to the driver has
    one row for each length that occurs.
    """
    keep = keep or ["doc_id"]
    ws = Workspace(docs.sparkSession, "packing")
    d = ws.put(docs.select(*keep, length.cast("long").alias("n_tokens")), "lengths")
    hist = d.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).toArrow()
    x, c = hist.column("n_tokens").to_numpy(), hist.column("n").to_numpy()
    bounds = boundaries(x, c, buckets)
    bucket = F.expr(f"element_at(filter(array({','.join(f'{b}L' for b in bounds)}), b -> b >= n_tokens), 1)") if bounds else F.col("n_tokens")
    placed = running_totals(d.withColumn("bucket_length", bucket), ws, ["doc_id", "n_tokens"], ["bucket_length"])
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length"))).cast("long")
    total = d.withColumn("bucket_length", bucket).groupBy("bucket_length").agg(F.count(F.lit(1)).alias("gq_docs"))
    out = placed.join(total, "bucket_length").withColumn("gq_per", per)
    return out.select(
        *keep, "n_tokens", "bucket_length", F.floor(F.col("row_no") / F.col("gq_per")).cast("long").alias("batch"), (F.col("row_no") % F.col("gq_per")).alias("slot"),
        F.least(F.col("gq_per"), F.col("gq_docs") - F.floor(F.col("row_no") / F.col("gq_per")).cast("long") * F.col("gq_per")).alias("batch_docs"), (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
