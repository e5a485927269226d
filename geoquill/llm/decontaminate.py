"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of `window` consecutive words (an item of fewer
words is one window). Every window is a set of word shingles. To be contained,
all of its shingles must occur, so one of them is a sufficient prefix: the one
that the fewest documents hold. Documents are joined with windows on that
shingle only; a length and position bound places the window inside the document;
then all its words are compared in place.

The windows are a stated query set: they are taken in blocks of at most
`block_words` words, so what goes to the executors has a fixed bound however
large the benchmark is. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.llm.text import alnum_words
from geoquill.workspace import Workspace

#: Words of a shingle; windows of fewer words have one shingle of all their words.
SHINGLE = 3
#: Words of documents that are handled at once.
CHUNK = 400_000
HIT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Index:
    """Windows of one block, as arrays of word numbers, with their items."""

    def __init__(self, items: list[tuple[int, bytes]], window: int):
        self.vocab: dict[bytes, int] = {}
        numbers = self.vocab.setdefault
        at: dict[tuple, int] = {}
        self.items: list[set[int]] = []
        for item, text in items:
            ids = tuple(numbers(w, len(self.vocab)) for w in alnum_words(text))
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                k = at.setdefault(ids[i : i + window], len(at))
                if k == len(self.items):
                    self.items.append(set())
                self.items[k].add(item)
        self.length = np.array([len(w) for w in at], np.int64)
        self.words = np.full((len(at), window), -1, np.int64)
        for k, w in enumerate(at):
            self.words[k, : len(w)] = w
        base = np.uint64(len(self.vocab) + 1)
        self.sizes = sorted({min(SHINGLE, n) for n in set(self.length.tolist())})
        # the base to the third power stays below 2**63 for up to two million words
        self.shingles: dict[int, np.ndarray] = {}
        self.of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for s in self.sizes:
            rows = np.flatnonzero(np.minimum(self.length, SHINGLE) == s)
            keys, win, off = [], [], []
            for o in range(window - s + 1):
                r = rows[self.length[rows] >= o + s]
                keys.append(pack(self.words[r, o : o + s].T, base))
                win.append(r)
                off.append(np.full(len(r), o))
            keys, win, off = np.concatenate(keys), np.concatenate(win), np.concatenate(off)
            self.shingles[s] = np.unique(keys)
            self.of[s] = (keys, win, off)
        self.base = base
        self.prefix: dict[int, tuple] = {}

    def choose(self, counts: dict[int, np.ndarray]) -> None:
        """Keep for each window its rarest shingle; windows with one that no document has can't occur."""
        for s in self.sizes:
            keys, win, off = self.of[s]
            n = counts[s][np.searchsorted(self.shingles[s], keys)]
            order = np.lexsort((off, n, win))
            first = order[np.unique(win[order], return_index=True)[1]]
            first = first[n[first] > 0]
            first = first[np.argsort(keys[first], kind="stable")]
            k, begin, number = np.unique(keys[first], return_index=True, return_counts=True)
            self.prefix[s] = (k, begin, number, win[first], off[first])
        self.of = {}


def pack(ids, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        out = out * base + x.astype(np.uint64)
    return out


def number_words(texts: list, index: Index) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word numbers of these rows one after another, bounds) for about CHUNK words at a time."""
    get, ids, ends, first, size = index.vocab.get, [], [0], 0, 0
    for i, text in enumerate(texts):
        w = alnum_words(text)
        ids.append(np.fromiter(map(get, w, repeat(-1)), np.int64, len(w)))
        size += len(w)
        ends.append(size)
        if size >= CHUNK or i + 1 == len(texts):
            yield first, i + 1, np.concatenate(ids), np.array(ends)
            ids, ends, first, size = [], [0], i + 1, 0


def found(ids: np.ndarray, ends: np.ndarray, s: int, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Places where a shingle of s known words inside one document begins, and their keys."""
    if len(ids) < s:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ok = ids[: len(ids) - s + 1] >= 0
    for j in range(1, s):
        ok &= ids[j : len(ids) - s + 1 + j] >= 0
    at = np.flatnonzero(ok)
    at = at[ends[np.searchsorted(ends, at, "right")] >= at + s]
    return at, pack([ids[at + j] for j in range(s)], index.base)


def count_shingles(docs: DataFrame, index: Index) -> dict[int, np.ndarray]:
    """In how many documents each shingle of the block occurs; one number for each shingle comes to the driver."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    total = sum(len(v) for v in index.shingles.values())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, n = sent.value, np.zeros(total, np.int64)
        for b in batches:
            for _, _, ids, ends in number_words(b.column(0).to_pylist(), ix):
                base = 0
                for s in ix.sizes:
                    at, keys = found(ids, ends, s, ix)
                    place = np.searchsorted(ix.shingles[s], keys)
                    place[place == len(ix.shingles[s])] = 0
                    hit = ix.shingles[s][place] == keys
                    doc = np.searchsorted(ends, at[hit], "right")
                    pairs = np.unique(doc * len(ix.shingles[s]) + place[hit])
                    n[base : base + len(ix.shingles[s])] += np.bincount(pairs % len(ix.shingles[s]), minlength=len(ix.shingles[s]))
                    base += len(ix.shingles[s])
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n[k])], names=["k", "n"])

    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(total, np.int64)
    n[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    sent.destroy()
    out, base = {}, 0
    for s in index.sizes:
        out[s] = n[base : base + len(index.shingles[s])]
        base += len(out[s])
    return out


def occurrences(ids: np.ndarray, ends: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Begin and window of every occurrence in a run of documents."""
    begins, wins = [], []
    for s in index.sizes:
        keys, begin, number, win, off = index.prefix[s]
        if not len(keys):
            continue
        at, got = found(ids, ends, s, index)
        place = np.searchsorted(keys, got)
        place[place == len(keys)] = 0
        hit = keys[place] == got
        at, place = at[hit], place[hit]
        n = number[place]
        which = np.repeat(begin[place], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start, w = np.repeat(at, n) - off[which], win[which]
        doc = np.searchsorted(ends, np.repeat(at, n), "right")
        fits = (start >= ends[doc - 1]) & (start + index.length[w] <= ends[doc])
        start, w = start[fits], w[fits]
        for j in range(index.words.shape[1]):
            same = (index.length[w] <= j) | (ids[np.minimum(start + j, len(ids) - 1)] == index.words[w, j])
            start, w = start[same], w[same]
        begins.append(start)
        wins.append(w)
    return (np.concatenate(begins), np.concatenate(wins)) if begins else (np.empty(0, np.int64), np.empty(0, np.int64))


def spans(texts: list, index: Index) -> Iterator[tuple[int, list[tuple[int, int]], set[int]]]:
    """For each text: its words, the merged spans of hit words, the items."""
    for first, end, ids, ends in number_words(texts, index):
        start, win = occurrences(ids, ends, index)
        doc = np.searchsorted(ends, start, "right") - 1
        order = np.lexsort((start, doc))
        by = np.searchsorted(doc[order], np.arange(end - first + 1))
        for i in range(end - first):
            merged: list[list[int]] = []
            items: set[int] = set()
            for k in order[by[i] : by[i + 1]]:
                a = int(start[k] - ends[i])
                z = a + int(index.length[win[k]])
                items |= index.items[win[k]]
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], z)
                else:
                    merged.append([a, z])
            yield int(ends[i + 1] - ends[i]), merged, items


def blocks(items: DataFrame, window: int, block_words: int) -> Iterator[Index]:
    """Items without id or words are no items. Rows come one block at a time."""
    own, size = [], 0
    for item, text in items.select("item_id", F.col("text").cast("binary")).where("item_id is not null and text is not null").toLocalIterator():
        own.append((item, bytes(text)))
        size += len(text) // 2 * (window if len(text) > 2 * window else 1)
        if size >= block_words * window:
            yield Index(own, window)
            own, size = [], 0
    if own:
        yield Index(own, window)


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = 1_000_000) -> DataFrame:
    """docs plus gq_words, gq_begin, gq_end (arrays: merged spans of hit words) and gq_items (ids of items that occur).

    One row for each row of docs, repeated rows and null ids included. A null or
    wordless text has no words and no hits; an empty benchmark hits nothing.
    """
    from pyspark.sql import types as T

    more = "gq_words long, gq_begin array<int>, gq_end array<int>, gq_items array<long>"
    ws = Workspace(docs.sparkSession, "decontaminate")
    out = None
    for index in blocks(items, window, block_words):
        index.choose(count_shingles(docs, index))
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = list(spans(b.column(b.num_columns - 1).to_pylist(), sent.value))
                cols = [pa.array([n for n, _, _ in got], pa.int64()), *(pa.array([[s[k] for s in m] for _, m, _ in got], pa.list_(pa.int32())) for k in (0, 1)), pa.array([sorted(x) for _, _, x in got], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *cols], names=[*b.schema.names[:-1], *("gq_words", "gq_begin", "gq_end", "gq_items")])

        schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(more).fields])
        hits = docs.withColumn("gq_text", F.col("text").cast("binary")).mapInArrow(search, schema)
        if out is None:
            out, first = hits, True
            continue
        # Further blocks: equal texts have equal hits, so these merge by text.
        rest = hits.where("size(gq_items) > 0").select(F.sha2(F.col("text").cast("binary"), 256).alias("gq_key"), F.col("gq_begin").alias("b"), F.col("gq_end").alias("e"), F.col("gq_items").alias("i")).groupBy("gq_key").agg(F.first(F.struct("b", "e", "i")).alias("x"))
        if first:
            out, first = ws.put(out, "block"), False
        both = out.withColumn("gq_key", F.sha2(F.col("text").cast("binary"), 256)).join(ws.put(rest, "rest"), "gq_key", "left")
        e = "array_sort(zip_with(concat(gq_begin, x.b), concat(gq_end, x.e), (b, e) -> named_struct('b', b, 'e', e)))"
        merged = f"aggregate({e}, cast(array() as array<struct<b:int,e:int>>), (a, s) -> case when size(a) > 0 and s.b <= element_at(a, -1).e then concat(slice(a, 1, size(a) - 1), array(named_struct('b', element_at(a, -1).b, 'e', greatest(element_at(a, -1).e, s.e)))) else concat(a, array(s)) end)"
        out = ws.put(
            both.withColumn("m", F.when(F.col("x").isNull(), F.expr("zip_with(gq_begin, gq_end, (b, e) -> named_struct('b', b, 'e', e))")).otherwise(F.expr(merged)))
            .withColumns({"gq_begin": F.col("m.b"), "gq_end": F.col("m.e"), "gq_items": F.when(F.col("x").isNull(), F.col("gq_items")).otherwise(F.array_sort(F.array_union("gq_items", F.col("x.i"))))})
            .drop("gq_key", "x", "m"),
            "block",
        )
    if out is None:
        none = Index([], window)
        return docs.withColumn("gq_text", F.col("text").cast("binary")).mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([n for n, _, _ in spans(b.column(b.num_columns - 1).to_pylist(), none)], pa.int64()), *(pa.array([[]] * b.num_rows, pa.list_(t)) for t in (pa.int32(), pa.int32(), pa.int64()))], names=[*b.schema.names[:-1], "gq_words", "gq_begin", "gq_end", "gq_items"]) for b in batches),
            T.StructType([*docs.schema.fields, *T.StructType.fromDDL(more).fields]),
        )
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = 1_000_000) -> DataFrame:
    """doc_id and figures of its hits, one row for each row of docs."""
    got = contaminated_spans(docs.select("doc_id", "text"), items, window, block_words)
    names = F.array_join(F.array_sort(F.transform("gq_items", lambda x: x.cast("string"))), ",")
    hit = F.expr("aggregate(zip_with(gq_end, gq_begin, (e, b) -> cast(e - b as long)), cast(0 as long), (a, x) -> a + x)")
    return got.select("doc_id", F.col("gq_words").alias("n_words"), hit.alias("n_hit"), F.size("gq_items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = 1_000_000) -> DataFrame:
    """Rows of docs, with their columns, that hold no window of any item."""
    return contaminated_spans(docs, items, window, block_words).where("size(gq_items) = 0").select(*docs.columns)
