"""Passages that an earlier document has already: found by automata of words, removed.

1. A window of words is hashed by its minimizer, the least hash of its short runs.
   Equal windows have equal minimizers, and neighbours mostly share theirs, so few
   keys stand for all windows. Keys that two documents hold are kept with the first
   document that holds them, their home.
2. Documents are cut into pieces: runs of windows whose keys have one home. Equal
   windows have one home, so all that can match meets there.
3. Windows of the pieces are counted by hash; those that two documents hold are
   recurring, with the first document that holds them.
4. For each shard of homes, the recurring windows are taken from their first
   documents, word by word, and compiled to an Aho-Corasick automaton over word
   numbers; a home with many windows has several automata.
5. All pieces stream through the automata of their shard and report where a window
   of an earlier document occurs. The pieces of a shard that many documents meet are
   dealt to several tasks.
6. The reported spans go back to their documents and the covered words are removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoquill.workspace import Workspace

#: Words of the runs whose least hash is a window's key; at most half a window.
RUN = 5
#: Windows of one automaton, about, and words that stream through one at a time.
SHARD, LOAD = 50_000, 250_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of anything but space and U+0009 to U+000D, unchanged."""
    return text.split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rolled(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of each run of k words."""
    n, base, out = len(h) - k + 1, _ODD + np.uint64(2 * seed), None
    for j in range(k):
        part = h[j : j + n]
        out = part.copy() if out is None else out * base + part
    return _mixed(out)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
#: Bytes hashed at once, and powers of an odd number for places in words of up to so many bytes.
CHUNK = 1 << 20
_POWERS = np.cumprod(np.full(1 << 12, np.uint64(0xD6E8FEB86659FD93)))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, hash) of each word, in whole arrays: a word is the sum of its bytes' numbers times powers by their place."""
    out: list[tuple[np.ndarray, ...]] = []
    at = 0
    while at < len(text):
        to = at + CHUNK
        if to < len(text):
            # words aren't divided
            space = [p for p in (text.find(c, to) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0]
            to = min(space, default=len(text))
        a = np.frombuffer(text, np.uint8, min(to, len(text)) - at, at)
        blank = _SPACE[a]
        edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        begin, end = edge[::2], edge[1::2]
        if len(begin):
            size = end - begin
            first = np.cumsum(size) - size
            place = np.arange(size.sum()) - np.repeat(first, size)
            powers = _POWERS if size.max() <= len(_POWERS) else np.cumprod(np.full(size.max(), _POWERS[0]))
            h = np.add.reduceat(_BYTE[a[~blank]] * powers[place], first)
            out.append((begin + at, end + at, _mixed(h + size.astype(np.uint64))))
        at = to
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if len(out) > 1 else out[0]


def window_hashes(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, hash) of each window of words with these hashes, as signed 64-bit numbers; both depend on the window's words alone."""
    if len(h) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    run = min(RUN, (window + 1) // 2)
    low, span = _rolled(h, run, 1), 1
    want = window - run + 1
    while span < want:
        step = min(span, want - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return low.view(np.int64), _rolled(h, window, 2).view(np.int64)


def _keyed(docs: DataFrame, window: int) -> DataFrame:
    """(key, doc_id, gq_text_hash), once for each document and key of a batch."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n = [], []
            for text in b.column(2).to_pylist():
                k = window_hashes(word_hashes(text)[2], window)[0]
                k = np.unique(k[np.flatnonzero(np.r_[True, k[1:] != k[:-1]])]) if len(k) else k
                out.append(k)
                n.append(len(k))
            at = np.repeat(np.arange(b.num_rows), n)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*out, np.empty(0, np.int64)])), b.column(0).take(take), b.column(1).take(take)], names=["key", "doc_id", "gq_text_hash"])

    return docs.mapInArrow(keys, "key long, doc_id long, gq_text_hash long")


def _pieces(docs: DataFrame, window: int) -> DataFrame:
    """(home, doc_id, gq_text_hash, at, words, hashes): runs of windows with one home, from word `at`, and the hash of each window; docs has the keys of the document and their homes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            hashes = [np.empty(0, np.int64)]
            known = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in b.columns[3:]]
            for i, (doc, th, text) in enumerate(zip(*(c.to_pylist() for c in b.columns[:3]), strict=True)):
                begin, end, h = word_hashes(text)
                keys, own = window_hashes(h, window)
                have, homes = (v[at[i] : at[i + 1]] for at, v in known)
                if not len(keys) or not len(have):
                    continue
                order = np.argsort(have)
                have, homes = have[order], homes[order]
                place = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit, home = have[place] == keys, homes[place]
                turn = np.flatnonzero(np.r_[True, (hit[1:] != hit[:-1]) | (hit[1:] & (home[1:] != home[:-1]))])
                for a, z in zip(turn.tolist(), [*turn[1:].tolist(), len(keys)], strict=True):
                    if hit[a]:
                        rows.append((int(home[a]), doc, th, a, text[begin[a] : end[z + window - 2]]))
                        hashes.append(own[a:z])
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            ends = np.cumsum([len(h) for h in hashes]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(hashes)))], names=["home", "doc_id", "gq_text_hash", "at", "words", "hashes"])

    return docs.mapInArrow(cut, "home long, doc_id long, gq_text_hash long, at long, words binary, hashes array<long>")


class Automaton:
    """Windows of words with the id of the first document that holds each.

    A passage is cut into blocks of (window + 1) // 2 words; every window of it holds
    at least one of these whole, so blocks are the patterns: where one is found, its
    surroundings are compared. A block that several places of passages share already is
    not listed for more; windows around such are patterns themselves. The automaton
    reads one letter for each word, of an alphabet of 128, so that nodes have few
    children to try. All that it finds is confirmed word by word.
    """

    #: Places that a block is listed for.
    SHARED = 8

    def __init__(self, passages: list[tuple[int, bytes]], window: int):
        """passages: first document, and words of which every window is a pattern; at least one window."""
        self.window, self.block = window, (window + 1) // 2
        self.passages = [(first, words_of(text)) for first, text in passages]
        patterns: dict[str, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.passages):
            letters = _letters(words)
            for p in range(0, len(words) - self.block + 1, self.block):
                places = patterns.setdefault(letters[p : p + self.block], [])
                if len(places) < self.SHARED or window == self.block:
                    places.append((k, p))
                else:
                    for o in range(max(0, p + self.block - window), min(p, len(words) - window) + 1):
                        patterns.setdefault(letters[o : o + window], []).append((k, o))
        self.machine = ahocorasick.Automaton()
        for letters, places in patterns.items():
            self.machine.add_word(letters, (len(letters), places))
        self.machine.make_automaton()

    def covered(self, text: bytes, doc: int) -> list[list[int]]:
        """[begin, end) of words that windows of earlier documents cover, merged."""
        words, window = words_of(text), self.window
        spans: list[list[int]] = []
        for at, (size, places) in self.machine.iter(_letters(words)):
            begin, end, more = at + 1 - size, at + 1, window - size
            for k, p in places:
                first, own = self.passages[k]
                if first >= doc or words[begin:end] != own[p : p + size]:
                    continue
                q = p + size
                left = right = 0
                while left < min(more, begin, p) and words[begin - left - 1] == own[p - left - 1]:
                    left += 1
                while right < more and end + right < len(words) and q + right < len(own) and words[end + right] == own[q + right]:
                    right += 1
                if left + right >= more:
                    spans.append([begin - left, end + right])
        spans.sort()
        out: list[list[int]] = []
        for s in spans:
            if out and s[0] <= out[-1][1]:
                out[-1][1] = max(out[-1][1], s[1])
            else:
                out.append(s)
        return out


def _letters(words: list[bytes]) -> str:
    return (np.fromiter(map(crc32, words), np.uint32, len(words)) & 127).astype(np.uint8).tobytes().decode("ascii")


def _compile(window: int):
    """For one shard: windows (hash, first document) and pieces of first documents, to passages that hold each window once."""

    def passages(windows: pa.Table, pieces: pa.Table) -> pa.Table:
        first_of = dict(zip(windows.column("hash").to_pylist(), windows.column("first_id").to_pylist(), strict=True))
        shard = windows.column("shard")[0].as_py() if windows.num_rows else None
        rows = []
        for doc, text, hashes in zip(*(pieces.column(c).to_pylist() for c in ("doc_id", "words", "hashes")), strict=True):
            if not first_of:
                break
            new = [i for i, h in enumerate(hashes) if first_of.get(h) == doc and first_of.pop(h) == doc]
            words = words_of(text) if new else []
            begin = 0
            for j in range(1, len(new) + 1):
                if j == len(new) or new[j] != new[j - 1] + 1:
                    rows.append((doc, b" ".join(words[new[begin] : new[j - 1] + window])))
                    begin = j
        return pa.table({"shard": pa.array([shard] * len(rows), pa.int64()), "first_id": pa.array([r[0] for r in rows], pa.int64()), "passage": pa.array([r[1] for r in rows], pa.binary())})

    return passages


def _locate(window: int):
    """For one shard and one share of its pieces: where windows of earlier documents occur."""

    def spans(passages: pa.Table, pieces: pa.Table) -> pa.Table:
        rows = []
        if passages.num_rows and pieces.num_rows:
            machine = Automaton(list(zip(passages.column("first_id").to_pylist(), passages.column("passage").to_pylist(), strict=True)), window)
            for doc, th, at, text in zip(*(pieces.column(c).to_pylist() for c in ("doc_id", "gq_text_hash", "at", "words")), strict=True):
                rows += [(doc, th, at + b, at + e) for b, e in machine.covered(text, doc)]
        return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(("doc_id", "gq_text_hash", "begin", "end"))})

    return spans


def repeated_spans(docs: DataFrame, window: int = 13, ws: Workspace | None = None) -> DataFrame:
    """(doc_id, gq_text_hash, spans array<struct<begin, end>>): words of each document that windows of smaller doc_ids cover.

    Documents without any aren't there. gq_text_hash is xxhash64 of the text: rows of equal id and text share their spans.
    """
    ws = ws or Workspace(docs.sparkSession, "repeats")
    own = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("gq_text_hash"), F.col("text").cast("binary").alias("text"))
    keyed = ws.put(_keyed(own, window), "keyed")
    homes = ws.put(keyed.groupBy("key").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).where("home < last").select("key", "home"), "homes")
    known = keyed.join(homes, "key").groupBy("doc_id", "gq_text_hash").agg(F.collect_set(F.struct("key", "home")).alias("known"))
    known = ws.put(known.select("doc_id", "gq_text_hash", F.col("known.key").alias("keys"), F.col("known.home").alias("homes")), "known")
    ws.drop(homes, keyed)
    pieces = ws.put(_pieces(own.join(known, ["doc_id", "gq_text_hash"]).select("doc_id", "gq_text_hash", "text", "keys", "homes"), window), "pieces")
    ws.drop(known)
    windows = pieces.select("home", "doc_id", F.explode("hashes").alias("hash")).groupBy("home", "hash").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last")).where("first_id < last").drop("last")
    windows = ws.put(windows, "windows")
    shards = max(1, windows.count() // SHARD)
    # homes with more windows than an automaton should hold have several, and their pieces meet each of these; so many homes at most as there are shards
    many = ws.put(windows.groupBy("home").agg((F.count(F.lit(1)) / SHARD).cast("long").alias("more")).where("more > 0"), "many")
    shard = lambda part: F.pmod(F.xxhash64("home", part), F.lit(shards))
    windows = windows.join(many, "home", "left").withColumn("part", F.pmod("hash", F.coalesce("more", F.lit(0)) + 1))
    firsts = windows.select("home", F.col("first_id").alias("doc_id")).distinct()
    meets = pieces.join(many, "home", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("more", F.lit(0).cast("long")))))
    meets = meets.select("home", shard(F.col("part")).alias("shard"), "doc_id", "gq_text_hash", "at", "words", "hashes")
    by = windows.select(shard(F.col("part")).alias("shard"), "hash", "first_id").groupBy("shard")
    passages = ws.put(by.cogroup(meets.join(firsts, ["home", "doc_id"], "left_semi").select("shard", "doc_id", "words", "hashes").groupBy("shard")).applyInArrow(_compile(window), "shard long, first_id long, passage binary"), "passages")
    # how many shares a shard's pieces are dealt to
    loads = ws.put(meets.groupBy("shard").agg((F.sum(F.size("hashes")) / LOAD).cast("long").alias("shares")).where("shares > 0"), "loads")
    last = F.coalesce("shares", F.lit(0).cast("long"))
    share = F.pmod(F.xxhash64("doc_id", "gq_text_hash", "at"), last + 1)
    dealt = meets.join(loads, "shard", "left").withColumn("share", share).select("shard", "share", "doc_id", "gq_text_hash", "at", "words")
    copies = passages.join(loads, "shard", "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), last))).select("shard", "share", "first_id", "passage")
    found = copies.groupBy("shard", "share").cogroup(dealt.groupBy("shard", "share")).applyInArrow(_locate(window), "doc_id long, gq_text_hash long, begin long, end long")
    spans = ws.put(found.groupBy("doc_id", "gq_text_hash").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "spans")
    ws.drop(pieces, windows, passages)
    return spans


def without_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """docs plus gq_words, gq_removed and gq_kept: words, words removed, and the words kept, joined by one space.

    A word is removed where a window of so many consecutive words covers it whose
    words also begin somewhere in a document with a smaller doc_id; all windows are
    those of the input. Null texts have no words. Rows without id lose nothing and
    take nothing from others; rows of one id don't count as earlier than each other,
    and each row stays.
    """
    spans = repeated_spans(docs, window)
    row = docs.withColumn("gq_text_hash", F.when(F.col("doc_id").isNotNull(), F.xxhash64("text"))).withColumn("gq_doc", F.col("doc_id"))
    spans = spans.withColumnRenamed("doc_id", "gq_doc")
    names = docs.columns
    schema = docs.select("*", F.lit(0).cast("long").alias("gq_words"), F.lit(0).cast("long").alias("gq_removed"), F.lit("").alias("gq_kept")).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, kept = [], [], []
            for text, gone in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                words = words_of(text)
                n.append(len(words))
                if gone:
                    stay = np.ones(len(words), bool)
                    for s in gone:
                        stay[s["begin"] : s["end"]] = False
                    words = [words[i] for i in np.flatnonzero(stay)]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*names, "gq_words", "gq_removed", "gq_kept"])

    return row.join(spans, ["gq_doc", "gq_text_hash"], "left").select(*names, F.col("text").cast("binary").alias("gq_text"), "spans").mapInArrow(cut, schema)
