"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its own hashed embedding beside the mean of the embeddings of
its character trigrams. Words of more than RUN bytes, such as text without spaces,
are read as pieces of PIECE characters, one from each character on. A window of WINDOW words is read forwards and backwards,
attention pools the states, and a logistic unit scores the pool. Windows overlap
by half and cover the whole text; a document scores as its worst window.

Training takes at most `sample` labelled documents of each class (those whose id
hashes lowest) and learns first from random windows under their document's label,
then from each document's highest-scoring window. Everything else covers all rows.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoquill.llm.text import alnum_words

WINDOW, STEP = 32, 16
WORDS, GRAMS, DIM, HIDDEN = 8192, 8192, 12, 12
#: Labelled documents of each class that are learned from, at most.
SAMPLE = 2000
THRESHOLD = 0.3
#: Bytes of a word, at most, and characters of the pieces of longer ones.
RUN, PIECE = 48, 2


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Vocabulary:
    """Numbers of the words met so far, and the rows of the embedding tables that they take; cleared when it grows past its bound."""

    BOUND = 200_000

    def __init__(self):
        self.word: dict[bytes, int] = {}
        self.row, self.gram, self.end = array("i"), array("i"), array("q", [0])

    def number(self, words: list[bytes]) -> np.ndarray:
        known, h = self.word, xxhash.xxh3_64_intdigest
        for w in dict.fromkeys(words):
            if w not in known:
                known[w] = len(known)
                s = b"^" + w + b"$"
                self.row.append(h(w) % WORDS)
                self.gram.extend([h(s[i : i + 3]) % GRAMS for i in range(max(1, len(s) - 2))])
                self.end.append(len(self.gram))
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def tables(self, first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word rows, trigram rows one after another, where each word's begin) of the words from number `first` on."""
        end = np.array(self.end[first:], np.int64)
        return np.array(self.row[first:], np.int64), np.array(self.gram[int(end[0]) :], np.int64), end - end[0]


def pieces(text: bytes | None) -> list[bytes]:
    """Words of the text; longer ones than RUN bytes as all their runs of PIECE characters."""
    out, words = [], alnum_words(text)
    if max(map(len, words), default=0) <= RUN:
        return words
    for w in words:
        if len(w) <= RUN:
            out.append(w)
        else:
            c = w.decode("utf-8", "replace")
            out += [c[i : i + PIECE].encode() for i in range(max(1, len(c) - PIECE + 1))]
    return out


def windows(numbers: np.ndarray | list[int]) -> np.ndarray:
    """Rows of WINDOW word numbers, -1 after the end; a text without words has one empty window."""
    n = len(numbers)
    rows = max(1, -(-(n - STEP) // STEP)) if n > WINDOW else 1
    padded = np.full((rows - 1) * STEP + WINDOW, -1, np.int32)
    padded[:n] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


class Model:
    """Parameters by name; forward() scores windows, step() learns from a batch."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * DIM
        self.p = {"word": r.normal(0, 0.1, (WORDS, DIM)), "gram": r.normal(0, 0.1, (GRAMS, DIM)), "att": r.normal(0, 0.3, 2 * h), "out": r.normal(0, 0.3, 2 * h), "bias": np.array([-1.0])}
        for way in "fb":
            self.p |= {f"{way}x": r.normal(0, 1 / np.sqrt(d), (d, 3 * h)), f"{way}h": r.normal(0, 1 / np.sqrt(h), (h, 3 * h)), f"{way}b": np.zeros(3 * h)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    def inputs(self, word: np.ndarray, gram: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = np.diff(at)
        return np.concatenate([self.p["word"][word], np.add.reduceat(self.p["gram"][gram], at[:-1], axis=0) / n[:, None]], axis=1) if len(word) else np.zeros((0, 2 * DIM), np.float32)

    def _run(self, way: str, gates: np.ndarray, x: np.ndarray, keep: bool):
        """States after each word, in reading order of the text. gates: for each word of the vocabulary, and a last row of zeros."""
        h, uh = HIDDEN, self.p[f"{way}h"]
        n, t = x.shape
        state, states, saved = np.zeros((n, h), np.float32), np.empty((t, n, h), np.float32), []
        for i in range(t) if way == "f" else range(t - 1, -1, -1):
            g, a = gates[x[:, i]], state @ uh
            zr = sigmoid(g[:, : 2 * h] + a[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            c = np.tanh(g[:, 2 * h :] + r * a[:, 2 * h :])
            new = c + z * (state - c)
            live = True if (x[:, i] >= 0).all() else (x[:, i] >= 0)[:, None]
            if live is not True:
                new = np.where(live, new, state)
            if keep:
                saved.append((i, state, z, r, c, a[:, 2 * h :], live))
            state = states[i] = new
        return states, saved

    def forward(self, emb: np.ndarray, x: np.ndarray, keep: bool = False):
        gates = {w: np.vstack([emb @ self.p[f"{w}x"] + self.p[f"{w}b"], np.zeros((1, 3 * HIDDEN), np.float32)]).astype(np.float32) for w in "fb"}
        runs = {w: self._run(w, gates[w], x, keep) for w in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        e = np.where(x.T >= 0, states @ self.p["att"], np.float32(-1e9))
        e = np.exp(e - e.max(axis=0))
        e = np.where(x.T >= 0, e, 0)
        weight = e / np.maximum(e.sum(axis=0), 1e-9)
        pool = (weight[:, :, None] * states).sum(axis=0)
        logit = pool @ self.p["out"] + self.p["bias"][0]
        return (logit, pool, weight, states, runs) if keep else logit

    def step(self, vocab: tuple, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One Adam step on the weighted log loss of windows x with labels y."""
        used, x0 = np.unique(x, return_inverse=True)
        x0 = x0.reshape(x.shape)
        if used[0] < 0:
            used, x0 = used[1:], x0 - 1
        if not len(used):
            return
        word, (gram, at) = vocab[0][used], _pick(vocab[1], vocab[2], used)
        emb = self.inputs(word, gram, at)
        logit, pool, att, states, runs = self.forward(emb, x0, True)
        h, g = HIDDEN, {}
        d = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g["out"], g["bias"] = pool.T @ d, np.array([d.sum()])
        d_pool = d[:, None] * self.p["out"]
        d_att = (states * d_pool).sum(axis=2)
        d_e = att * (d_att - (att * d_att).sum(axis=0))
        g["att"] = np.einsum("tn,tnh->h", d_e, states)
        d_states = att[:, :, None] * d_pool + d_e[:, :, None] * self.p["att"]
        d_emb = np.zeros_like(emb)
        for way, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            d_h, d_steps, d_u = np.zeros((len(x0), h), np.float32), np.empty((x0.shape[1], len(x0), 3 * h), np.float32), np.zeros((h, 3 * h), np.float32)
            for i, before, z, r, c, an, live in reversed(runs[way][1]):
                d_h = d_h + d_states[i][:, part]
                own = np.where(live, d_h, 0)
                d_c = own * (1 - z) * (1 - c * c)
                d_z = own * (before - c) * z * (1 - z)
                d_r = d_c * an * r * (1 - r)
                d_g = np.concatenate([d_z, d_r, d_c], axis=1)
                d_a = np.concatenate([d_z, d_r, d_c * r], axis=1)
                d_steps[i] = d_g
                d_u += before.T @ d_a
                d_h = np.where(live, own * z + d_a @ self.p[f"{way}h"].T, d_h)
            d_gates = _sums(x0.T.ravel(), d_steps.reshape(-1, 3 * h), len(emb))
            g[f"{way}h"], g[f"{way}x"], g[f"{way}b"] = d_u, emb.T @ d_gates, d_gates.sum(axis=0)
            d_emb += d_gates @ self.p[f"{way}x"].T
        n = np.diff(at)
        g["word"], g["gram"] = _sums(word, d_emb[:, :DIM], WORDS), _sums(gram, np.repeat(d_emb[:, DIM:] / n[:, None], n, axis=0), GRAMS)
        self.t += 1
        for k, v in g.items():
            self.m[k] += 0.1 * (v - self.m[k])
            self.v[k] += 0.001 * (v * v - self.v[k])
            self.p[k] -= (rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)

    def slim(self) -> Model:
        """Without what only training needs."""
        self.m = self.v = {}
        return self


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of values by their number at, 0 to n - 1; negative numbers count for nothing."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    order = np.argsort(at, kind="stable")
    order = order[np.searchsorted(at[order], 0) :]
    if len(order):
        own = at[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _pick(gram: np.ndarray, at: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = at[used + 1] - at[used]
    ends = np.cumsum(n)
    return gram[np.repeat(at[used] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], np.concatenate([[0], ends])


def train(texts: list[bytes], toxic: list[int], share: float | None = None, seed: int = 5, rounds: tuple[int, int] = (3, 4), batch: int = 256) -> Model | None:
    """A model from whole texts and their labels; None unless both labels occur.

    share: of toxic documents where the model will be used; by default that of the sample.
    """
    y = np.array(toxic, np.float32)
    if not 0 < y.sum() < len(y):
        return None
    r, vocab, model = np.random.default_rng(seed), Vocabulary(), Model(seed)
    rows = [windows(vocab.number(pieces(text))).astype(np.int32) for text in texts]
    at, x, tables = np.cumsum([0, *map(len, rows)]), np.concatenate(rows), vocab.tables()
    doc = np.repeat(np.arange(len(rows)), np.diff(at))
    # few documents are met more often, so that every run takes a similar number of steps
    again = max(1, round(1500 / len(y)))

    def learn(pick: np.ndarray, rate: float) -> None:
        r.shuffle(pick)
        for i in range(0, len(pick), batch):
            k = pick[i : i + batch]
            model.step(tables, x[k], y[doc[k]], np.ones(len(k), np.float32), rate)

    for _ in range(rounds[0] * again):
        learn(np.concatenate([r.choice(np.arange(a, z), min(8, z - a), False) for a, z in zip(at[:-1], at[1:], strict=True)]), 0.01)
    for k in range(rounds[1] * again):
        s = score_windows(model, tables, x)
        best = np.array([a + int(np.argmax(s[a:z])) for a, z in zip(at[:-1], at[1:], strict=True)])
        learn(np.concatenate([best, r.permutation(np.flatnonzero(y[doc] == 0))[: len(best)]]), 0.006 / (1 + k / again))
    if share is not None and 0 < share < 1:
        own = float(y.mean())
        model.p["bias"] += np.float32(np.log(share / (1 - share)) - np.log(own / (1 - own)))
    return model.slim()


class Gates:
    """What each word adds to the gates, ready for scoring: that is a constant once a model is trained.

    Update and reset gates are kept at half their size, as sigmoid(x) = (tanh(x / 2) + 1) / 2.
    """

    def __init__(self, model: Model, tables: tuple):
        self.model, h = model, HIDDEN
        self.into = {w: (0.5 * model.p[f"{w}h"][:, : 2 * h], np.ascontiguousarray(model.p[f"{w}h"][:, 2 * h :])) for w in "fb"}
        self.read = {w: np.stack([model.p[k][s] for k in ("att", "out")], axis=1) for w, s in (("f", slice(0, h)), ("b", slice(h, 2 * h)))}
        self.table = {w: (np.zeros((1, 2 * h), np.float32), np.zeros((1, h), np.float32)) for w in "fb"}
        self.add(tables)

    def add(self, tables: tuple) -> None:
        """More words; the last row stays that of no word."""
        emb, h = self.model.inputs(*tables), HIDDEN
        for w in "fb":
            g = (emb @ self.model.p[f"{w}x"] + self.model.p[f"{w}b"]).astype(np.float32)
            zr, c = self.table[w]
            self.table[w] = (np.concatenate([zr[:-1], 0.5 * g[:, : 2 * h], zr[-1:]]), np.concatenate([c[:-1], g[:, 2 * h :], c[-1:]]))

    def score(self, x: np.ndarray, batch: int = 2048) -> np.ndarray:
        """Logits of windows; those with all words apart from those that end early."""
        out, whole = np.empty(len(x), np.float32), x[:, -1] >= 0
        for k in (np.flatnonzero(whole), np.flatnonzero(~whole)):
            for i in range(0, len(k), batch):
                out[k[i : i + batch]] = self._logits(x[k[i : i + batch]])
        return out

    def _logits(self, x: np.ndarray) -> np.ndarray:
        h, x = HIDDEN, np.ascontiguousarray(x.T)
        t, n = x.shape
        live, att, value = x >= 0, np.zeros((t, n), np.float32), np.zeros((t, n), np.float32)
        some = ~live.all(axis=1)
        for w in "fb":
            (zr_of, c_of), (u_zr, u_c) = self.table[w], self.into[w]
            state = np.zeros((n, h), np.float32)
            for i in range(t) if w == "f" else range(t - 1, -1, -1):
                zr = zr_of.take(x[i], axis=0, mode="wrap")
                zr += state @ u_zr
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                a = state @ u_c
                a *= zr[:, h:]
                a += c_of.take(x[i], axis=0, mode="wrap")
                np.tanh(a, out=a)
                new = state - a
                new *= zr[:, :h]
                new += a
                state = np.where(live[i][:, None], new, state) if some[i] else new
                both = state @ self.read[w]
                att[i] += both[:, 0]
                value[i] += both[:, 1]
        att[~live] = -1e9
        e = np.exp(att - att.max(axis=0))
        e *= live
        return (e * value).sum(axis=0) / np.maximum(e.sum(axis=0), 1e-9) + self.model.p["bias"][0]


def score_windows(model: Model, tables: tuple, x: np.ndarray, chunk: int = 32_768) -> np.ndarray:
    """Logits of all windows x of words that tables describe, some at a time: a chunk needs the gates of its own words only."""
    out = np.zeros(len(x))
    for i in range(0, len(x), chunk):
        used, own = np.unique(x[i : i + chunk], return_inverse=True)
        own = own.reshape(-1, x.shape[1])
        if used[0] < 0:
            used, own = used[1:], own - 1
        gram, at = _pick(tables[1], tables[2], used)
        out[i : i + chunk] = Gates(model, (tables[0][used], gram, at)).score(own)
    return out


def score_texts(model: Model | None, texts: list[bytes | None], vocab: Vocabulary, gates: list[Gates] | None = None) -> np.ndarray:
    """The score of each text's worst window, 0 to 1; without a model, 0. gates: kept along with vocab from call to call."""
    if model is None or not texts:
        return np.zeros(len(texts))
    gates = [] if gates is None else gates
    out, once = np.empty(len(texts)), {}
    place = [once.setdefault(text or b"", len(once)) for text in texts]
    texts, score = list(once), np.empty(len(once))
    first, rows, size = 0, [], 0
    for i, text in enumerate(texts):
        rows.append(windows(vocab.number(pieces(text))))
        size += len(rows[-1])
        if size >= 8192 or i + 1 == len(texts):
            if not gates:
                gates.append(Gates(model, vocab.tables()))
            else:
                gates[0].add(vocab.tables(len(gates[0].table["f"][0]) - 1))
            s = gates[0].score(np.concatenate(rows))
            score[first : i + 1] = np.maximum.reduceat(s, np.cumsum([0, *map(len, rows)])[:-1])
            first, rows, size = i + 1, [], 0
            if len(vocab.word) > vocab.BOUND:
                vocab.__init__()
                gates.clear()
    out[:] = score[place]
    return sigmoid(out)


def held_out() -> Column:
    return (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2).alias("held_out")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 5) -> Model | None:
    """Learn from labelled documents outside the held-out fold, at most `sample` of each class.

    Labels without id or toxic are ignored; of repeated ones the greatest counts.
    """
    own = labels.where("doc_id is not null and toxic is not null").select("doc_id", "toxic").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # labels of other tables' documents take no place in the sample
    own = own.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = (F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
    of = own.agg(F.avg((F.col("toxic") > 0).cast("double")).alias("share")).first()
    few = own.where("toxic > 0").orderBy(*order).limit(sample).unionByName(own.where("toxic <= 0").orderBy(*order).limit(sample))
    # two times `sample` ids at most; their texts meet in one task of an executor, which returns the parameters
    got = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("text is not null").join(F.broadcast(few), "doc_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            toxic += [int(x > 0) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(texts, toxic, of.share, seed))], pa.binary())], names=["model"])

    rows = got.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic").mapInArrow(learn, "model binary").collect()
    return pickle.loads(rows[0].model) if rows else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs plus gq_score. Null and empty texts are scored as one window without words."""
    from pyspark.sql import types as T

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, gates = Vocabulary(), []
        for b in batches:
            s = score_texts(sent.value, b.column(b.num_columns - 1).to_pylist(), vocab, gates)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())], names=[*b.schema.names[:-1], "gq_score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("gq_score", T.DoubleType())])
    return docs.withColumn("gq_text", F.col("text").cast("binary")).mapInArrow(look, schema)


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; one row for each row of docs, null and repeated ids included."""
    d = docs.select("doc_id", "text")
    return score(d, fit(d, labels, sample)).select("doc_id", held_out(), F.col("gq_score").alias("score"), (F.col("gq_score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Rows of docs, with their columns, that score below THRESHOLD."""
    return score(docs, fit(docs, labels, sample)).where(F.col("gq_score") < THRESHOLD).select(*docs.columns)
