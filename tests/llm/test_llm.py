"""Operators for training data against brute force on small tables, with nulls, empty texts, ties and repeated rows."""

import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from geoquill.llm import archives, buckets, conversations, decontaminate, fingerprints, katz, lines, neardup, packing, token_files, toxicity
from geoquill.llm.text import alnum_words, space_words
from geoquill.workspace import Workspace

DOC = "doc_id long, text string, n_words int"  # n_words: an extra column whose name clashes
ODD = [(1, "", 0), (2, None, 0), (None, "a b", 0), (None, None, 0), (9, "x " * 3000, 1), (9, "x " * 3000, 1)]


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0) if len(r) == 2 else r for r in rows], DOC)


def key(r):
    return tuple(str(x) for x in r)


# --- words -----------------------------------------------------------------------------------


def test_words_follow_the_patterns():
    text = "Äpfel, I'M 7x  yé\tZ\x0bq\x1cr \U0001f600"
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    assert [w.decode() for w in alnum_words(text.encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    assert [w.decode() for w in space_words(text.encode())] == re.findall(r"[^\x20\x09-\x0D]+", lower)


# --- decontamination -------------------------------------------------------------------------


def brute_contamination(rows, items, window):
    out = []
    for doc, text, *_ in rows:
        w = alnum_words((text or "").encode())
        hit, names = set(), set()
        for item, t in items:
            iw = alnum_words((t or "").encode())
            if item is None or not iw:
                continue
            for i in range(max(1, len(iw) - window + 1)):
                x = iw[i : i + window]
                for k in range(len(w) - len(x) + 1):
                    if w[k : k + len(x)] == x:
                        hit |= set(range(k, k + len(x)))
                        names.add(str(item))
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 12])
def test_contamination(spark, block_words):
    r = random.Random(1)
    say = lambda n: " ".join(r.choice("a b c d e".split()) for _ in range(n))
    items = [(k, say(r.choice([1, 2, 3, 5, 9]))) for k in range(8)] + [(8, None), (9, ""), (None, "a"), (3, say(4))]
    rows = [(k, say(r.randrange(40))) for k in range(30)] + ODD
    items = [(i, t) for i, t in items if t is None or len(t.split()) != 1] + [(20, "Q")]
    got = decontaminate.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), 4, block_words)
    assert sorted(map(key, (tuple(x) for x in got.collect()))) == sorted(map(key, brute_contamination(rows, items, 4)))


def test_contamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {(x.doc_id, x.n_words, x.contaminated) for x in decontaminate.contamination(docs(spark, [(1, "a b")]), none).collect()} == {(1, 2, False)}
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(docs(spark, []), some).count() == 0
    clean = decontaminate.clean_documents(docs(spark, [(1, "a b"), (2, "b a"), (3, None)]), some)
    assert clean.columns == ["doc_id", "text", "n_words"] and sorted(x.doc_id for x in clean.collect()) == [2, 3]


# --- token files -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


def test_pieces_encode_as_the_whole(tokenizer):
    enc = token_files.Encoder(open(tokenizer).read())
    r = random.Random(5)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "'s", "!", "3", "　", "é", "中", "\x0b", "<|endoftext|>", "."]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(25))
        assert np.frombuffer(enc(text), "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark, tokenizer, tmp_path):
    r = random.Random(2)
    rows = [(k, " ".join(r.choice(["the", "of", "xyzzy", "Zu", "é\n"]) for _ in range(r.randrange(60)))) for k in range(40)] + ODD
    path = f"file://{tmp_path}/t"
    token_files.write_token_files(docs(spark, rows), path, tokenizer, n=3)
    enc = token_files.Encoder(open(tokenizer).read())
    got = sorted(token_files.read_token_files(spark, path, ids=True).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    start, texts = 0, defaultdict(Counter)
    for d, t, *_ in rows:
        texts[d][t or ""] += 1
    for x in got:
        want = {tuple(np.frombuffer(enc(t), "<u4").tolist() + [0]) for t in texts[x.doc_id]}
        assert tuple(x.ids) in want and x.start == start and x.n_tokens == len(x.ids)
        assert x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes())
        start += x.n_tokens
    shared, wide = token_files.read_dictionary(spark, path)
    found = [token_files.read_document(bytes(f.content), 7, shared, wide) for f in token_files.read_files(spark, f"{path}/data").collect()]
    assert [f.tolist() for f in found if f is not None] == [next(x.ids for x in got if x.doc_id == 7)]


def test_token_files_of_nothing(spark, tokenizer, tmp_path):
    path = f"file://{tmp_path}/t"
    token_files.write_token_files(docs(spark, []), path, tokenizer)
    assert token_files.read_token_files(spark, path).count() == 0


# --- fingerprints ----------------------------------------------------------------------------


def test_sketches_recover_the_difference():
    r = np.random.default_rng(1)
    a = [np.unique(r.integers(0, 2**63, n, np.uint64)) for n in (0, 1, 5, 400, 50)]
    b = [a[0], a[0], a[2], a[3][30:], np.unique(r.integers(0, 2**63, 70, np.uint64))]
    for x, y, (only_x, only_y) in zip(a, b, fingerprints.differences(a, b), strict=True):
        assert set(only_x.tolist()) == set(x.tolist()) - set(y.tolist())
        assert set(only_y.tolist()) == set(y.tolist()) - set(x.tolist())


def test_edit_fingerprints(spark):
    r = random.Random(3)
    rows = [(k, "\n".join("".join(r.choice("abé. ") for _ in range(12)) for _ in range(r.randrange(9)))) for k in range(25)] + [(5, "zz"), (30, None), (None, "q"), (31, "é" * 30_000)]
    got = fingerprints.edit_fingerprints(docs(spark, rows), n=4).collect()
    assert len(got) == len(rows)
    one = {x.doc_id: x for x in got}
    unique = sorted((d, t or "") for d, t in rows if d not in (None, 5))
    for (d, t), (e, u) in zip(unique, unique[1:], strict=False):
        if e - d == 1 and 5 not in (d, e):
            new = fingerprints.edited(t, u)
            assert one[d].edited_sha256 == hashlib.sha256(new.encode()).hexdigest() and one[d].n_chars == len(t)
            x, y, z = (set(fingerprints.paragraph_keys(s.encode()).tolist()) for s in (t, new, u))
            assert one[d].near_edited == (len(x & y) / len(x | y) if x | y else 1.0)
            assert one[d].near_next == (len(x & z) / len(x | z) if x | z else 1.0)
    assert fingerprints.edit_fingerprints(docs(spark, [])).count() == 0
    same = fingerprints.edit_fingerprints(docs(spark, [(1, "a\nb"), (2, "a\nb")])).collect()
    assert same[0].fingerprint == same[1].fingerprint and same[0].near_next == 1.0


# --- language model --------------------------------------------------------------------------


def brute_katz(rows):
    toks = [space_words((t or "").encode()) + [None] for _, t, *_ in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, *_ in rows]
    uni, two = Counter(), defaultdict(Counter)
    for t, h in zip(toks, held, strict=True):
        if not h:
            uni.update(t)
            for v, w in zip(["<s>", *t], t, strict=False):
                two[v][w] += 1
    n, types = sum(uni.values()), len(uni)
    few = lambda c: [sum(1 for x in c if x == r) for r in range(1, katz.CUT + 2)]
    u = katz.Unigram.of(n, types, few(uni.values()))
    d = katz.good_turing(few([c for x in two.values() for c in x.values()]))
    p1 = lambda w: float(u.chance(np.array([uni.get(w, 0)]))[0])
    alpha = {}
    for v, x in two.items():
        c, kept, mass = sum(x.values()), sum(k * (d[k] if k <= katz.CUT else 1) for k in x.values()), sum(p1(w) for w in x)
        total = c if kept < c - 1e-9 else c + 1
        alpha[v] = (total, (1 - kept / total) / (1 - mass))
    p = lambda v, w: two[v][w] * (d[two[v][w]] if two[v][w] <= katz.CUT else 1) / alpha[v][0] if v in two and two[v][w] else (alpha[v][1] if v in alpha else 1) * p1(w)
    out = []
    for (doc, *_), t, h in zip(rows, toks, held, strict=True):
        score = sum(math.log10(p(v, w)) for v, w in zip(["<s>", *t], t, strict=False))
        out.append((doc, h, len(t), sum(uni.get(w, 0) > 0 for w in t), n, sum(math.log10((uni.get(w, 0) + 1) / (n + types + 1)) for w in t), score))
    mass = [sum(p(v, w) for w in uni) + (alpha[v][1] if v in alpha else 1) * u.left for v in list(two)]
    return out, mass


def test_katz(spark):
    r = random.Random(7)
    words = ["a", "b", "c", "D", "e", "f", "é"]
    rows = [(k, " ".join(r.choice(words[: 2 + k % 6]) for _ in range(r.randrange(30)))) for k in range(60)] + ODD + [(70, "never seen words")]
    want, mass = brute_katz(rows)
    assert all(abs(m - 1) < 1e-9 for m in mass)
    got = [tuple(x) for x in katz.held_out_scores(docs(spark, rows), parts=3).collect()]
    k = lambda x: (str(x[0]), x[2], x[3], round(x[5], 6))
    for g, w in zip(sorted(got, key=k), sorted(want, key=k), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-8)
    assert katz.held_out_scores(docs(spark, [])).count() == 0


# --- archives --------------------------------------------------------------------------------


@pytest.mark.parametrize("version", [1, 2])
def test_archives(spark, tmp_path, version):
    long = "é" * 60
    rows = [(5, "http://a b/\n", long), (3, None, long), (9, "u", long + "x"), (4, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", long), (6, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20), (3, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    archives.write_archives(pages, path, version, group=3)
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        ref = min(same) if len(body) >= 100 and same and page != min(same) else None
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if ref is not None else "response", ref))
    assert sorted(map(key, (tuple(x) for x in archives.read_archives(spark, path).collect()))) == sorted(map(key, want))
    archives.write_archives(pages.limit(0), path + "0", version)
    assert archives.read_archives(spark, path + "0").count() == 0


def test_arc_errors():
    good = archives.arc_file([("http://x/", "20200101000000", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody")], 2)
    rec = next(archives.parse_arc(good))
    assert rec.status == "200" and rec.block.endswith(b"body")
    with pytest.raises(ValueError):
        list(archives.parse_arc(good[:-10]))
    with pytest.raises(ValueError):
        list(archives.parse_arc(good[good.index(b"http://x/") :]))


# --- chats -----------------------------------------------------------------------------------


def test_maximal_chats(spark):
    r = random.Random(4)
    convs = {k: [(r.choice("ua"), r.choice(["x", "y", None])) for _ in range(r.randrange(1, 5))] for k in range(30)}
    convs[40] = [("u", str(k)) for k in range(150)]
    convs[41] = convs[40][:149]
    convs[42] = [(None, "x"), ("u", "")]
    rows = [(c, k, role, text) for c, turns in convs.items() for k, (role, text) in enumerate(turns)] + [(None, 0, "u", "lost")]
    r.shuffle(rows)
    got = conversations.maximal_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    keep = {}
    for c, turns in sorted(convs.items()):
        if not any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values()):
            keep.setdefault(tuple(turns), c)
    assert {x.conv_id for x in got} == set(keep.values())
    for c in keep.values():
        text = "".join(x.text for x in sorted((x for x in got if x.conv_id == c), key=lambda x: x.part))
        assert text == "".join(f"<|{role or 'unknown'}|>\n{t or ''}\n<|end|>\n" for role, t in convs[c])
    assert conversations.maximal_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- near duplicates -------------------------------------------------------------------------


def groups_of(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def brute_near(rows, k, percent):
    def shingles(text):
        w = space_words((text or "").encode())
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    s = [shingles(t) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])]
    g = groups_of(len(s), links)
    out = []
    for i, (doc, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(s)) if g[j] == g[i] and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((doc, len(s[i]), c, doc == c))
    return out


def near_rows(seed):
    r = random.Random(seed)
    rows, base = [], [f"w{r.randrange(500)}" for _ in range(80)]
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(7)):
            w[r.randrange(80)] = f"v{r.randrange(9999)}"
        rows.append((200 - k, " ".join(w)))
        if k % 9 == 0:
            base = [f"w{r.randrange(500)}" for _ in range(80)]
    return rows + ODD + [(300, "one two"), (301, "ONE  two"), (302, "two one")]


def test_near_duplicates(spark):
    rows = near_rows(1)
    got = [tuple(x) for x in neardup.near_duplicates(docs(spark, rows), 3, 85).collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_near(rows, 3, 85)))
    assert neardup.near_duplicates(docs(spark, [])).count() == 0
    kept = neardup.keep_first(docs(spark, rows), 3, 85)
    assert kept.columns == ["doc_id", "text", "n_words"]
    assert sorted(map(key, ((x.doc_id,) for x in kept.collect()))) == sorted(map(key, ((r[0],) for r, b in zip(rows, brute_near(rows, 3, 85), strict=True) if b[3])))


def test_large_bucket_is_compared_whole(spark, monkeypatch):
    """A chain in one bucket, where pivots settle little: the exhaustive comparison finds the rest."""
    monkeypatch.setattr(buckets, "BLOCK", 8)
    ids = list(range(60))
    random.Random(2).shuffle(ids)
    m = spark.createDataFrame([(1, i) for i in ids] + [(2, 5)], "key long, id long")
    sigs = spark.createDataFrame([(i, bytearray([k])) for k, i in enumerate(ids)], "id long, sig binary")
    pay = sigs.withColumnRenamed("sig", "payload")
    may = lambda a, b: np.abs(a[:, 0].astype(int) - b[:, 0]) <= 2
    for screen in (False, True):
        got = buckets.groups(Workspace(spark, "t"), m, sigs, pay, may, lambda p: p[0], lambda a, b: abs(a - b) == 1 and 30 not in (a, b), screen=screen)
        by = defaultdict(set)
        for x in got.collect():
            by[x.component].add(x.id)
        assert sorted(map(sorted, by.values())) == sorted(sorted(x) for x in (ids[:30], ids[31:]))


def test_estimate_is_near_the_similarity():
    r = np.random.default_rng(2)
    both, a, b = (r.integers(0, 2**63, n, np.uint64) for n in (400, 30, 70))
    x, y = (neardup.registers(np.unique(np.concatenate([both, o]))) for o in (a, b))
    got = neardup.estimate(np.array([430.0]), np.array([470.0]), np.array([(x > y).sum()]), np.array([(x < y).sum()]))[0]
    assert abs(got - 0.8) < 0.08
    union = neardup.registers(np.unique(np.concatenate([both, a, b])))
    assert (union == np.maximum(x, y)).all()


# --- toxicity --------------------------------------------------------------------------------


def test_toxicity_learns_and_covers_all_windows(spark):
    r = random.Random(3)
    say = lambda n: [r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(n)]
    rows, labels = [], []
    for k in range(160):
        w = say(r.randrange(5, 120))
        if k % 4 == 0:
            for _ in range(1 + len(w) // 40):
                w[r.randrange(len(w))] = r.choice(["badword", "badwords"])
        rows.append((k, " ".join(w)))
        labels.append((k, int(k % 4 == 0)))
    late = " ".join([*say(3000), "badword", *say(20)])
    rows += [(500, late), (501, " ".join(say(3000))), *ODD]
    got = toxicity.scored(docs(spark, rows), spark.createDataFrame([*labels, (None, 1), (900, 1), (3, None)], "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got if x.doc_id is not None)
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 160]
    assert sum(x.predicted == int(x.doc_id % 4 == 0) for x in held) >= 0.9 * len(held)
    assert {x.doc_id: x.predicted for x in got}[500] == 1
    none = toxicity.scored(docs(spark, rows[:3]), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert [x.score for x in none] == [0.0] * 3


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 100):
        w = toxicity.windows(list(range(n)))
        assert set(w[w >= 0].tolist()) == set(range(n)) and w.shape[1] == toxicity.WINDOW


def test_gradient():
    m = toxicity.Model(1)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    vocab = toxicity.Vocabulary()
    x = np.stack([toxicity.windows(vocab.number([b"a", b"bb", b"c", b"a"]))[0], toxicity.windows(vocab.number([b"dd", b"a"]))[0]])
    y = np.array([1.0, 0.0])
    tables = vocab.tables()

    def loss():
        p = toxicity.sigmoid(m.forward(m.inputs(*tables), x).astype(np.float64))
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    before = {k: v.copy() for k, v in m.p.items()}
    base = loss()
    # the first step of Adam moves each parameter against the sign of its gradient
    m.step(tables, x, y, np.ones(2), 1e-4)
    moved = {k: m.p[k] - before[k] for k in before}
    m.p = {k: v.copy() for k, v in before.items()}
    for k, v in m.p.items():
        for i in np.argsort(-np.abs(moved[k]), axis=None)[:6]:
            at, e = np.unravel_index(i, v.shape), 1e-4
            keep = v[at]
            v[at] = keep + e
            up = loss()
            v[at] = keep - e
            slope = (up - loss()) / (2 * e)
            v[at] = keep
            assert abs(slope) < 1e-6 or np.sign(slope) == -np.sign(moved[k][at]), (k, at, slope)
    for _ in range(5):
        m.step(tables, x, y, np.ones(2), 0.01)
    assert loss() < base and any((before[k] != m.p[k]).any() for k in before)


def test_toxicity_reads_long_runs_to_their_end():
    for n in (1, 48, 49, 54, 55, 500):
        w = bytes(97 + k % 26 for k in range(n))
        assert toxicity.pieces(w) == ([w] if n <= 48 else [w[k : k + 2] for k in range(n - 1)])
    r = random.Random(6)
    say = lambda n: "".join(r.choice("一二三四五六七八九十百千山川田日月火水木") for _ in range(n))
    texts = [(say(r.randrange(30, 90)) + "毒殺" * (k % 3 == 0) + say(r.randrange(20)), int(k % 3 == 0)) for k in range(660)]
    model = toxicity.train([t.encode() for t, _ in texts[:600]], [y for _, y in texts[:600]])
    got = toxicity.score_texts(model, [t.encode() for t, _ in texts[600:]], toxicity.Vocabulary()) >= toxicity.THRESHOLD
    assert sum(g == y for g, (_, y) in zip(got, texts[600:], strict=True)) >= 54


def test_training_scores_every_window_of_long_documents(monkeypatch):
    seen, score = [], toxicity.score_windows
    monkeypatch.setattr(toxicity, "score_windows", lambda m, t, x: seen.append(len(x)) or score(m, t, x))
    texts = [b"alpha beta " * 4000, b"gamma delta", b"alpha badword"]
    toxicity.train(texts, [1, 0, 1], rounds=(0, 1))
    assert set(seen) == {sum(len(toxicity.windows(list(range(n)))) for n in (8000, 2, 2))}


# --- packing ---------------------------------------------------------------------------------


def test_boundaries_are_optimal():
    r = random.Random(9)
    for _ in range(60):
        n = r.randrange(1, 9)
        x = sorted(r.sample(range(1, 40), n))
        c = [r.randrange(1, 9) for _ in x]
        k = r.randrange(1, 5)

        def padding(bounds, x=x, c=c):
            return sum(m * (min(b for b in bounds if b >= v) - v) for v, m in zip(x, c, strict=True))

        from itertools import combinations

        best = min(padding([*b, x[-1]]) for j in range(min(k, n)) for b in combinations(x[:-1], j))
        got = packing.boundaries(np.array(x), np.array(c), k)
        assert len(got) <= k and got[-1] == x[-1] and padding(got) == best


def test_packing(spark):
    rows = [(k, "w " * (k % 13)) for k in range(50)] + ODD
    d = docs(spark, rows)
    got = packing.pack(d, packing.word_count(d["text"]), buckets=4, budget=30).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for x in got:
        assert x.padding == x.bucket_length - x.n_tokens >= 0
        by[x.bucket_length, x.batch].append(x)
    for (length, _), own in by.items():
        assert len(own) == own[0].batch_docs and sorted(x.slot for x in own) == list(range(len(own)))
        assert len(own) * length <= 30 or len(own) == 1
    assert packing.pack(d.limit(0), packing.word_count(d["text"])).count() == 0


def test_packing_is_optimal_with_many_lengths(spark):
    n = 70_000
    # every length once, and one often that a grid of 65,536 of them leaves out
    for odd in (30_014, 36_004):
        counts = np.ones(n, np.int64)
        counts[odd - 1] = 3000
        best = packing.boundaries(np.arange(1, n + 1), counts, 2)
        d = spark.range(1, n + 1).selectExpr("id as doc_id", f"explode(sequence(1, if(id = {odd}, 3000, 1))) as k")
        got = packing.pack(d, d["doc_id"], buckets=2).select("bucket_length").distinct().collect()
        assert sorted(b.bucket_length for b in got) == best


# --- lines -----------------------------------------------------------------------------------


def brute_lines(rows, percent):
    def lev(a, b):
        """Edit distance, a row of the table at a time."""
        x, step = np.frombuffer(b.encode("utf-32-le"), "<u4"), np.arange(len(b) + 1)
        p = step
        for i, c in enumerate(a.encode("utf-32-le")[k : k + 4] for k in range(0, 4 * len(a), 4)):
            q = np.concatenate([[i + 1], np.minimum(p[1:] + 1, p[:-1] + (x != int.from_bytes(c, "little")))])
            p = np.minimum.accumulate(q - step) + step
        return int(p[-1])

    texts = {}
    for d, t, *_ in rows:
        for i, line in enumerate((t or "").split("\n")):
            if n := lines.normalised(line.encode()):
                texts.setdefault(n, []).append(((d is not None, d or 0), t, i))
    nodes = sorted(texts)

    def link(i, j):
        a, b = nodes[i].decode(), nodes[j].decode()
        most = max(len(a), len(b))
        return 100 * min(len(a), len(b)) >= percent * most and 100 * (most - lev(a, b)) >= percent * most

    g = groups_of(len(nodes), [(i, j) for i in range(len(nodes)) for j in range(i) if link(i, j)])
    kept = {}
    for i, n in enumerate(nodes):
        for place in texts[n]:
            kept[g[i]] = min(kept.get(g[i], place), place, key=lambda p: (p[0], p[2]))
    group = dict(zip(nodes, g, strict=True))
    out = []
    for d, t, *_ in rows:
        own = (t or "").split("\n")
        stay = [x for i, x in enumerate(own) if not (n := lines.normalised(x.encode())) or kept[group[n]] == ((d is not None, d or 0), t, i)]
        out.append((d, len(own), len(own) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


def test_line_report(spark):
    r = random.Random(5)
    base = [" ".join(f"word{r.randrange(300)}" for _ in range(60)) for _ in range(6)]
    rows = []
    for k in range(25):
        own = []
        for _ in range(r.randrange(5)):
            w = r.choice(base).split()
            if r.random() < 0.6:
                w[r.randrange(60)] = f"other{r.randrange(99)}"
            own.append(r.choice([" ".join(w), " ".join(w).upper() + "!", "---", "Page 12", f"Page {k}"]))
        rows.append((k, "\n".join(own)))
    rows += [(1000, None), (1001, "")]
    got = [tuple(x) for x in lines.line_report(docs(spark, rows)).collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_lines(rows, 80)))
    assert sum(x[2] for x in got) > 20


def test_dedup_lines_keeps_rows_and_columns(spark):
    rows = [*ODD, (20, "same line here\nsame line here\n!!"), (21, "same line here")]
    out = lines.dedup_lines(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "n_words"] and out.count() == len(rows)
    text = {x.doc_id: x.text for x in out.collect()}
    assert text[20] == "same line here\n!!" and text[21] == "" and text[2] is None and text[1] == ""
    assert lines.line_report(docs(spark, [])).count() == 0


def typos(r, line, n):
    x = list(line)
    for _ in range(n):
        p, c = r.randrange(len(x)), r.choice("abcdefghijklmnopqrstuvwxyz")
        x[p : p + 1] = r.choice([[c], [c, x[p]], []]) if len(x) > 1 else [c]
    return "".join(x)


def found_share(pairs):
    """The share of pairs of edit similarity 0.8 or more that are candidates."""
    same = lines.alike(80)
    pairs = [(a, b) for a, b in pairs if same(a, b)]
    a, b = (lines.signatures([p[k].encode() for p in pairs]) for k in (0, 1))
    ka, kb = lines.bucket_keys(a), lines.bucket_keys(b)
    return (((ka == kb) & (ka >= 0)).any(axis=1) & lines.near(80)(a, b)).mean()


def test_lines_with_typos_are_candidates():
    r = random.Random(8)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 10))) for _ in range(3000)]
    for n in (2, 5, 10, 20, 50, 100):
        for share, least in ((0.0, 0.985), (0.05, 0.985), (0.1, 0.97), (0.15, 0.93), (0.2, 0.8)):
            pairs = []
            for _ in range(400):
                a = " ".join(r.choice(words) for _ in range(n))
                b = lines.normalised(typos(r, a, max(1, int(share * len(a)))).encode()).decode()
                if b:
                    pairs.append((a, b))
            assert found_share(pairs) >= least, (n, share)


def test_line_report_finds_lines_with_typos(spark):
    r = random.Random(4)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(3, 9))) for _ in range(2000)]
    base = [" ".join(r.choice(words) for _ in range(n)) for n in (4, 10, 20, 50, 100) for _ in range(12)]
    rows = [(k, x) for k, x in enumerate(base)] + [(100 + k, typos(r, x, 1 + len(x) // 60)) for k, x in enumerate(base)]
    got = {x.doc_id: x.n_dropped for x in lines.line_report(docs(spark, rows)).collect()}
    assert [got[k] for k in range(60)] == [0] * 60 and [got[100 + k] for k in range(60)] == [1] * 60


def test_recall_of_lines_with_one_word_or_character_changed(spark):
    """Through the whole operator, against edit similarity alone."""
    r = random.Random(12)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(2, 10))) for _ in range(3000)]
    rows, cases, same = [], {}, lines.alike(80)
    for low, high in ((5, 15), (15, 30), (30, 80), (80, 300)):
        for kind in ("word", "character"):
            for _ in range(60):
                w = [r.choice(words) for _ in range(r.randrange(low, high))]
                a, b = " ".join(w), list(w)
                if kind == "word":
                    b[r.randrange(len(b))] = r.choice(words)
                b = " ".join(b) if kind == "word" else typos(r, a, 1)
                if same(*(lines.normalised(x.encode()).decode() for x in (a, b))):
                    cases.setdefault((low, kind), []).append(len(rows) + 1)
                    rows += [(len(rows), a), (len(rows) + 1, b)]
    got = {x.doc_id: x.n_dropped for x in lines.line_report(docs(spark, rows)).collect()}
    for case, ids in cases.items():
        assert sum(got[k] for k in ids) >= 0.95 * len(ids), case


def test_large_groups_of_lines_meet_through_their_lines(spark):
    """Two groups of near lines and one between them end as one; lines that share half of their text stay apart."""
    r = random.Random(13)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(6)) for _ in range(500)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    a = say(60)
    b = a[:40] + say(8) + a[48:]
    middle = b[:40] + a[40:44] + b[44:]
    rows = [(0, " ".join(middle))]
    for k, base in enumerate((a, b)):
        for i in range(30):
            w = list(base)
            w[r.randrange(36)] = r.choice(words)
            rows.append((100 * k + i + 1, " ".join(w)))
    half = say(30)
    rows += [(500 + k, " ".join(half + say(30))) for k in range(40)]
    got = {x.doc_id: x.n_dropped for x in lines.line_report(docs(spark, rows)).collect()}
    assert got[0] == 0 and all(got[k] == 1 for k in got if 0 < k < 500) and all(got[k] == 0 for k in got if k >= 500)


def test_a_link_counts_behind_lines_that_agree_more(spark):
    """Of a group, the three lines that agree most with a line are not similar to it; the one that agrees least is."""
    text = "a quick brown fox jumps over the lazy dog once more"
    near, far = text.replace("quick", "quack"), "".join(chr(ord("z") - k % 26) for k in range(len(text)))
    full = np.arange(lines.REGISTERS, dtype="<u2")
    less = np.where(np.arange(lines.REGISTERS) % 8 < 6, full, full + 999).astype("<u2")
    rows = [(1, 1, text, full), (2, 2, far, full), (3, 2, far + "!", full), (4, 2, far + "?", full), (5, 2, near, less), (2**40 + 1, 2**32 + 1, near, full)]
    nodes = spark.createDataFrame([(k, c, len(x), bytearray(r.tobytes()), None, bytearray(x.encode())) for k, c, x, r in rows], "id long, c long, n int, long binary, short binary, text binary")
    got = {tuple(sorted(x)) for x in lines._confirmed(nodes, len(rows), 50.0, 0, lines.KEYS, 80).collect()}
    joined = {1: 1}  # groups by their links: 1, 2 and 2**32 + 1 are one
    of = {k: c for k, c, *_ in rows}
    assert all(1 in p or 5 in p or 2**40 + 1 in p for p in got) and not any({2, 3, 4} & set(p) for p in got)
    for _ in rows:
        for a, b in got:
            if of[a] in joined or of[b] in joined:
                joined |= {of[a]: 1, of[b]: 1}
    assert set(joined) == {1, 2, 2**32 + 1}


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    ws, at = Workspace(spark, "t"), source
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {x.doc_id for x in at.select("doc_id").collect()}
        at = ws.put(stage(spark, at, sf))
        after = [x.doc_id for x in at.select("doc_id").collect()]
        assert set(after) <= before and len(after) == len(set(after))
        if name != "packing":
            assert at.columns == source.columns
        if name in ("line_dedup", "packing"):
            assert set(after) == before


def test_archive_identifiers(spark, tmp_path):
    big = "x" * 200
    pages = spark.createDataFrame([(1, "http://a/", big), (1, "http://a/", "other"), (2, "http://b/", big), (None, None, "n"), (None, None, "n"), (3, None, None)], "page_id long, url string, html string")
    archives.write_archives(pages, f"file://{tmp_path}/w")
    records = []
    for f in (tmp_path / "w").glob("part-*"):
        records += archives.parse_warc(gzip.decompress(f.read_bytes()))
    ids = {fields["WARC-Record-ID"]: fields for fields, _ in records}
    assert len(ids) == len(records) == 6
    (revisit,) = [fields for fields in ids.values() if fields["WARC-Type"] == "revisit"]
    assert ids[revisit["WARC-Refers-To"]]["WARC-Type"] == "response" and ids[revisit["WARC-Refers-To"]]["WARC-Target-URI"] == "http://a/"
    for fields, block in records:
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()


def test_arc_files_as_a_source(spark, tmp_path):
    rows = [("http://x/", "20200101000000", "text/html", b"HTTP/1.1 200 OK\r\n\r\nbody"), ("http://y/ z", "20200102000000", "text/html", b"")]
    (tmp_path / "one.arc").write_bytes(archives.arc_file(rows, 1))
    (tmp_path / "two.arc.gz").write_bytes(gzip.compress(archives.arc_file(rows[:1], 2)))
    (tmp_path / "none.arc").write_bytes(archives.arc_file([], 1))
    got = sorted((x.url, x.date, x.status, bytes(x.block)) for x in archives.read_arc(spark, f"file://{tmp_path}").collect())
    assert got == [("http://x/", "20200101000000", "-", rows[0][3]), ("http://x/", "20200101000000", "200", rows[0][3]), ("http://y/%20z", "20200102000000", "-", b"")]


def test_token_files_of_repeated_ids(spark, tmp_path):
    import public_tokenizers

    rows = [(5, "b b"), (5, "a"), (5, None), (2, "c"), (None, "d")]
    got = []
    for k, order in enumerate((rows, rows[::-1])):
        path = f"file://{tmp_path}/{k}"
        token_files.write_token_files(spark.createDataFrame(order, "doc_id long, text string"), path, public_tokenizers.path("byte_bpe_50k.json"), n=2)
        got.append(sorted(map(tuple, token_files.read_token_files(spark, path).collect()), key=lambda r: r[1]))
    assert got[0] == got[1] and [r[0] for r in got[0]] == [None, 2, 5, 5, 5]
