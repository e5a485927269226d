"""Resampling, vector codes and repeated passages against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoquill.llm import codes, lines, repeats, resample

DOC = "doc_id long, text string, gold int, row_no int"  # extra columns, one with the name of an inner column
ODD = [(1, ""), (2, None), (None, "a b"), (None, None), (9, "x " * 3000), (9, "x " * 3000)]


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, 1) for r in rows], DOC)


# --- resampling ------------------------------------------------------------------------------


def brute_features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute_draw(rows, target, share, least):
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(brute_features(x)[1])
    for x in target:
        t.update(brute_features(x)[1])
    s_all, t_all = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    out = []
    for doc, x in rows:
        n, f = brute_features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    order = sorted((i for i in range(len(out)) if out[i][4] >= least), key=lambda i: (-out[i][3], out[i][0] is not None, out[i][0] or 0))
    rank = {i: k + 1 for k, i in enumerate(order[: share * len(order) // 100])}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(out)]


def loose(rows):
    """Rows that tie in score and id may change ranks."""
    return sorted(map(str, ((*r[:4], r[4]) for r in rows)))


@pytest.mark.parametrize("share", [0, 1, 25, 100])
def test_draw_equals_sorting(spark, share):
    r = random.Random(share)
    words = "Äpfel the OF and x1 y2 z3 é".split()
    rows = [(k if k % 9 else None, " ".join(r.choice(words) for _ in range(r.randrange(60)))) for k in range(150)] + ODD + [(-5, "a b " * 12), (2**62, "c " * 30), (-(2**63), "the of " * 20)]
    rows = [x for x in rows if x[0] != 9]
    target = ["the of and the of", None, "", "é é"]
    got = resample.draw(docs(spark, rows), spark.createDataFrame([(1, t) for t in target], "item_id long, text string"), share, 20)
    assert got.columns == ["doc_id", "text", "gold", "row_no", "gq_words", "gq_features", "gq_weight", "gq_score", "gq_rank"]
    got = [(x.doc_id, x.gq_features, x.gq_weight, x.gq_score, x.gq_rank) for x in got.collect()]
    assert loose(got) == loose(brute_draw(rows, target, share, 20))


def test_draw_of_repeated_rows_and_ties(spark):
    """One row makes up most of the table: equal keys are drawn as often as there is room."""
    rows = [(4, "a b " * 15)] * 60 + [(5, "a b " * 15)] * 30 + [(6, "c d " * 20)] * 10
    got = resample.draw(docs(spark, rows), spark.createDataFrame([], "item_id long, text string"), 33, 20).collect()
    want = brute_draw(rows, [], 33, 20)
    assert loose((x.doc_id, x.gq_features, x.gq_weight, x.gq_score, x.gq_rank) for x in got) == loose(want)
    assert sorted(x.gq_rank for x in got if x.gq_rank) == list(range(1, 34))
    assert resample.draw(docs(spark, []), docs(spark, rows)).count() == 0


def test_kth_key_over_all_digits(spark):
    r = random.Random(3)
    keys = sorted((r.choice([0, 1]), r.randrange(3), r.randrange(4), k) for k in range(200))
    df = spark.createDataFrame(r.sample(keys, 200), "a int, b int, c int, d int")
    for k in (1, 2, 99, 150, 200):
        got = resample.kth_key(df, k)
        assert sum(list(x[: len(got)]) <= got for x in keys) == k or tuple(got) == keys[k - 1][: len(got)]
        assert sum(x[: len(got)] <= tuple(got) for x in keys) == k


# --- vector codes ----------------------------------------------------------------------------


def brute_codes(rows, parts, entries, rounds):
    kept = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * dim : (p + 1) * dim]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            of = defaultdict(list)
            for _, v, _ in kept:
                of[near(cut(v, p), p)[1]].append(cut(v, p))
            new.append([[sum(c) // len(of[j]) for c in zip(*of[j])] if of[j] else e for j, e in enumerate(books[p])])
        books = new
    out = []
    for k, v, label in kept:
        got = [near(cut(v, p), p) for p in range(parts)]
        out.append((k, label, [j for _, j in got], sum(d for d, _ in got)))
    return out, books


@pytest.mark.parametrize("n, parts, dim", [(150, 4, 12), (20, 2, 2), (90, 3, 15)])
def test_codes_equal_brute_force(spark, n, parts, dim):
    r = random.Random(n)
    rows = [(k if k else None, [r.choice([-0.5, 0.0, 0.25, r.gauss(0, 1)]) for _ in range(dim)], r.choice([1, 2, None])) for k in range(n)]
    rows += [rows[5], rows[5], (500, None, 1), (501, [None] * dim, 1), (502, [float("nan")] * dim, 1), (503, [float("inf")] + [0.0] * (dim - 1), 2), (-3, [0.0] * dim, None)]
    df = spark.createDataFrame([(*x, 0) for x in rows], "vec_id long, embedding array<double>, label int, gq int").repartition(3)
    got, books = codes.compress(df, "embedding", "vec_id", ["vec_id", "label"], parts, 16, 2)
    want, brute = brute_codes(rows, parts, 16, 2)
    assert [b.tolist() for b in books] == brute
    assert sorted(map(str, ((x.vec_id, x.label, x.gq_codes, x.gq_error) for x in got.collect()))) == sorted(map(str, want))
    assert codes.digest(books) == hashlib.sha256(",".join(str(v) for b in brute for e in b for v in e).encode()).hexdigest()


def test_partial_distances_keep_ties_and_skip_nothing():
    r = np.random.default_rng(1)
    for dim in (1, 2, 4, 7):
        x, book = r.integers(-4, 5, (500, dim)), r.integers(-4, 5, (33, dim))
        full = ((x[:, None] - book[None]) ** 2).sum(2)
        entry, error = codes.nearest(x, book)
        assert (entry == full.argmin(1)).all() and (error == full.min(1)).all()
    entry, error = codes.nearest(np.zeros((3, 0), np.int64), np.zeros((2, 0), np.int64))
    assert entry.tolist() == error.tolist() == [0, 0, 0]


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    got, books = codes.compress(spark.createDataFrame([], schema))
    assert got.count() == 0 and codes.digest(books) == hashlib.sha256(b"").hexdigest()
    one, _ = codes.compress(spark.createDataFrame([(1, [1e30, 0.0], 1), (2, [0.0, 1.0], 1), (3, [1.0], 1)], schema), parts=2)
    assert [(x.vec_id, x.gq_error) for x in one.orderBy("vec_id").collect()] == [(1, 0), (2, 0)]  # another length: left out
    short, _ = codes.compress(spark.createDataFrame([(1, [1.0, 0.0, 2.0], None)], schema), parts=16)
    assert short.first().gq_codes == [0] * 16


def test_group_sums_of_hot_and_rare_groups(spark, tmp_path):
    from geoquill.workspace import Workspace

    rows = [(k, 1 if k < 300 else None if k < 500 else k, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, label int, error long")
    got = {(x.vec_id, x.s) for x in codes.with_group_sum(df, "label", "error", "s", Workspace(spark, "t"), 20).collect()}
    sums = Counter()
    for _, g, v in rows:
        sums[g] += v
    assert got == {(k, sums[g]) for k, g, _ in rows} and len(got) == 3000


# --- repeated passages -----------------------------------------------------------------------


def brute_repeats(rows, window):
    of = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, of):
        if doc is not None:
            for i in range(len(w) - window + 1):
                x = tuple(w[i : i + window])
                first[x] = min(first.get(x, doc), doc)
    out = []
    for (doc, _), w in zip(rows, of):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window, shard, load", [(4, 50_000, 1_000_000), (4, 7, 20), (13, 5, 9), (1, 3, 50)])
def test_repeats_equal_brute_force(spark, monkeypatch, window, shard, load):
    monkeypatch.setattr(repeats, "SHARD", shard)
    monkeypatch.setattr(repeats, "LOAD", load)
    r = random.Random(window + shard)
    words = ["a", "b", "Ü", "c\x1cd", "x\xa0y", "B", "eé", "f"] + [f"w{i}" for i in range(40)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    passages = [say(r.randrange(3, 40)) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = [r.choice([say(r.randrange(12)), r.choice(passages), r.choice(passages)[r.randrange(3) :]]) for _ in range(r.randrange(4))]
        rows.append((k * 3 - 20, r.choice([" ", "\n", "\t "]).join(w for p in parts for w in p)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (101, rows[7][1]), (101, rows[3][1]), (7, rows[3][1]), (None, rows[7][1]), (None, None), (300, ""), (301, None), (302, " ".join("ab" for _ in range(2000))), (303, " ".join("ab" for _ in range(500)))]
    df = docs(spark, rows).repartition(4)
    got = repeats.without_repeats(df, window)
    assert got.columns == [*df.columns, "gq_words", "gq_removed", "gq_kept"]
    want = brute_repeats(rows, window)
    assert sum(x[2] for x in want) > 500 or window == 13
    assert sorted(map(str, ((x.doc_id, x.gq_words, x.gq_removed, x.gq_kept) for x in got.collect()))) == sorted(map(str, want))


def test_one_passage_in_most_documents(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LOAD", 30)
    text = " ".join(f"p{i}" for i in range(60))
    rows = [(k, f"{text} own{k}" if k % 3 else f"q{k} " * 20) for k in range(90)]
    got = sorted((x.doc_id, x.gq_removed) for x in repeats.without_repeats(docs(spark, rows)).collect())
    assert got == [(k, 60 if k % 3 and k > 1 else 0) for k in range(90)]
    assert repeats.without_repeats(docs(spark, [])).count() == 0


def test_automaton_finds_every_window():
    machine = repeats.Automaton([(3, b"a b c d e"), (5, b"x a b c")], 3)
    assert machine.covered(b"q a b c z d x a b c d e", 9) == [[1, 4], [6, 12]]
    assert machine.covered(b"x a b c d", 5) == [[1, 5]] and machine.covered(b"x a b c d", 3) == []


@pytest.mark.parametrize("shared", [1, 2, 8])
@pytest.mark.parametrize("window", [1, 2, 3, 4, 7, 13])
def test_automaton_equals_brute_force(monkeypatch, window, shared):
    monkeypatch.setattr(repeats.Automaton, "SHARED", shared)
    r = random.Random(window)
    say = lambda n: [r.choice("abc") for _ in range(n)]
    for _ in range(40):
        passages = [(r.randrange(6), say(window + r.randrange(12))) for _ in range(r.randrange(1, 9))]
        machine = repeats.Automaton([(k, " ".join(p).encode()) for k, p in passages], window)
        text = [w for _ in range(5) for w in r.choice([say(4), passages[0][1], passages[-1][1][1:]])]
        doc = r.randrange(7)
        known = {tuple(p[i : i + window]) for k, p in passages if k < doc for i in range(len(p) - window + 1)}
        want = {j for i in range(len(text) - window + 1) if tuple(text[i : i + window]) in known for j in range(i, i + window)}
        assert {j for b, e in machine.covered(" ".join(text).encode(), doc) for j in range(b, e)} == want


def test_window_hashes_depend_on_the_words_alone(monkeypatch):
    w = [f"w{i % 7}".encode() for i in range(40)]
    key, h = repeats.window_hashes(repeats.word_hashes(b"\t ".join(w))[2], 13)
    for i in range(28):
        k1, h1 = repeats.window_hashes(repeats.word_hashes(b" " + b" ".join(w[i : i + 13]))[2], 13)
        assert (k1[0], h1[0]) == (key[i], h[i])
    assert len(repeats.window_hashes(repeats.word_hashes(b" ".join(w[:12]))[2], 13)[0]) == 0
    assert [len(x) for x in repeats.word_hashes(b" \n")] == [len(x) for x in repeats.word_hashes(b"")] == [0, 0, 0]
    r = random.Random(1)
    text = "".join(r.choice("ab \n\x0b\x1c\u00e9") for _ in range(5000)).encode() + b"x" * 6000
    begin, end, h = repeats.word_hashes(text)
    assert [text[b:e] for b, e in zip(begin, end)] == text.split()
    assert len(set(h.tolist())) == len(set(text.split()))
    monkeypatch.setattr(repeats, "CHUNK", 37)
    for x, y in zip(repeats.word_hashes(text), (begin, end, h)):
        assert (x == y).all()


def test_queries_hold_on_whole_tables(spark):
    from geoquill.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(x) for x in queries.op13_repeats(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())
    assert got == sorted((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute_repeats(rows, 13))
    target = [x.text for x in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(tuple(x) for x in queries.op11_resampling(spark, sf).select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert sorted(map(str, got)) == sorted(map(str, brute_draw(rows, target, 25, 20)))
    vectors = [(x.vec_id, x.embedding, x.label) for x in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, books = brute_codes(vectors, 16, 64, 2)
    sums = Counter()
    for _, label, _, e in want:
        sums[label] += e
    got = sorted(tuple(x) for x in queries.op12_vector_codes(spark, sf).select("vec_id", "code", "error", "label_error").collect())
    assert got == sorted((k, "".join(f"{j:02x}" for j in c), e, sums[label]) for k, label, c, e in want)


def test_automaton_confirms_words_of_equal_letters(monkeypatch):
    monkeypatch.setattr(repeats, "_letters", lambda words: "a" * len(words))
    machine = repeats.Automaton([(3, b"a b c"), (4, b"d e f g"), (2, b"a b c")], 3)  # every block has the same letters
    assert machine.covered(b"x d e f g a b c", 9) == [[1, 8]] and machine.covered(b"x d e f g a b c", 3) == [[5, 8]]
    assert machine.covered(b"c b a d e", 9) == []


# --- archives of others ----------------------------------------------------------------------


def test_arc_files_with_a_member_for_each_record(spark, tmp_path):
    import gzip

    from geoquill.llm import archives

    recs = [(f"http://a/{k}", "19990101000000", "text/html", b"HTTP/1.0 200 OK\r\n\r\n" + b"x" * k) for k in range(4)]
    for version in (1, 2):
        whole = archives.arc_file(recs, version)
        ends = [whole.index(b"http://a/%d " % k) for k in range(4)] + [len(whole)]
        spaced = whole[ends[3] :].replace(b"http://a/3 ", b"http://a/3 b c.html ", 1)
        members = [whole[: ends[0]], *(whole[a:z] for a, z in zip(ends[:3], ends[1:4])), spaced]
        path = tmp_path / f"v{version}"
        path.mkdir()
        (path / "many.arc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
        (path / "one.arc.gz").write_bytes(gzip.compress(b"".join(members)))
        (path / "plain.arc").write_bytes(b"".join(members))
        got = archives.read_arc(spark, f"file://{path}").collect()
        assert len(got) == 12 and {x.url for x in got} == {"http://a/0", "http://a/1", "http://a/2", "http://a/3 b c.html"}
        assert all(x.block.endswith(b"x" * int(x.url.split("/")[-1][0])) for x in got)
    with pytest.raises(ValueError):
        archives.inflated(gzip.compress(b"abc" * 1000)[:-9])
    assert archives.inflated(b"") == b"" and archives.inflated(b"plain") == b"plain"


# --- stored fingerprints ---------------------------------------------------------------------


def test_stored_fingerprints_subtract_and_peel(spark):
    from geoquill.llm import fingerprints as fp

    many = fp.paragraph_keys(b"x\n" * 300_000)  # counts of a cell beyond 2**16
    other = np.unique(np.concatenate([many[5:], np.array([1, 2, 3], np.uint64)]))
    a, b = (fp.Loaded(fp.sketches([k], fp.FIRST).stored(0, len(k))) for k in (many, other))
    only_a, only_b = a.difference(b)
    assert set(only_a.tolist()) == set(many[:5].tolist()) and set(only_b.tolist()) == {1, 2, 3} and a.n_keys == 300_000
    assert a.difference(fp.Loaded(fp.sketches([many[:9]], fp.FIRST).stored(0, 9))) is None
    assert a.difference(fp.Loaded(fp.sketches([many], 48).stored(0, len(many)))) is None
    r = random.Random(1)
    rows = [(k, "\n".join(r.choice("abcdefghijklmnop") * 3 for _ in range(r.randrange(30)))) for k in range(60)] + [(100, "a\n" * 400), (101, None)]
    got = fp.stored_likeness(fp.edit_fingerprints(docs(spark, rows))).collect()
    assert all(x.gq_likeness in (None, x.near_edited) for x in got) and sum(x.gq_likeness is not None for x in got) > 40


def test_few_texts_meet_the_join_of_wanted_documents(spark):
    """All rows with a wanted key pass the filter, with their columns, and few others do; no key passes none."""
    from geoquill.llm.buckets import mostly_of

    rows = spark.range(-20_000, 20_000).selectExpr("id * 7919 as k", "cast(id as string) as text")
    want = spark.range(-200, 200).selectExpr("id * 7919 as k")
    got = {r.k: r.text for r in mostly_of(rows, "k", want).collect()}
    assert all(got[k * 7919] == str(k) for k in range(-200, 200)) and len(got) < 4000
    assert mostly_of(rows, "k", want.limit(0)).count() == 0


def test_only_lines_with_a_candidate_take_their_text_along(spark):
    """Ends of all links are among the lines that are seen to have a partner; lines of one group and lines without any are not."""
    r = random.Random(4)
    words = lambda: " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(10))
    alone, base = [words() for _ in range(150)], [words() for _ in range(20)]
    near = [b[:20] + "zz" + b[22:] for b in base]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(alone + base + near)], "doc_id long, text string")
    cut = docs.selectExpr("doc_id", "doc_id as row_key", "cast(text as binary) as text").mapInArrow(lines._cut, "doc_id long, row_key long, line int, id long, n int, long binary, short binary, text binary").cache()
    nodes = cut.selectExpr("id", "id as c", "n", "long", "short", "text")
    some = {x.id for x in lines._partnered(nodes, 190, 0, lines.KEYS, 80).collect()}
    links = lines._confirmed(nodes, 190, 80.0, 0, lines.KEYS, 80).collect()
    ends = {x for p in links for x in p}
    assert len(links) == 20 and ends <= some and len(some) < 60
    joined = nodes.withColumn("c", F.when(F.col("id").isin(list(ends)), F.lit(7)).otherwise(F.col("id")).cast("long"))
    assert not ends & {x.id for x in lines._partnered(joined, 190, 0, lines.KEYS, 80).collect()}


def _two_lines():
    """Rows (id, c, n, long, short, text) of two lines that share two thirds, less than the similarity."""
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 7)) for _ in range(60)]
    a, b = (" ".join(words[:28] + words[28 + 14 * k : 42 + 14 * k]).encode() for k in (0, 1))
    sig = lines.signatures([a, b])
    return [(k, k, int(lines._lengths(sig)[k]), bytes(sig[k, 4 : lines._WIDE]), None, x) for k, x in enumerate((a, b))]


def test_a_pair_is_measured_once(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    rows, real = _two_lines(), lines.alike(80)

    def alike(percent):
        def same(a, b):
            with open(log, "a") as f:
                f.write("x")
            return real(a, b)

        return same

    monkeypatch.setattr(lines, "alike", alike)
    keys = lines._keys(np.frombuffer(rows[0][3] + rows[1][3], np.uint16).reshape(2, -1), 0, 0, lines.KEYS)
    assert (keys[0] == keys[1]).sum() > 2
    nodes = spark.createDataFrame(rows, "id long, c long, n int, long binary, short binary, text binary")
    got = [lines._confirmed(nodes, 2, 400.0, k, k + 8, 80).collect() for k in range(0, lines.KEYS, 8)]
    assert not any(got) and open(log).read() == "x"


def test_packed_rows_follow_the_data(spark):
    rows = [(k, *x[1:]) for k, x in enumerate(_two_lines() * 200)]
    nodes = spark.createDataFrame(rows, "id long, c long, n int, long binary, short binary, text binary").drop("text")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        packed = [lines._dealt(x, len(rows), 0, 4, 8 * lines.WORDS).agg(F.count(F.lit(1)), F.sum(F.length("entries"))).first() for x in (nodes.repartition(50), nodes.coalesce(1))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert packed[0][1] == packed[1][1] == 4 * 400 * 8 * lines.WORDS
    least = 2 * spark.sparkContext.defaultParallelism
    assert packed[0][0] <= least * 4 * least
