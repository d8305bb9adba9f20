"""Nearest neighbours, whitening and phrases against plain versions."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import phrases, posting_lists, queries, whitening
from marketlake.llm.common import table

# --- nearest neighbours -----------------------------------------------------------


def plain_nearest(rows, k, asked):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, v in rows:
        if asked(i):
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i)
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def found(df):
    out = collections.defaultdict(dict)
    for r in df.collect():
        out[r.query_id][r["rank"]] = (r.vec_id, r.score)
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in out.values())
    return {q: [x[i] for i in sorted(x)] for q, x in out.items()}


def test_search_recall_on_the_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    x, ids = np.array([v for _, v in rows]), [i for i, _ in rows]
    # many small lists, so that the ratio leaves some of them out
    got = found(posting_lists.nearest(df, list_rows=32))
    hits = 0
    for n, i in enumerate(ids):
        if i % 20 == 0:
            s = x @ x[n]
            s[n] = -9
            hits += len({ids[j] for j in np.argsort(-s)[:20]} & {j for j, _ in got[i]})
            assert all(abs(s[ids.index(j)] - score) < 1e-12 for j, score in got[i])
    assert hits >= 0.9 * 20 * len(got) and len(got) == sum(i % 20 == 0 for i in ids)


def test_few_rows_ties_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 2.0]), (3, [1.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 1.0]), (11, [-1.0, 0.5]), (11, [-1.0, 0.5]), (60, [0.0, 0.0])]
    rows = [(i, v, "x", 1) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, is_query string, h1 int")
    ok = [(i, v + [0.0] * (2 - len(v))) for i, v in [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 2.0]), (3, [1.0]), (11, [-1.0, 0.5])]]
    assert found(posting_lists.nearest(df)) == plain_nearest(ok, 20, lambda i: i % 20 == 0)
    assert found(posting_lists.nearest(df, k=2)) == plain_nearest(ok, 2, lambda i: i % 20 == 0)
    assert found(posting_lists.nearest(df, F.col("vec_id") == 3)) == plain_nearest(ok, 20, lambda i: i == 3)
    assert posting_lists.nearest(df.limit(0)).collect() == []
    assert posting_lists.nearest(df.where("vec_id = 60")).collect() == []


def test_a_vector_shared_by_a_third_of_the_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 6)) * rng.uniform(0.1, 5, (300, 1))  # of many lengths
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_nearest(rows, 20, lambda i: i % 20 == 0)
    got = found(posting_lists.nearest(df, list_rows=8, ratio=9.0))
    assert {q: [j for j, _ in v] for q, v in got.items()} == {q: [j for j, _ in v] for q, v in want.items()}
    # so few rows on the lists that some queries are searched again
    assert {q: len(v) for q, v in found(posting_lists.nearest(df, list_rows=8, ratio=0.0)).items()} == dict.fromkeys(want, 20)


def test_walk_and_replicas():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 12)).astype(np.float32)
    c = posting_lists.balanced_centroids(x, 200)
    sizes = np.bincount(((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1), minlength=200)
    assert len(c) == 200 and sizes.max() < 5 * sizes.mean()
    r, l, d = posting_lists.graph_search(x, c, posting_lists.centroid_graph(c), 0.1)
    real = np.sqrt(((x[:, None] - c[None]) ** 2).sum(axis=2))
    assert np.allclose(real[r, l], d, atol=1e-3)
    want = real <= 1.1 * real.min(axis=1, keepdims=True)
    assert len(r) >= 0.95 * want.sum() and (d <= 1.1001 * real[r].min(axis=1) + 1e-3).mean() > 0.98
    r, l = posting_lists.closure(x, c, posting_lists.centroid_graph(c))
    assert set(r) == set(range(len(x))) and len(x) < len(r) <= posting_lists.REPLICAS * len(x)


# --- whitening --------------------------------------------------------------------

def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [[9, 5, 4, 3, 2, 1], [5, 5, 5, 5, 5, 1], [1e9, 7, 1e-2, 1e-12], [3], [2, 0, 0], list(range(80)),
                                    [1 + 1e-9, 1, 1, 0.5]])
def test_leading_pairs(values):
    v = spectrum(np.array(values, float))
    e, u = whitening.leading_pairs(v, 4)
    want = [x for x in sorted(values, reverse=True)[:4] if x > 1e-10]
    assert len(e) == len(want) and np.allclose(e, want, rtol=1e-9, atol=1e-12 * max(values))
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-10) and np.allclose(v @ u, u * e, atol=1e-12 * max(values))


def test_inertia_and_many_intervals():
    v = spectrum(np.r_[np.linspace(1, 2, 30), np.linspace(5, 6, 30)], 1)
    assert [whitening.n_above(v, s) for s in (0, 0.99, 1.5, 3, 5.99, 7)] == [60, 60, 45, 30, 1, 0]
    assert whitening.n_above(np.array([[0.0, 1], [1, 0]]), 0) == 1
    e, u = whitening.leading_pairs(v, 45, per_interval=6)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:45]) and np.allclose(u.T @ u, np.eye(45), atol=1e-9)


def test_whitened_table(spark, sf_dir):
    rows = queries.op12_whitening(spark, sf_dir).collect()
    src = {r.vec_id: r.embedding for r in table(spark, sf_dir, "embeddings").collect()}
    x = {i: np.floor(256 * np.array(v, float)) for i, v in src.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, p = np.linalg.eigh(np.cov(fit.T, bias=True))
    assert len(rows) == 4 * len(src)
    sign = {}
    for r in rows:
        own = (x[r.vec_id] - s / n) @ p[:, -r.component] / np.sqrt(e[-r.component])
        sign.setdefault(r.component, np.sign(own * r.whitened))
        assert abs(own * sign[r.component] - r.whitened) < 1e-9 and r.n == n
        assert r.deviation == sum(int(n * a - b) ** 2 for a, b in zip(x[r.vec_id], s)) == int(r.deviation_exact)
        assert abs(r.explained * e.sum() / e[-r.component] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    schema = "vec_id string, embedding array<double>, x int, component string"
    rows = [("a", [1.0, 2.0]), ("a", [1.0, 2.0]), (None, [0.5]), ("c", []), ("d", None), ("e", [float("nan"), 1.0]), ("f", [None]),
            ("g", [float("inf")]), ("h", [1.0, 2.001])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], schema)
    got = whitening.whiten(df).collect()
    # x vectors: (256, 512) for a and h, (128, 0), (0, 0): three, of two dimensions
    assert collections.Counter(r.vec_id for r in got) == {"a": 4, None: 2, "c": 2, "h": 2} and {r.n for r in got} == {3}
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("vec_id = 'a'")).collect() == []
    big = spark.createDataFrame([(1, [2.0**50, 1.0]), (2, [-(2.0**50), 3.0]), (3, [0.0, 2.0])], "vec_id int, embedding array<double>")
    got = {r.vec_id: r for r in whitening.whiten(big, components=1).collect()}
    x = {1: [2**58, 256], 2: [-(2**58), 768], 3: [0, 512]}
    s = [sum(v[j] for v in x.values()) for j in (0, 1)]
    for i, v in x.items():
        want = sum((3 * a - b) ** 2 for a, b in zip(v, s))
        assert int(got[i].deviation_exact) == want and got[i].deviation == (want if want < 2**63 else None)


# --- phrases ----------------------------------------------------------------------

def plain_phrases(rows, least, longest, top):
    f = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(x for p, x in c.items() if len(p) == 1)
        some = {p for p, x in c.items() if x >= least and len(p) > 1}
        inside = {p[i:j] for p in some for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * c[p] >= 100 * c[p[i:j]]}
        best = {p: min((1000 * c[p] * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))) for p in some - inside}
        order = sorted(best, key=lambda p: (-best[p][0], -c[p], " ".join(p).encode()))
        out += [(lang, i + 1, " ".join(p), c[p], c[p[:best[p][1]]], c[p[best[p][1]:]], n, best[p][0])
                for i, p in enumerate(order[:top])]
    return sorted(out)


@pytest.mark.parametrize("least, longest, top, share", [(5, 5, 50, 0.5), (4, 4, 2000, 0.1)])
def test_phrases_of_the_table(spark, sf_dir, least, longest, top, share):
    docs = table(spark, sf_dir, "documents")
    got = phrases.phrases(docs, min_count=least, longest=longest, top=top, round_share=share)
    assert sorted(map(tuple, got.collect())) == plain_phrases(docs.select("lang", "text").collect(), least, longest, top)


def test_phrases_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_HELD", 3)
    monkeypatch.setattr(phrases, "_CHUNK", 5)
    rows = [(None, "A b a b. a B;a b\x0bc a b"), ("und", "a b"), ("x", None), ("x", ""), ("x", " .,\t\x0c!? "), ("y", "é É é É é É"),
            ("y", "É é " * 3000), ("z", "u v w u v w u v w u v w x"), ("z", "u v w\tx"), ("z", "u v w\tx"), ("", "q q q q")]
    df = spark.createDataFrame([(a, b, 1, "k") for a, b in rows], "lang string, text string, words int, key string")
    got = phrases.phrases(df, min_count=2)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 2, 5, 2000)
    assert phrases.phrases(df.limit(0), min_count=2).collect() == [] and phrases.phrases(df.where("lang = 'x'")).collect() == []


def test_words_with_one_hash_are_told_apart(spark):
    docs = spark.createDataFrame([("x", "a b c a b d"), ("y", "d")], "lang string, text string").repartition(1)
    assert not phrases._word_counts(docs, 0).where("clash").count()
    hashes = phrases._Hashes(0)
    hashes.update({b"b": 7, b"d": 7})
    hashes.names[7] = b"b"
    assert hashes.of(b"B. D").tolist() == [7, 0, 7] and phrases._check(b"b") != phrases._check(b"d")


def test_words_cut_by_arrow_are_those_of_split():
    rnd = random.Random(2)
    for n in [0, 1, 2] + [30] * 500:
        text = "".join(rnd.choice(" \t\n\x0b\x0c\r\x1c\x85\xa0 .,;:!?aAbZé\0日") for _ in range(n)).encode()
        at, words = phrases._coded(text)
        assert [words[i] for i in at] == phrases.tokens(text) and len(set(words)) == len(words)
    assert phrases._coded(None)[1] == []


def test_missing_parts_are_counted_and_sets_of_hashes_are_let_go(spark, monkeypatch):
    # "a b" to "a b c d" come often, but only the rare "x" promises much: their counts are asked for
    rows = [("l", "x a b c d")] * 3 + [("l", "a b c d y")] * 40 + [("l", "a. b. c. d. y")] * 40
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    sent, gone = [], []
    cls = type(spark.sparkContext.broadcast(0))
    first, last = cls.__init__, cls.destroy
    monkeypatch.setattr(cls, "__init__", lambda self, *a, **k: sent.append(1) or first(self, *a, **k))
    monkeypatch.setattr(cls, "destroy", lambda self, *a, **k: gone.append(1) or last(self, *a, **k))
    got = phrases.phrases(df, min_count=2, top=1, round_share=0.001)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 2, 5, 1)
    assert sent and len(sent) == len(gone)
