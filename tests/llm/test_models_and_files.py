"""Katz model, toxicity, URL lists and WARC archives."""

import collections
import gzip
import hashlib
import itertools
import math
import random
import time
import zlib
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import katz, toxicity, url_lists, warc
from marketlake.session import scratch_path


# --- Katz -------------------------------------------------------------------------

def plain_katz(docs, order, held):
    """Scores by dictionaries, and a check that every distribution sums to 1."""
    counts = [collections.Counter() for _ in range(order + 1)]
    split = lambda t: (t or "").lower().split() + ["</s>"]
    for i, t in docs:
        s = ["<s>"] * (order - 1) + split(t)
        for j in range(order - 1, len(s) if not held(i) else 0):
            for n in range(1, order + 1):
                counts[n][tuple(s[j - n + 1:j + 1])] += 1
    d = {n: katz.discounts(collections.Counter(counts[n].values())) for n in range(1, order + 1)}
    kept = lambda n, c: c * (d[n][c] if c < len(d[n]) else 1)
    total = sum(counts[1].values())
    left = sum(c - kept(1, c) for c in counts[1].values())
    below = total + (left <= 0)
    after = collections.defaultdict(list)
    for n in range(2, order + 1):
        for g, c in counts[n].items():
            after[g[:-1]].append((g, c))
    memo = {}

    def p(g):
        if g not in memo:
            n = len(g)
            if n == 1:
                memo[g] = kept(1, counts[1][g]) / below if g in counts[1] else (left if left > 0 else 1) / below
            elif not after.get(g[:-1]):
                memo[g] = p(g[1:])
            else:
                c = sum(c for _, c in after[g[:-1]])
                k = sum(kept(n, c) for _, c in after[g[:-1]])
                b = c + (c - k < 1e-9)
                memo[g] = (kept(n, counts[n][g]) / b if g in counts[n]
                           else (b - k) / b / (1 - sum(p(x[1:]) for x, _ in after[g[:-1]])) * p(g[1:]))
        return memo[g]

    vocabulary = [g[0] for g in counts[1]] + ["<unk>"]
    for h in list(after)[:40] + [()]:
        assert abs(sum(p(h + (w,)) for w in vocabulary) - 1) < 1e-9
    out = {}
    for i, t in docs:
        s = ["<s>"] * (order - 1) + [w if (w,) in counts[1] else "<unk>" for w in split(t)]
        n = len(s) - order + 1
        base = sum(math.log10((counts[1][(w,)] + 0.1) / (total + 0.1 * len(vocabulary))) for w in split(t))
        out[i] = (n, sum((w,) in counts[1] for w in split(t)), total, base,
                  sum(math.log10(p(tuple(s[j:j + order]))) for j in range(n)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_equals_plain_recursion(spark, order):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rnd.choice(words[:rnd.choice([3, 8, 30])]) for _ in range(rnd.randrange(40))) if i % 17 else None)
            for i in range(120)] + [(500, "W1  w2\tw2"), (501, "zz yy zz"), (502, "é" * 4000)]
    want = plain_katz(docs, order, lambda i: zlib.crc32(str(i).encode()) % 4 == 0)
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, score int").repartition(3)
    got = katz.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0, order=order,
                     batch_bytes=700, bucket_bytes=2000).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert abs(r.base_score - want[r.doc_id][3]) < 1e-9 and abs(r.score - want[r.doc_id][4]) < 1e-9


def test_katz_without_training_rows_or_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id bigint, text string")
    assert [r.score for r in katz.score(df, F.lit(True)).collect()] == [0, 0, 0]
    assert katz.score(df.limit(0), F.lit(False)).count() == 0
    assert len({r.score for r in katz.score(df, F.lit(None).cast("boolean")).collect()}) == 2


# --- toxicity ----------------------------------------------------------------------

def test_label_model_finds_accuracies_and_copies():
    """Voters 0 to 3 are good, 4 is noise, 5 copies 4."""
    rnd = np.random.default_rng(1)
    y = rnd.random(60_000) < 0.2
    fire = np.zeros((len(y), toxicity.VOTERS), bool)
    for j in range(4):
        fire[:, j] = rnd.random(len(y)) < np.where(y, 0.6, 0.02)
    fire[:, 4] = rnd.random(len(y)) < 0.2
    fire[:, 5] = np.where(rnd.random(len(y)) < 0.95, fire[:, 4], rnd.random(len(y)) < 0.2)
    votes = (fire * (1 << np.arange(toxicity.VOTERS))).sum(1)
    patterns, place, counts = np.unique(votes, return_inverse=True, return_counts=True)
    bad, good = (np.bincount(place[:600], weights=y[:600] == k, minlength=len(patterns)) for k in (True, False))
    model = toxicity.fit_label_model(patterns, counts, bad, good, steps=150)
    assert (4, 5) in model.pairs
    accuracy = model.accuracies()
    assert all(accuracy[:4] > 0.8) and all(accuracy[4:6] < 0.4)
    q = model.posterior(patterns)[place]
    assert ((q > 0.5) == y).mean() > 0.95


@pytest.fixture(scope="module")
def toxic_docs():
    rnd = random.Random(9)
    stems = ["grumb", "zorka"]
    rows, labels = [], []
    for i in range(900):
        w = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 6))) for _ in range(rnd.randrange(5, 60))]
        bad = i % 6 == 0
        if bad:
            w.insert(rnd.randrange(len(w)), rnd.choice(stems) + rnd.choice("abcdefghijkl"))
        rows.append((i, " ".join(w)))
        if i % 2 == 0 or bad:
            labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, toxic_docs):
    rows, labels = toxic_docs
    docs = spark.createDataFrame([(*r, 0.5) for r in rows] + [(5000, None, 0.0), (5001, "", 0.0), (None, "x" * 9999, 0.0)],
                                 "doc_id bigint, text string, score double").repartition(4)
    given = spark.createDataFrame([(*r, None) for r in labels] + [(None, 1, None), (3, None, None), labels[0] + (None,)],
                                  "doc_id bigint, toxic int, text string")
    model = toxicity.train(docs, toxicity.training_labels(given))
    got = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    assert len(got) == 903 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(i, b) for i, b in labels if toxicity.held_out(i)]
    assert sum(got[i].predicted == b for i, b in held) / len(held) > 0.95
    assert got[5000].score == got[5001].score < 0.5
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_a_rare_toxic_word_is_mined_from_a_large_sample(spark):
    """A word of four toxic documents counts at any size of the sample."""
    rows = [(f"bad{i} text{i}" + " rareslur" * (i < 4), 1) for i in range(1200)] + [(f"good{i} page{i}", 0) for i in range(9000)]
    found = toxicity.mine(spark.createDataFrame(rows, "text string, toxic int"), "text", 2048)
    assert ("rareslur", 4, 0) in found


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.scores(docs, toxicity.train(docs, none)).count() == 2
    assert toxicity.scores(docs.limit(0), toxicity.train(docs.limit(0), none)).count() == 0


# --- URL lists -----------------------------------------------------------------------

def covers(key, url):
    if url is None or "://" not in url:
        return False
    rest = url.split("://", 1)[1]
    authority, slash, path = rest.split("#")[0].split("?")[0].partition("/")
    host = authority.rpartition("@")[2].split(":")[0].lower().rstrip(".")
    kind, value = key.split(":", 1)
    if kind == "host":
        return host == value
    if kind == "domain":
        return "." in value and ("." + host).endswith("." + value) or host == value
    return (host + "/" + path).startswith(value)


def test_url_lists_equal_brute_force(spark):
    rnd = random.Random(11)
    hosts = ["a.b.example.com", "b.example.com", "example.com", "other.org", "localhost"]
    keys = ["host:b.example.com", "domain:example.com", "domain:b.example.com", "prefix:other.org/x/", "host:localhost",
            "prefix:example.com/"]
    day = date(2024, 1, 1)
    events = [(rnd.choice(["spam", "adult", "allow"]), rnd.choice(keys), day + timedelta(rnd.randrange(120)), rnd.random() < 0.6)
              for _ in range(150)]
    events += [events[0], (None, keys[0], day, True), ("spam", None, day, True), ("spam", keys[0], None, True), ("spam", keys[0], day, None)]
    pages = []
    for i in range(200):
        h = rnd.choice(hosts)
        url = rnd.choice(["http://", "HTTPS://u:p@"]) + rnd.choice([h, h.upper()]) + rnd.choice(["", ":80"]) + rnd.choice(
            ["", "/", "/x/", "/x/y.html?q=/z/", "#top", "/X/y"])
        pages.append((i, url, day + timedelta(rnd.randrange(130))))
    pages += [(900, None, day), (901, "no url", day), (902, "http://b.example.com/", None), (3, pages[3][1], pages[3][2])]
    timeline = collections.defaultdict(dict)
    for name, key, at, added in events:
        if None not in (name, key, at, added):
            timeline[name, key][at] = timeline[name, key].get(at, False) or added
    want = {}
    for i, url, at in pages:
        found = [name for (name, key), days in timeline.items() if at is not None and covers(key, url)
                 and (past := [d for d in days if d <= at]) and days[max(past)]]
        bad = [n for n in found if n != "allow"]
        old = want.get(i, (0, set(), False))
        want[i] = (old[0] + len(bad), old[1] | set(bad), old[2] or "allow" in found)
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, fetched date, list string")
    ev = spark.createDataFrame(events, "list string, key string, day date, added boolean")
    got = {r.page_id: r for r in url_lists.filter_urls(df, ev).collect()}
    assert len(got) == len(want)
    for i, (n, lists, allowed) in want.items():
        r = got[i]
        assert (r.n_entries, r.lists, r.allowed) == (n, ",".join(sorted(lists)), allowed), i
        assert r.blocked == (n > 0 and not allowed)
    assert url_lists.filter_urls(df.limit(0), ev).count() == 0
    assert not any(r.blocked for r in url_lists.filter_urls(df, ev.limit(0)).collect())


# --- WARC -----------------------------------------------------------------------------

PAGES = [(1, "http://a/", "x" * 100), (2, "http://b/", "x" * 100), (3, "http://c/", "x" * 99), (4, None, "x" * 99),
         (5, "http://d/\r\nX: y z", None), (6, "http://e/", ""), (7, "http://f/", "é\r\n\r\nWARC/1.0\r\n" * 20),
         (8, "http://g/", "\0\r\n" * 4000), (9, "http://h/", "x" * 100), (9, "http://h/", "x" * 100),
         (None, "http://i/", "é\r\n\r\nWARC/1.0\r\n" * 20)]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip(spark, compress):
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id bigint, url string, html string, digest int").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write(df, path, archive_bytes=3000, compress=compress)
    rows = warc.read(spark, path, payload=True).collect()
    assert {r.kind for r in rows} == {"record"} and len(rows) == len(PAGES)
    first = {}
    for i, _, body in PAGES:
        if i is not None and len((body or "").encode()) >= 100:
            first[body] = min(i, first.get(body, i))
    want = []
    for i, _, body in PAGES:
        data = (body or "").encode()
        to = first.get(body)
        again = to is not None and to != i and len(data) >= 100
        want.append((str(i) if i is not None else "null", len(data), hashlib.sha256(data).hexdigest(),
                     "revisit" if again else "response", str(to) if again else None))
    assert sorted(map(str, want)) == sorted(
        str((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in rows)
    assert all(bytes(r.payload) == (dict((str(i), b) for i, _, b in PAGES).get(r.record_id) or "").encode()
               for r in rows if r.record_type == "response" and r.record_id != "null")
    empty = scratch_path(spark, "warc-test")
    warc.write(df.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def record(i, body):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    return (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:%d>\r\nWARC-Payload-Digest: sha256:%s\r\n"
            b"Content-Length: %d\r\n\r\n" % (i, hashlib.sha256(body).hexdigest().encode(), len(block)) + block + b"\r\n\r\n")


@pytest.mark.parametrize("pack", [bytes, lambda r: gzip.compress(r, mtime=0)])
def test_salvage_after_damage(pack):
    rnd = random.Random(2)
    parts = [pack(record(i, bytes(rnd.randrange(256) for _ in range(300)))) for i in range(9)]
    whole = b"".join(parts)
    starts = [0, *itertools.accumulate(map(len, parts))]
    assert [f[0] for f in warc.read_archive(whole)] == ["record"] * 9
    for _ in range(60):
        data, hit = bytearray(whole), rnd.randrange(len(whole))
        how = rnd.choice(["flip", "cut", "junk"])
        if how == "flip":
            data[hit] ^= 0x55
        elif how == "cut":
            del data[hit:hit + 40]
        else:
            data[hit:hit] = b"WARC/1.0\r\n\x1f\x8b\x08 junk"
        found = list(warc.read_archive(bytes(data)))
        # records and gaps tile the file; every untouched record is there
        assert sum(f[2] for f in found) == len(data)
        assert [f[1] for f in found] == [0, *itertools.accumulate(f[2] for f in found)][:-1]
        ids = [f[3][b"warc-record-id"].decode("latin-1").split(":")[-1].strip(">") for f in found if f[0] == "record"]
        untouched = [i for i in range(9) if starts[i + 1] <= hit or starts[i] >= hit + (40 if how == "cut" else 1)]
        assert {str(i) for i in untouched} <= set(ids) and len(ids) <= 9


def test_salvage_of_huge_lengths_and_false_starts():
    good = record(1, b"abc")
    huge = good.replace(b"Content-Length: ", b"Content-Length: " + b"9" * 5000, 1)
    again = (b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:x-page:2>\r\nContent-Length: %d\r\n\r\n")
    block = b"HTTP/1.1 200 OK\r\nContent-Length: " + b"7" * 30 + b"\r\n\r\n"
    for bad in (huge, again % len(block) + block + b"\r\n\r\n"):
        for pack in (bytes, lambda r: gzip.compress(r, mtime=0)):
            found = list(warc.read_archive(pack(good) + pack(bad) + pack(good)))
            assert [f[0] for f in found][::len(found) - 1] == ["record", "record"] and "gap" in [f[0] for f in found]
    # thousands of false gzip starts are passed over quickly
    noise = b"\x1f\x8b\x08\0\0\0\0\0\0\3" * 20_000
    began = time.perf_counter()
    assert [f[0] for f in warc.read_archive(gzip.compress(good) + noise + gzip.compress(good))] == ["record", "gap", "record"]
    assert time.perf_counter() - began < 20


def test_reading_takes_time_in_proportion(spark):
    one = gzip.compress(record(3, b"x" * 900), mtime=0)

    def seconds(n):
        data, began = one * n, time.perf_counter()
        assert sum(1 for _ in warc.read_archive(data)) == n
        return time.perf_counter() - began

    seconds(500)
    assert seconds(16_000) < 8 * 4 * seconds(2_000)


def test_long_pages_make_more_archives_not_longer_ones(spark):
    rows = [(i, f"http://a/{i}", "y" * (200_000 if i % 10 == 0 else 50) + str(i)) for i in range(60)]
    path = scratch_path(spark, "warc-long")
    warc.write(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(1), path,
               archive_bytes=300_000, compress=False)
    sizes = [r.length for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("length").collect() if r.length]
    assert max(sizes) <= 301_000 and len(sizes) >= 6
    assert warc.read(spark, path).where("kind = 'record'").count() == 60


def test_salvage_of_what_is_no_archive():
    assert list(warc.read_archive(b"")) == []
    assert [f[:3] for f in warc.read_archive(b"no archive at all")] == [("gap", 0, 17)]
    cut = record(1, b"abc") + record(2, b"defg")[:-9]
    assert [f[0] for f in warc.read_archive(cut)] == ["record", "gap"]
