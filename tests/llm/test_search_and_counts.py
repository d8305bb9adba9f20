"""Decontamination, token counts, BPE: against brute force and the tokenizers' own library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlake.llm import decontaminate, token_counts, trie_bpe
from marketlake.llm.common import table

ODD = [
    None, "", " ", "a<|endoftext|>b C <|startoftext|>", "ΑΣ ΣΑΣ Σ", "a\x1cb \x85c d", "é é İstanbul ﬁ",
    "'s don't I'LL 12 3½ ²", " x　y  z\n\n", "日本語 テキスト 😀😀", "a  b   c \t\n d\n\n\ne f  ",
    "a   b \x1c d!\x1c!", "aaaaaaaaaaaa bbbbbbbbb " * 400, "!!! ??? ...---", "\0abc \0<|endoftext|>", "x" * 20_000,
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rnd = random.Random(1)
    letters = "aábcdeßéñ 'stl.,!1２ \ń "
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(400)] + [
        r.text for r in table(spark, sf_dir, "documents").select("text").collect()]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i if i % 50 else None, t, "x", i) for i, t in enumerate(texts)] + [(7, ODD[6], "again", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, n_words bigint").repartition(5)


@pytest.mark.parametrize("window,block_bytes", [(3, 1 << 20), (4, 900)])
def test_contamination_equals_brute_force(spark, window, block_bytes):
    rnd = random.Random(5)
    some = ["alpha", "beta", "gamma", "délta", "x", "of", "the", "a1"]
    sep = [" ", "\n", ", ", "!! ", "- "]

    def text(n):
        return "".join(rnd.choice(some).title() + rnd.choice(sep) for _ in range(n))

    items = {i: text(rnd.randrange(2, 12)) for i in range(12)} | {20: "The", 21: None, 22: "", 23: "..!"}
    docs = {i: text(rnd.randrange(0, 60)) for i in range(60)} | {100: None, 101: "", 102: "the", 103: "x" * 5000}
    docs[104] = items[3] + " " + items[3]
    b = spark.createDataFrame([*items.items(), (3, items[3]), (None, "unheard words")], "item_id bigint, text string")
    d = spark.createDataFrame([(k, t, 1) for k, t in docs.items()], "doc_id bigint, text string, found int").repartition(3)
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"])
           for r in decontaminate.contamination(d, b, window=window, block_bytes=block_bytes).collect()}
    assert got == decontaminate.brute_force(docs, items, window)
    kept = {r.doc_id for r in decontaminate.drop_contaminated(d, b, window=window).collect()}
    assert kept == {k for k, v in got.items() if not v[1]}


def test_contamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id bigint, text string")
    b = spark.createDataFrame([], "item_id bigint, text string")
    assert sorted((r.n_words, r.n_hit) for r in decontaminate.contamination(d, b).collect()) == [(0, 0), (3, 0)]
    assert decontaminate.contamination(d.limit(0), d.toDF("item_id", "text")).count() == 0


def test_token_counts_equal_the_library(docs, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = sorted((len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False)))
                  for t in [*texts, ODD[6]])
    got = token_counts.token_counts(docs, path, limit=100).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


def test_parts_join_to_the_text(texts):
    assert all("".join(token_counts.parts(t)) == t for t in texts if t)


def test_bpe_equals_the_library(docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)

    def want(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert trie_bpe.decode(ids, path) == decoded
        return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest())

    got = trie_bpe.bpe(docs, path, keep=True).collect()
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(map(want, [*texts, ODD[6]]))
    assert all(len(r["ids"]) == r.n_tokens for r in got)


def test_bpe_caches_may_be_emptied(texts, monkeypatch):
    monkeypatch.setattr(trie_bpe, "CACHE_BYTES", 5)
    monkeypatch.setattr(trie_bpe, "CACHE_PAIRS", 5)
    small = trie_bpe.TrieBPE(public_tokenizers.path("word_bpe_49k.json"))
    some = [t or "" for t in texts[:60]]
    assert [small.run([t])[0] for t in some] == trie_bpe.load(public_tokenizers.path("word_bpe_49k.json")).run(some)


def test_empty_table(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert trie_bpe.bpe(d, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_bpe_of_letters_that_python_does_not_know_and_of_nul_before_a_special_string():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), trie_bpe.load(path)
    texts = [f"a{c}b {c}1 {c}{c}" for c in [*trie_bpe._NEW, *map(chr, range(1, 0xD800, 7))]]
    texts += ["\0<|ENDOFTEXT|>", "\0<|endoftext|>", "\0\0<|startoftext|> x", "<|endoftext|>\0", "a\0<|ENDOFTEXT|>b"]
    want = [" ".join(map(str, e.ids)) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [g[1] for g in own.run(texts)] == want


def test_bpe_cache_is_bounded_by_bytes(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    own = trie_bpe.TrieBPE(path)
    monkeypatch.setattr(trie_bpe, "CACHE_BYTES", 50_000)
    for i in range(40):
        own.run([" ".join(f"word{i}x{j}" for j in range(60))])
        assert own.held < 50_000 + 60 * 1000 and len(own.known) < 500


def test_bpe_encodes_pieces_once_and_keeps_those_in_use(monkeypatch):
    own = trie_bpe.TrieBPE(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(trie_bpe, "CACHE_BYTES", 50_000)
    asked, encode = [], own.encode_words
    monkeypatch.setattr(own, "encode_words", lambda words: asked.extend(words) or encode(words))
    for i in range(40):
        own.run([" ".join(["evergreenx, (evergreenx) Evergreenx!", *(f"word{i}x{j}" for j in range(60))])])
        own.run(["evergreenx's\t“evergreenx”"])
    assert asked.count("evergreenx") == 1
    assert len(own.known) + len(own.older) < 500
