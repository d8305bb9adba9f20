"""Phrases that stand together more often than their parts, by best-first branch and bound.

Texts are cut into pieces and words; per language, a phrase's score is the
least, over its cuts in two, of 1000 a n / (l r), where a, l and r count the
phrase and its parts and n all words. Since a <= r, no phrase that begins with
a word of count f scores over 1000 n / f: that bound orders the search.

The frontier holds the phrases (at first, words) of at least ``min_count`` that
have not been grown. Each round grows the best-bounded part of it by one word:
a pass over the encoded texts counts the hashes of what they grow to, and a
second one counts exactly, word by word, what a frequent hash may stand for. It
scores what is new, and raises the language's threshold to the score of its ``top``-th surviving
phrase; entries bounded below it leave the frontier. The search ends when none
is left. A part that has not been met yet is counted with the next round. Both
passes follow only the beginnings of what they look for.

Whether a phrase lies inside a longer one as frequent as itself is seen while
counting: all its occurrences then have the same word before (or after) them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.common import by_bytes, in_bits, key_bits
from marketlake.session import scratch_path

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
#: A round grows the best-bounded phrases up to about this share of a language's words.
ROUND_SHARE = 0.5
#: Words of text that a task counts together, and distinct words that it remembers between texts.
_CHUNK, _HELD = 3_000_000, 300_000
#: Bytes of text that are cut into words, and written as a row of codes, at once; bytes of a row group of such rows.
_PIECE, _ROW_GROUP = 2 << 20, 32 << 20
#: What the passes do with a phrase: count what it grows to by one word, or the phrase itself.
_GROW, _COUNT = 1, 2

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz.........")


def spaced(text: bytes | None) -> bytes:
    """Lower-case words of a UTF-8 text between spaces, with b'.' wherever a piece ends."""
    return (text or b"").translate(_LOWER).replace(b".", b" . ")


def tokens(text: bytes | None) -> list[bytes]:
    return spaced(text).split()


def _by_lang(batch: pa.RecordBatch, limit: int):
    """(lang, texts joined by piece ends, of about ``limit`` bytes) of a batch of (lang, text)."""
    held: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
        held.setdefault(lang, []).append(text.as_py() or b"")
    for lang, texts in held.items():
        for run in by_bytes(texts, len, limit):
            yield lang, b".".join(run)


def _coded(text: bytes | None) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of a text's tokens, in the order of first use, and the distinct tokens."""
    words = spaced(text).strip()
    if not words:
        return np.zeros(0, np.int32), []
    whole = pa.Array.from_buffers(
        pa.large_binary(), 1, [None, pa.py_buffer(np.array([0, len(words)], np.int64)), pa.py_buffer(words)]).view(pa.large_string())
    found = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
    _, ends, data = found.dictionary.buffers()
    ends, data = np.frombuffer(ends, np.int64)[:len(found.dictionary) + 1].tolist(), data.to_pybytes()
    return found.indices.to_numpy(), [data[i:j] for i, j in zip(ends, ends[1:])]


def _hash(word: bytes, seed: int) -> int:
    """64-bit hash of a word, never 0; that of b'.' is 0."""
    return 0 if word == b"." else xxhash.xxh64_intdigest(word, seed) or 1


class _Hashes(dict):
    """Hashes of the words met since the last ``forget``; ``names`` has the words of those put there."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed
        self.names: dict[int, bytes] = {}

    def __missing__(self, word: bytes) -> int:
        self[word] = h = _hash(word, self.seed)
        return h

    def codes(self, text: bytes | None) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        at, words = _coded(text)
        return at, words, np.array([self[t] for t in words], np.uint64)

    def of(self, text: bytes | None) -> np.ndarray:
        at, _, h = self.codes(text)
        return h[at]

    def forget(self) -> None:
        self.clear()
        self.names.clear()


def _check(word: bytes) -> int:
    """A second hash: with the first one it tells any two words apart."""
    return xxhash.xxh3_64_intdigest(word)


def _lang(name: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(name.encode())], np.uint64)


def _grown(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of the phrase without its last word."""
    h = key * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


# --- words ------------------------------------------------------------------------

def _word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, h, f, clash) of all words; clash: two words have this hash."""

    def count(batches):
        schema = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("check", pa.int64()), ("c", pa.int64())])
        held: dict[str, list[bytes]] = {}
        size = 0

        def out():
            while held:
                lang, texts = held.popitem()
                # words of one hash have a row each: their checks differ
                at, words = _coded(b".".join(texts))
                h = np.array([_hash(t, seed) for t in words], np.uint64)
                c = np.bincount(at, minlength=len(h))
                check = np.array([_check(t) for t in words], np.uint64)
                some = h != 0
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), int(some.sum())), pa.array(h[some].view(np.int64)),
                     pa.array(check[some].view(np.int64)), pa.array(c[some], pa.int64())], schema=schema)

        for b in batches:
            for lang, text in _by_lang(b, _PIECE):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= 6 * _CHUNK:
                    yield from out()
                    size = 0
        yield from out()

    return (docs.mapInArrow(count, "lang string, h bigint, check bigint, c bigint").groupBy("lang", "h")
            .agg(F.sum("c").alias("f"), (F.min("check") != F.max("check")).alias("clash")))


def _encoded(docs: DataFrame, seed: int, frequent) -> DataFrame:
    """(lang, hashes, codes, h, word): runs of texts as numbers of words, and the numbers' word hashes.

    A hash of 0 stands for a piece's end or a run of infrequent words. Rows with
    a word are no texts: they give the words of the frequent hashes that a task
    has met.
    """

    def encode(batches):
        bits, hashes, met = frequent.value, _Hashes(seed), {}
        schema = pa.schema([("lang", pa.string()), ("hashes", pa.binary()), ("codes", pa.binary()),
                            ("h", pa.int64()), ("word", pa.string())])

        def out():
            for lang, seen in met.items():
                h = sorted(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(h)), *(pa.nulls(len(h), pa.binary()) for _ in range(2)),
                     pa.array(np.array(h, np.uint64).view(np.int64)),
                     pa.array([hashes.names[x] for x in h], pa.binary()).cast(pa.string())], schema=schema)
            met.clear()
            hashes.forget()

        for b in batches:
            for lang, text in _by_lang(b, _PIECE):
                at, words, h = hashes.codes(text)
                some = in_bits(bits, _grown(_lang(lang), h)) & (h != 0)
                h = h[some]
                met.setdefault(lang, set()).update(h.tolist())
                hashes.names.update(zip(h.tolist(), (words[i] for i in np.flatnonzero(some).tolist())))
                at = np.where(some, np.cumsum(some), 0)[at]
                at = at[(at != 0) | np.r_[False, at[:-1] != 0]] if len(at) else at
                codes = at.astype(_code_type(len(h) + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([np.r_[np.zeros(1, np.uint64), h].tobytes()], pa.binary()),
                     pa.array([codes.tobytes()], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.string())], schema=schema)
                if len(hashes) > _HELD:
                    yield from out()
        yield from out()

    return docs.mapInArrow(encode, "lang string, hashes binary, codes binary, h bigint, word string")


def _code_type(n: int):
    return np.uint16 if n <= 1 << 16 else np.uint32


# --- growing ----------------------------------------------------------------------

def _keys(asked: DataFrame) -> DataFrame:
    """(key): hashes of all beginnings of the phrases (lang, words, what), and what is asked of the phrases themselves."""

    def keys(batches):
        for b in batches:
            langs, words, what = (c.to_pylist() for c in b.columns)
            sizes = np.array([len(x) // 8 for x in words])
            for m in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == m).tolist()
                w = np.frombuffer(b"".join(words[i] for i in some), ">u8").astype(np.uint64).reshape(-1, m)
                key, out = np.array([_lang(langs[i])[0] for i in some], np.uint64), []
                for j in range(m):
                    key = _grown(key, w[:, j])
                    out.append(key)
                out.append(_grown(key, np.array([what[i] for i in some], np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64))], names=["key"])

    return asked.select("lang", "words", "what").mapInArrow(keys, "key bigint")


def _chunks(batches, bits: np.ndarray, longest: int):
    """{lang: words of many texts, zeros around them, and where a phrase asked for in ``bits`` may begin} again and again."""

    def joined(held):
        out = {}
        while held:
            lang, runs = held.popitem()
            # one word before and those after any other may be looked at
            words = np.concatenate([np.zeros(1, np.uint64), *(w for w, _ in runs), np.zeros(longest + 2, np.uint64)])
            out[lang] = words, 1 + np.flatnonzero(np.concatenate([x for _, x in runs]))
        return out

    held, size = {}, 0
    for b in batches:
        for lang, hashes, codes in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
            h = np.frombuffer(hashes.as_buffer(), np.uint64)
            at = np.frombuffer(codes.as_buffer(), _code_type(len(h)))
            first = in_bits(bits, _grown(_lang(lang), h)) & (h != 0)
            held.setdefault(lang, []).extend(((h[at], first[at]), (np.zeros(1, np.uint64), np.zeros(1, bool))))
            size += len(at)
            if size >= _CHUNK:
                yield joined(held)
                size = 0
    yield joined(held)


def _walk(words: np.ndarray, at: np.ndarray, lang: str, bits: np.ndarray, longest: int):
    """(length, places, hashes) of the phrases all of whose beginnings are in ``bits``, from places where the first word is."""
    key = _grown(_lang(lang), words[at])
    for m in range(1, longest + 1):
        if m > 1:
            word = words[at + m - 1]
            ok = word != 0
            at, key = at[ok], _grown(key[ok], word[ok])
            hit = in_bits(bits, key)
            at, key = at[hit], key[hit]
        if not len(at):
            return
        yield m, at, key


def _asked(bits: np.ndarray, key: np.ndarray, what: int) -> np.ndarray:
    return in_bits(bits, _grown(key, np.array([what], np.uint64)))


def _grown_here(words: np.ndarray, at: np.ndarray, key: np.ndarray, m: int, bits: np.ndarray):
    """(places, hashes) of the phrases one word longer than those that are to be grown."""
    ok = _asked(bits, key, _GROW)
    at, key = at[ok], key[ok]
    word = words[at + m]
    ok = word != 0
    return at[ok], _grown(key[ok], word[ok])


def _counted(words: np.ndarray, p: np.ndarray, full: np.ndarray, size: int):
    """(words, count, before, after) arrays of the phrases of ``size`` words and hashes ``full`` at ``p``.

    before and after are the word next to all occurrences, or 0 if they differ.
    """
    order = np.argsort(full, kind="stable")
    p, full = p[order], full[order]
    new = np.r_[True, full[1:] != full[:-1]]
    phrases_ = np.stack([words[p + j] for j in range(size)], axis=1)
    if (phrases_[1:] != phrases_[:-1]).any(axis=1)[~new[1:]].any():  # two phrases with one hash
        order = np.lexsort(phrases_.T[::-1])
        p, phrases_ = p[order], phrases_[order]
        new = np.r_[True, (phrases_[1:] != phrases_[:-1]).any(axis=1)]
    start = np.flatnonzero(new)
    same = []
    for side in (words[p - 1], words[p + size]):
        least, most = np.minimum.reduceat(side, start), np.maximum.reduceat(side, start)
        same.append(np.where(least == most, least, 0))
    return phrases_[start], np.diff(np.r_[start, len(p)]), same[0], same[1]


def _likely(texts: DataFrame, shared, longest: int, min_count: int) -> DataFrame:
    """(key): hashes that stand for at least ``min_count`` occurrences of grown phrases, of one or by chance of several."""

    def count(batches):
        bits = shared.value
        for held in _chunks(batches, bits, longest):
            for lang, (w, at) in held.items():
                for m, p, key in _walk(w, at, lang, bits, longest):
                    key, c = np.unique(_grown_here(w, p, key, m, bits)[1], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c, pa.int64())], names=["key", "c"])

    return (texts.mapInArrow(count, "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c"))
            .where(F.col("c") >= min_count).select("key"))


def _grow(texts: DataFrame, shared, likely, deepest: int, longest: int, min_count: int) -> DataFrame:
    """(lang, words, what, size, f, inside): the frequent phrases one word longer than the shared set's, and those to count."""

    def grow(batches):
        bits = shared.value
        for held in _chunks(batches, bits, longest):
            for lang, (w, at) in held.items():
                for m, p, key in _walk(w, at, lang, bits, deepest):
                    found = []
                    if likely is not None:
                        q, full = _grown_here(w, p, key, m, bits)
                        hit = in_bits(likely.value, full)
                        found.append((_GROW, q[hit], full[hit], m + 1))
                    hit = _asked(bits, key, _COUNT)
                    found.append((_COUNT, p[hit], key[hit], m))
                    for what, q, full, size in found:
                        if not len(q):
                            continue
                        words, c, before, after = _counted(w, q, full, size)
                        n = len(c)
                        buffers = [None, pa.py_buffer(np.arange(0, 8 * size * n + 1, 8 * size, dtype=np.int32)),
                                   pa.py_buffer(words.astype(">u8").tobytes())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(pa.scalar(lang, pa.string()), n), pa.Array.from_buffers(pa.binary(), n, buffers),
                             pa.repeat(pa.scalar(what, pa.int32()), n), pa.array(c, pa.int64()), pa.array(before.view(np.int64)),
                             pa.array(after.view(np.int64))], names=["lang", "words", "what", "c", "before", "after"])

    size = (F.length("words") / 8).cast("int")
    counted = (texts.mapInArrow(grow, "lang string, words binary, what int, c bigint, before bigint, after bigint")
               .groupBy("lang", "words", "what")
               .agg(F.sum("c").alias("f"), *(f(c).alias(f"{n}_{c}") for c in ("before", "after")
                                             for n, f in (("least", F.min), ("most", F.max)))))
    inside = F.lit(False)
    for c in ("before", "after"):
        inside = inside | ((F.col(f"least_{c}") == F.col(f"most_{c}")) & (F.col(f"least_{c}") != 0))
    return counted.where(F.col("f") >= min_count).select(
        "lang", "words", "what", size.alias("size"), "f", ((size < longest) & inside).alias("inside"))


def _scored(new: DataFrame, known: DataFrame) -> DataFrame:
    """Cuts of ``new`` at their counts: (lang, words, f, n, best, missing).

    best is the lowest (score, first words, l, r); missing lists the parts whose count is not known.
    """
    cuts = new.select("*", F.explode(F.expr("sequence(1, cast(length(words) / 8 as int) - 1)")).alias("cut")).select(
        "lang", "words", "f", "n", "cut", F.expr("substring(words, 1, 8 * cut)").alias("left"),
        F.expr("substring(words, 8 * cut + 1)").alias("right"))
    part = lambda side, n: known.select("lang", F.col("words").alias(side), F.col("f").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"], "left")
    exact = ("(CAST(1000 AS DECIMAL(4, 0)) * CAST(f AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)))"
             " div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    cuts = cuts.withColumn("score", F.expr(exact))
    return cuts.groupBy("lang", "words", "f", "n").agg(
        F.min(F.when(F.col("r").isNotNull(), F.struct("score", "cut", "l", "r"))).alias("best"),
        F.collect_list(F.when(F.col("r").isNull(), F.col("right"))).alias("missing"))


def phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
            longest: int = LONGEST, top: int = TOP, round_share: float = ROUND_SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line breaks, words at
    spaces and tabs. Phrases of fewer than ``min_count`` occurrences, or inside a
    longer one (at most ``longest`` words) of as many, are left out. The cut
    with the lowest score counts, then the earliest. Order: score, a (both
    falling), phrase in byte order. A null language is 'und', a null text is
    empty; repeated rows count again; an empty table gives no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"phrases-{name}")
        df.write.option("parquet.block.size", _ROW_GROUP).parquet(path)
        return spark.read.parquet(path)

    seed = 0
    while True:
        words = kept(_word_counts(docs, seed), "words")
        if words.where("clash").isEmpty():
            break
        seed += 1
    totals = kept(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")

    def first_keys(batches):
        for b in batches:
            langs, h = b.column(0).to_pylist(), b.column(1).to_numpy().view(np.uint64)
            start = np.array([_lang(x)[0] for x in langs], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_grown(start, h).view(np.int64))],
                                             names=["lang", "h", "f", "key"])

    frequent = words.where(F.col("f") >= min_count).select("lang", "h", "f")
    bytes8 = F.unhex(F.lpad(F.hex("h"), 16, "0"))
    bound = F.expr("(CAST(1000 AS DECIMAL(4, 0)) * CAST(n AS DECIMAL(19, 0))) div CAST(f AS DECIMAL(19, 0))")
    level = kept(frequent.mapInArrow(first_keys, "lang string, h bigint, f bigint, key bigint").join(totals, "lang").select(
        "lang", bytes8.alias("words"), "key", F.lit(1).alias("size"), "f", "n", bound.alias("bound")), "level")
    common = spark.sparkContext.broadcast(key_bits(level, level.count()))
    encoded = kept(_encoded(docs, seed, common), "texts")
    common.destroy()
    texts = encoded.where("word IS NULL").select("lang", "hashes", "codes")
    names = encoded.where("word IS NOT NULL").select("lang", "h", "word")
    frontier, known = level.drop("key"), level.select("lang", "words", "f")
    best = waiting = None
    while True:
        # the best of the frontier, by powers of two of the bound, up to a share of each language's words
        binned = frontier.withColumn("bin", F.floor(F.log2(F.col("bound") + 1)).cast("int"))
        by_bin = Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        cut = (binned.groupBy("lang", "bin").agg(F.sum("f").alias("s"), F.max("n").alias("n"))
               .withColumn("before", F.coalesce(F.sum("s").over(by_bin), F.lit(0)))
               .where(F.col("before") <= F.col("n") * round_share).groupBy("lang").agg(F.min("bin").alias("least_bin")))
        marked = binned.join(cut, "lang").withColumn("now", F.col("bin") >= F.col("least_bin"))
        asked = marked.where("now").select("lang", "words", "size", "n", "bound", F.lit(_GROW).alias("what"))
        if waiting is not None:
            asked = asked.unionByName(waiting.select("lang", F.explode("missing").alias("words")).distinct().select(
                "lang", "words", (F.length("words") / 8).cast("int").alias("size"), F.lit(None).cast("bigint").alias("n"),
                F.lit(None).cast("bigint").alias("bound"), F.lit(_COUNT).alias("what")))
        asked = kept(asked, "asked")
        sizes = {(r["what"], r["size"]): r["count"] for r in asked.groupBy("what", "size").count().collect()}
        if not sizes:
            break
        shared = spark.sparkContext.broadcast(key_bits(_keys(asked), sum((m + 1) * c for (_, m), c in sizes.items())))
        grown = max((m for what, m in sizes if what == _GROW), default=0)
        likely = None
        if grown:
            heavy = kept(_likely(texts, shared, grown, min_count), "likely")
            likely = spark.sparkContext.broadcast(key_bits(heavy, heavy.count()))
        new = _grow(texts, shared, likely, max(m for _, m in sizes), longest, min_count)
        # without what false hits have found
        begin = F.when(F.col("what") == _GROW, F.expr("substring(words, 1, length(words) - 8)")).otherwise(F.col("words"))
        new = kept(new.withColumn("begin", begin).join(
            asked.select("lang", "what", F.col("words").alias("begin"), "n", "bound"), ["lang", "what", "begin"]).drop("begin"), "known")
        for sent in (shared, likely):
            if sent is not None:
                sent.destroy()
        # a phrase may come twice, as grown and as counted: that changes no lowest cut
        known = known.unionByName(new.select("lang", "words", "f"))
        new = new.where(F.col("what") == _GROW)
        open_ = new.where(~F.col("inside")).select("lang", "words", "f", "n")
        if waiting is not None:
            open_ = open_.unionByName(waiting.drop("missing"))
        result = kept(_scored(open_, known), "scored")
        full = result.where(F.size("missing") == 0).select("lang", "words", F.col("f").alias("a"), "n", "best.*")
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        best = kept((full if best is None else best.unionByName(full)).withColumn("at", F.rank().over(order))
                    .where(F.col("at") <= top).drop("at"), "best")
        least = (best.groupBy("lang").agg(F.min("score").alias("least"), F.count("*").alias("held"))
                 .where(F.col("held") >= top).select("lang", "least"))
        columns = ["lang", "words", "size", "f", "n", "bound"]
        frontier = kept(marked.where("not now").select(columns).unionByName(new.where(F.col("size") < longest).select(columns))
                        .join(least, "lang", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
                        .drop("least"), "frontier")
        # what still lacks the count of a part, unless the parts that are known settle that it is too low
        waiting = kept(result.where(F.size("missing") > 0).join(least, "lang", "left")
                       .where(F.col("least").isNull() | F.col("best").isNull() | (F.col("best.score") >= F.col("least")))
                       .select("lang", "words", "f", "n", "missing"), "waiting")
    return _first(best, names, top) if best is not None else _none(spark)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")


def _first(near: DataFrame, names: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, with their words; ties in score and count are told apart by the text."""
    position = near.select("lang", "words", F.posexplode(F.expr(
        "transform(sequence(1, cast(length(words) / 8 as int)), i -> substring(words, 8 * i - 7, 8))")).alias("at", "w"))
    names = names.select("lang", F.unhex(F.lpad(F.hex("h"), 16, "0")).alias("w"), "word")
    wanted = names.join(position.select("lang", "w").distinct(), ["lang", "w"], "left_semi").distinct()
    text = (position.join(wanted, ["lang", "w"]).groupBy("lang", "words")
            .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
            .select("lang", "words", F.array_join(F.col("parts.word"), " ").alias("phrase")))
    rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (near.join(text, ["lang", "words"]).withColumn("rank", F.row_number().over(rank).cast("bigint"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
