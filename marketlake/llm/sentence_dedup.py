"""Substring dedup over sliding sentence spans.

Every run of ``run`` consecutive sentences is hashed (128 bits). The first
occurrence of a span, in the order of (id, text hash, position), stays; the
sentences covered by any later occurrence are removed. Repeats inside one row
are settled in its own task; across rows, the spans are cut once and written,
the first owner of each repeated span is a pre-aggregated minimum, and the
spans join it by hash, so that a passage shared by a third of all rows is one
row on one side and is split by adaptive execution on the other. Counts of the
spans' 64-bit hashes, also pre-aggregated, say beforehand which spans cannot be
repeated; those take no part in it.

Every span is hashed, however few words it has; ``min_words`` can set a floor.
Rows are named by (id, hash of the text), so repeated rows are one document
and keep their first copy of everything.

A text of fewer than ``run`` sentences is one span. Sentences of more than
``LONG`` words are cut into pieces where their words say so, not where they
begin; pieces then count as sentences.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import fresh, in_bits, key_bits
from marketlake.session import scratch_path

RUN = 3
#: Spans with fewer words are not hashed; 0: every span is.
MIN_WORDS = 0
#: A span that holds a piece of a cut sentence goes on until it has so many words.
PIECE_WORDS = 20
#: A sentence of more words is cut into pieces of at most ``WINDOW`` words.
LONG, WINDOW = 25, 8
#: Word hashes that a task remembers, and the longest such word.
_REMEMBERED, _REMEMBERED_LENGTH = 200_000, 40

#: A sentence ends after a stop (and closing quotes or brackets) before white space, after a CJK stop, or at a line break.
_END = re.compile(r"[.!?…．؟۔।॥։።][\"'”’»)\]]*\s+|[。！？｡](?![。！？｡])[\"'”’»)\]」』）】》〉］]*\s*|\n\s*")

#: Words; of scripts that put no spaces between words, single characters.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+")
_CHARACTER = re.compile(f"[{_UNSPACED}]")


def _n_words(part: str) -> int:
    if part.isascii() or not _CHARACTER.search(part):
        return len(part.split())
    return sum(1 for _ in _WORD.finditer(part))


def _pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """A long sentence cut before each word that has the least hash of any ``WINDOW`` neighbouring words.

    Every window holds a cut, and windows inside a passage cut it alike
    wherever it stands, so 50 equal words always hold a run of 3 pieces.
    """
    at, h = [], []
    for m in _WORD.finditer(text, start, end):
        at.append(m.start())
        w = m[0]
        h.append(_word_hash(w) if len(w) <= _REMEMBERED_LENGTH else _word_hash.__wrapped__(w))
    # a queue of the window's places whose hashes rise; of equal hashes the last counts
    cuts, queue, last = [], deque(), 0
    for i, x in enumerate(h):
        while queue and h[queue[-1]] >= x:
            queue.pop()
        queue.append(i)
        if queue[0] <= i - WINDOW:
            queue.popleft()
        if i >= WINDOW - 1 and queue[0] > last:
            last = queue[0]
            cuts.append(at[last])
    return list(zip([start, *cuts], [*cuts, end]))


@lru_cache(_REMEMBERED)
def _word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass"))


def _units(text: str) -> tuple[list[tuple[int, int]], list[bool]]:
    """[start, end) of each sentence or piece, and which are pieces."""
    whole, at = [], 0
    for m in _END.finditer(text):
        end = m.end()
        if text[at:end].strip():
            whole.append((at, end))
            at = end
    if text[at:].strip():
        whole.append((at, len(text)))
    elif whole:
        whole[-1] = (whole[-1][0], len(text))
    out, piece = [], []
    for a, b in whole:
        cut = _pieces(text, a, b) if b - a > LONG and _n_words(text[a:b]) > LONG else [(a, b)]
        out += cut
        piece += [len(cut) > 1] * len(cut)
    return out, piece


def sentences(text: str) -> list[tuple[int, int]]:
    """[start, end) of each sentence, or piece of a long one; together with the gaps they are the text."""
    return _units(text)[0]


def spans(text: str, run: int, min_words: int) -> tuple[list[tuple[int, int]], list[tuple[int, bytes | None]]]:
    """Sentences, and (end, hash) of the span that starts at each (hash None: too few words).

    A span is ``run`` sentences, or all of a text that has fewer; with pieces
    among them it goes on to ``PIECE_WORDS`` words or the text's end.
    """
    cut, piece = _units(text)
    some = any(piece)
    single = (some or min_words) and not text.isascii() and _CHARACTER.search(text)
    keys, n_words = [], []
    for a, b in cut:
        words = text[a:b].lower().split()
        # each sentence is hashed by itself, so borders between sentences count
        keys.append(xxhash.xxh3_128_digest(" ".join(words).encode("utf-8")))
        n_words.append(_n_words(text[a:b]) if single else len(words))
    ends = [0, *accumulate(n_words)]
    out = []
    for i in range(max(len(keys) - run, 0) + 1 if keys else 0):
        end = min(i + run, len(keys))
        if some and any(piece[i:end]):
            while ends[end] - ends[i] < PIECE_WORDS and end < len(keys):
                end += 1
        if min_words and ends[end] - ends[i] < min_words:
            out.append((end, None))
            continue
        out.append((end, xxhash.xxh3_128_digest(b"".join(keys[i:end]))))
    return cut, out


def _row_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, run: int, min_words: int) -> DataFrame:
    """(hi, lo, id, row, at) of the distinct spans of each row, at its first place.

    Each row has one more, with at = -1: hi is its number of sentences, and lo
    1 if it repeats a span of its own.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        for b in batches:
            keys, src, at = [], [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                units, found = spans(text or "", run, min_words)
                first: dict[bytes, int] = {}
                n = 0
                for i, (_, s) in enumerate(found):
                    if s is not None:
                        n += 1
                        first.setdefault(s, i)
                keys += first
                keys.append(struct.pack("<qq", len(units), int(len(first) < n)))
                at += first.values()
                at.append(-1)
                src += [k] * (len(first) + 1)
            words = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            src = pa.array(src, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[:, 0]), pa.array(words[:, 1]), b.column(0).take(src), b.column(1).take(src),
                 pa.array(at, pa.int32())], names=["hi", "lo", "id", "row", "at"])

    return docs.select(F.col(id_col).alias("id"), _row_hash(text_col).alias("row"), text_col).mapInArrow(
        cut, f"hi bigint, lo bigint, id {id_type}, row bigint, at int")


def later_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                min_words: int = MIN_WORDS) -> DataFrame:
    """(id, row, starts, n, own): the span starts that another row has first, the sentences, and whether a span repeats within."""
    spark = docs.sparkSession
    path = scratch_path(spark, "spans")
    _occurrences(docs, id_col, text_col, run, min_words).write.parquet(path)
    every = spark.read.parquet(path)
    found = every.where("at >= 0")
    # a repeated span has a repeated hash; a row has each of its spans once
    path = scratch_path(spark, "repeated-spans")
    (found.groupBy(F.col("lo").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key")
     .write.parquet(path))
    repeated = spark.read.parquet(path)
    bits = spark.sparkContext.broadcast(key_bits(repeated, repeated.count()))

    def possible(batches):
        for b in batches:
            yield b.filter(pa.array(in_bits(bits.value, b.column(1).to_numpy().view(np.uint64))))

    path = scratch_path(spark, "possible-spans")
    found.mapInArrow(possible, found.schema).write.parquet(path)
    found = spark.read.parquet(path)
    # ids in order, null last
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    first = (found.groupBy("hi", "lo").agg(F.min(order).alias("first"), F.max(order).alias("last"))
             .where("first <> last")
             .select("hi", "lo", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row")))
    later = found.join(first, ["hi", "lo"]).where(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("row") == F.col("first_row"))))
    about = every.where("at < 0").select("id", "row", F.lit(None).cast("int").alias("at"), F.col("hi").alias("n"), F.col("lo").alias("own"))
    return (later.select("id", "row", "at").unionByName(about, allowMissingColumns=True).groupBy("id", "row")
            .agg(F.collect_set("at").alias("starts"), F.max("n").alias("n"), (F.max("own") > 0).alias("own")))


def _covered(text: str, starts, run: int, min_words: int) -> tuple[list[tuple[int, int]], list[bool]]:
    """Sentences, and which of them a non-first span covers.

    ``starts`` are the first places in this row of spans that another row has
    first; any further place in the row is a repeat in either case.
    """
    cut, found = spans(text, run, min_words)
    gone = [False] * len(cut)
    seen, starts = set(), set(starts or ())
    for i, (end, s) in enumerate(found):
        if s is not None:
            if s in seen or i in starts:
                gone[i:end] = [True] * (end - i)
            seen.add(s)
    return cut, gone


def result_names(docs: DataFrame, prefix: str = "") -> list[str]:
    """The names of the columns that ``dedup_sentences`` adds."""
    return [fresh(docs, f"{prefix}{n}") for n in ("n_sentences", "n_removed", "removed")]


def dedup_sentences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                    min_words: int = MIN_WORDS, prefix: str = "") -> DataFrame:
    """``docs`` with the removed sentences cut out of the text, and three more columns.

    Added (names begin with ``prefix``): n_sentences, n_removed, and removed, the
    [first sentence, sentences] runs cut out; where the table has a column of
    that name, the new one gets underscores in front (``result_names``). Texts
    without a removed sentence stay byte for byte. A null text stays null with 0 sentences; a text with
    fewer than ``run`` sentences is one span. Every input row comes back once.
    """
    later = later_spans(docs, id_col=id_col, text_col=text_col, run=run, min_words=min_words)
    marks = {n: fresh(docs, n) for n in ("starts", "row", "later_id", "later_row", "n", "own")}
    later = later.select(F.col("id").alias(marks["later_id"]), F.col("row").alias(marks["later_row"]),
                         *(F.col(c).alias(marks[c]) for c in ("starts", "n", "own")))
    keyed = docs.withColumn(marks["row"], _row_hash(text_col))
    joined = keyed.join(later, keyed[id_col].eqNullSafe(later[marks["later_id"]])
                        & (keyed[marks["row"]] == later[marks["later_row"]]), "left")
    joined = joined.select(*docs.columns, marks["starts"], marks["n"], marks["own"])
    at, types = docs.columns.index(text_col), docs.schema
    names = result_names(docs, prefix)

    def cut(batches):
        for b in batches:
            texts, n, removed = [], [], []
            places, sizes, own = (b.column(b.num_columns - k).to_pylist() for k in (3, 2, 1))
            for text, starts, size, again in zip(b.column(at).to_pylist(), places, sizes, own):
                if text is None or not starts and not again:
                    texts.append(text)
                    n.append(0 if text is None else size)
                    removed.append([])
                    continue
                parts, gone = _covered(text, starts, run, min_words)
                n.append(len(parts))
                runs: list[list[int]] = []
                for i, g in enumerate(gone):
                    if g and runs and sum(runs[-1]) == i:
                        runs[-1][1] += 1
                    elif g:
                        runs.append([i, 1])
                removed.append(runs)
                texts.append("".join(text[a:e] for (a, e), g in zip(parts, gone) if not g).rstrip()
                             if runs else text)
            columns = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(b.num_columns - 3)]
            columns += [pa.array(n, pa.int64()), pa.array([sum(r[1] for r in x) for x in removed], pa.int64()),
                        pa.array(removed, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, names=[*types.names, *names])

    schema = T.StructType([*types.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()),
                           T.StructField(names[2], T.ArrayType(T.ArrayType(T.LongType())))])
    return joined.mapInArrow(cut, schema)
