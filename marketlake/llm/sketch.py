"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, or
the least one if none is, so only texts without words have an empty sketch. Its
size follows the document, sketches of any two documents are comparable, and
the sketch of a union follows from the sketches (merge). The share of a
small document's hashes found in a large one's sketch estimates containment
without the bias that equal-sized sketches have for unequal documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import blocks_for

SHINGLE = 5
#: Shingle hashes below this fraction of the range are kept.
FRACTION = 1 / 2
#: Hex digits that a kept hash is written with.
DIGITS = 12
CACHE_WORDS = 200_000
#: Rows of texts that a task takes apart at a time.
ROWS = 500
#: Bytes of text in one block of neighbouring ids, and the most blocks there are (their ends are broadcast).
BLOCK_BYTES = 2 << 20
MAX_BLOCKS = 4096

_MULTIPLIER = 0x9E3779B97F4A7C15
_WORDS: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    known = _WORDS
    if len(known) > CACHE_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _scramble(h: np.ndarray) -> np.ndarray:
    """Spread the bits (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sketch(text: str, shingle: int = SHINGLE, fraction: float = FRACTION) -> np.ndarray:
    """Sorted distinct kept hashes, as 4 * DIGITS bit numbers; the least hash if none is below the fraction.

    Words are lower-cased runs between white space; fewer words than
    ``shingle`` make one shingle, none make none.
    """
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = _word_hashes(words)
    k = min(shingle, len(h))
    mixed = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        mixed = _scramble(mixed * np.uint64(_MULTIPLIER) + h[i:len(h) - k + 1 + i])
    kept = mixed[mixed < np.uint64(min((1 << 64) - 1, int(fraction * (1 << 64))))]
    if not len(kept):
        kept = mixed.min(keepdims=True)
    return np.unique(kept >> np.uint64(64 - 4 * DIGITS))


def text_of(s: np.ndarray) -> str:
    return s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2:].tobytes().hex()


def sketch_of(text: str) -> np.ndarray:
    """A sketch read back from its string."""
    return np.array([int(text[i:i + DIGITS], 16) for i in range(0, len(text), DIGITS)], np.uint64)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of both documents together."""
    both = np.union1d(a, b)
    low = both[both < np.uint64(int(fraction * (1 << 4 * DIGITS)))]
    return low if len(low) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that are in b; of an empty sketch 1 in an empty one, else 0."""
    if not len(a):
        return float(not len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; two empty sketches (texts without words) are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 fraction: float = FRACTION) -> DataFrame:
    """(id_col, n_chars, fingerprint) of every row; a null text is empty."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([text_of(sketch(t, shingle, fraction)) for t in texts], pa.string())],
                names=["key", "n_chars", "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"key {id_type}, n_chars bigint, fingerprint string").withColumnRenamed("key", id_col)


def _block(c: Column, cuts: list[float]) -> Column:
    """How many of the sorted ``cuts`` are at most the id, by binary search; 0 without an id."""
    ends = F.array(*[F.lit(float(x)) for x in cuts]) if cuts else F.array().cast("array<double>")

    def halve(state, _):
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        open_ = state["lo"] < state["hi"]
        right = open_ & (F.get(ends, middle) <= c.cast("double"))
        return F.struct(F.when(right, middle + 1).otherwise(state["lo"]).alias("lo"),
                        F.when(right | ~open_, state["hi"]).otherwise(middle).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(cuts).bit_length())))
    return F.when(c.isNull(), 0).otherwise(F.aggregate(steps, start, halve, lambda s: s["lo"]))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (id, text, block, ahead) sorted within partitions so that each row's next one follows it.

    Numeric ids are cut into at most ``MAX_BLOCKS`` ranges of about equal text
    size. Each range is a block, in one partition, read as a sorted stream; the
    first rows of the next block that has rows (after the last: of the first)
    are sent along with ``ahead`` true. The order is by id (null first) and,
    among equal ids, by text (null as ''), so ties are stable. Texts are
    shuffled once.
    """
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0]
    n = min(MAX_BLOCKS, blocks_for(total, block_bytes))
    cuts = sorted(set(docs.where(F.col(id_col).isNotNull()).approxQuantile(
        id_col, [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("block", _block(F.col("id"), cuts))
    firsts = base.groupBy("block").agg(F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("none"))
    firsts = sorted(map(tuple, firsts.collect()))  # at most MAX_BLOCKS rows
    lead = spark.createDataFrame(
        [(b, None if none else first, firsts[i - 1][0]) for i, (b, first, none) in enumerate(firsts)],
        T.StructType([T.StructField("block", T.IntegerType()), T.StructField("first", id_type),
                      T.StructField("before", T.IntegerType())]))
    own = F.struct(F.col("block"), F.lit(False).alias("ahead"))
    copies = F.when(F.col("id").eqNullSafe(F.col("first")), F.array(
        own, F.struct(F.col("before").alias("block"), F.lit(True).alias("ahead")))).otherwise(F.array(own))
    spread = base.join(F.broadcast(lead), "block").select("id", "text", F.inline(copies))
    return (spread.repartition(max(1, len(firsts)), "block")
            .sortWithinPartitions("block", "ahead", F.col("id").asc_nulls_first(), "text"))


def compare_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 fraction: float = FRACTION, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row's fingerprint beside those of its edited text and of the next row.

    The edited text has the last quarter of the code points replaced by the
    first as many of the next row's text. Columns: ``id_col``, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next
    (likeness), in_edited and in_next (containment in the other). A null text
    is empty; a single row is its own next; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "in_edited", "in_next"]
    types = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]

    def run(batches):
        held = None  # the row that waits for its next one: block, key, text, sketch
        for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            keys, out = b.column(0), []
            for i, (text, block, ahead) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3)))):
                if held is not None and held[0] == block:
                    s = sketch(text, shingle, fraction)
                    own = held[3]
                    changed = edited(held[2], text)
                    e = sketch(changed, shingle, fraction)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode("utf-8")).hexdigest(),
                                text_of(own), text_of(e), likeness(own, e), likeness(own, s),
                                containment(own, e), containment(own, s)))
                else:
                    s = None
                # of the rows ahead the first is the next row; the others repeat its id
                held = None if ahead else (block, keys[i], text, s if s is not None else sketch(text, shingle, fraction))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k.as_py() for k in columns[0]], b.schema.field(0).type),
                     *(pa.array(list(c), t) for c, t in zip(columns[1:], types))], names=names)

    out = with_next(docs, id_col=id_col, text_col=text_col, block_bytes=block_bytes).mapInArrow(
        run, f"key {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, in_edited double, in_next double")
    return out.withColumnRenamed("key", id_col)
