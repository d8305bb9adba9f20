"""Katz backoff language model over the corpus, in partitioned tables.

P(w | h) is d(c) c(h,w) / c(h) for an n-gram seen in training, with the
Good-Turing discount d for counts up to ``CUTOFF``, and otherwise
alpha(h) P(w | shorter h). alpha(h) is what the discounts leave, divided by
what the shorter model gives to the words not seen after h; so each
distribution sums to 1 exactly. The base is a discounted unigram model whose
left mass goes to one class for all unknown words.

How it runs at any size:

* Documents are tokenised once into batch rows: the distinct words of a batch
  of documents (64-bit hashes) and the token stream as numbers of those words.
* Every batch sends its distinct n-grams of each order, with their training
  counts, to hash buckets. N-grams are spread by the hash of the whole n-gram,
  and one batch sends each at most once, so neither a frequent n-gram nor a
  frequent history gathers in a bucket. A bucket adds the counts up, stores its
  part of the model table, and answers each batch with the counts of its
  n-grams. Answers, like the batches, are kept by batch.
* Discounts need only the numbers of n-grams that occur r times, r up to
  CUTOFF + 1. For each order, the sums behind alpha(h) are pre-aggregated in
  the batches (each distinct n-gram is marked for one of the batches that sent
  it) and added up by history.
* A last pass joins batches and answers and evaluates every token by recursion
  over the orders.

The batch table is bucketed by batch, so joining answers never moves it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import binary_list, blocks_for
from marketlake.session import scratch_path

ORDER = 2
#: Counts above it are not discounted.
CUTOFF = 5
#: Bytes of text in a batch of documents, and of text whose n-grams share a hash bucket.
BATCH_BYTES = 5 << 20
BUCKET_BYTES = 4 << 20
#: Buckets of the batch table at most (Spark allows 100,000).
MOST_GROUPS = 50_000

_END, _BEGIN = 1, 2  # hashes of the end token and of the place before the first token
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case (the end token is added later)."""
    return text.lower().split()


def _word_hash(w: bytes) -> int:
    return max(3, xxhash.xxh3_64_intdigest(w))


def _pack(a: np.ndarray) -> bytes:
    """An array byte plane by byte plane: the zeros of small numbers then compress to nothing."""
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b""


def _unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _grams(words: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram that ends at each token; places before a document are _BEGIN."""
    h = words
    for back in range(1, order):
        earlier = np.empty_like(words)
        earlier[back:] = words[:-back] if back else words
        for k in range(back):
            at = starts + k
            # the k-th token of a document has k tokens before it
            at = at[at < np.append(starts[1:], len(words))]
            earlier[at] = _BEGIN
        h = _scramble(h * _MULTIPLIER + earlier + np.uint64(back))
    return h


@dataclass
class Batch:
    """A batch of documents as arrays."""

    keys: bytes
    held: np.ndarray
    lengths: np.ndarray
    vocabulary: np.ndarray  # hash of every distinct token
    stream: np.ndarray      # places in it, for every token

    @cached_property
    def words(self) -> np.ndarray:
        return self.vocabulary[self.stream]

    @cached_property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)

    def distinct(self, order: int):
        """Distinct n-grams, the place of each token's among them, and their training counts."""
        if order == 1:
            by_hash = np.argsort(self.vocabulary)
            rank = np.empty_like(by_hash)
            rank[by_hash] = np.arange(len(by_hash))
            grams, place = self.vocabulary[by_hash], rank[self.stream]
        else:
            grams, place = np.unique(_grams(self.words, self.starts, order), return_inverse=True)
        train = np.repeat(~self.held, self.lengths)
        return grams, place, np.bincount(place, weights=train, minlength=len(grams)).astype(np.uint32)

    def histories(self, order: int) -> np.ndarray:
        """Hash of the n-1 tokens before each token."""
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[self.starts] = _BEGIN
        return _grams_before(before, self.starts, order)


def _grams_before(before: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    h = before
    n = len(before)
    ends = np.append(starts[1:], n)
    for back in range(1, order - 1):
        earlier = np.empty_like(before)
        earlier[back:] = before[:-back]
        for k in range(back):
            at = starts + k
            earlier[at[at < ends]] = _BEGIN
        h = _scramble(h * _MULTIPLIER + earlier + np.uint64(back))
    return h


def _batch_of(row: dict) -> Batch:
    return Batch(row["keys"], *(_unpack(row[k], t) for k, t in (
        ("held", bool), ("lengths", np.int64), ("vocabulary", np.uint64), ("stream", np.uint32))))


def _rows(batches):
    """One row at a time: a row is a batch of documents."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


_BATCH = "batch bigint, keys binary, held binary, lengths binary, vocabulary binary, stream binary"


def _arrow(names: list[str], types: list, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _tokenise(batch_bytes: int):
    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        number: dict[bytes, int] = {}
        hashes, keys, held, lengths, stream, size = [], [], [], [], [], 0

        def row():
            ids = pa.RecordBatch.from_arrays([pa.concat_arrays(keys)], names=["key"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ids.schema) as w:
                w.write_batch(ids)
            return _arrow(
                [f.split()[0] for f in _BATCH.split(", ")], [pa.int64(), *[pa.binary()] * 5],
                [[part << 32 | made], [sink.getvalue().to_pybytes()], [_pack(np.array(held, bool))],
                 [_pack(np.array(lengths, np.int64))], [_pack(np.array(hashes, np.uint64))],
                 [_pack(np.concatenate(stream))]])

        for b in batches:
            at = 0
            texts, out = binary_list(b.column(1)), b.column(2).to_pylist()
            for k, t in enumerate(texts):
                words = tokens(t)
                for w in set(words).difference(number):
                    number[w] = len(hashes)
                    hashes.append(_word_hash(w))
                if b"" not in number:  # no word is empty: this is the end token
                    number[b""] = len(hashes)
                    hashes.append(_END)
                words.append(b"")
                stream.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                lengths.append(len(words))
                held.append(out[k])
                size += len(t)
                if size >= batch_bytes:
                    keys.append(b.column(0).slice(at, k + 1 - at))
                    at = k + 1
                    yield row()
                    made += 1
                    number = {}
                    hashes, keys, held, lengths, stream, size = [], [], [], [], [], 0
            if at < len(texts):
                keys.append(b.column(0).slice(at))
        if lengths:
            yield row()

    return run


def _ask(orders: range, buckets: int):
    """Distinct n-grams of each batch, by bucket."""
    names = ["n", "bucket", "batch", "grams", "counts"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        for row in _rows(batches):
            batch = _batch_of(row)
            for n in orders:
                grams, _, counts = batch.distinct(n)
                cut = _cuts(grams, buckets)
                yield _arrow(names, types, [
                    [n] * len(cut), [k for k, _, _ in cut], [row["batch"]] * len(cut),
                    [_pack_sorted(grams[a:e]) for _, a, e in cut], [_pack(counts[a:e]) for _, a, e in cut]])

    return run


def _cuts(grams: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the buckets that sorted hashes fall into: buckets are equal ranges of the hash."""
    bucket = ((grams >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(grams) else np.zeros(0, np.int64)
    return list(zip(bucket[first].tolist(), first.tolist(), np.r_[first[1:], len(grams)].tolist()))


def _count(table: pa.Table) -> pa.Table:
    """All n-grams of a bucket: the model rows, the answers and the counts of counts.

    An answer holds, for each n-gram asked for, twice its training count, plus 1
    if this batch accounts for it.
    """
    n, bucket = table.column("n")[0].as_py(), table.column("bucket")[0].as_py()
    order = np.argsort(table.column("batch").to_numpy(), kind="stable")
    batch = table.column("batch").to_numpy()[order]
    asked = [_unpack_sorted(table.column("grams")[int(i)].as_py()) for i in order]
    counts = np.concatenate([_unpack(table.column("counts")[int(i)].as_py(), np.uint32) for i in order])
    grams, first, place = np.unique(np.concatenate(asked), return_index=True, return_inverse=True)
    total = np.bincount(place, weights=counts, minlength=len(grams)).astype(np.uint64)
    answer = total[place] * np.uint64(2)
    answer[first] += np.uint64(1)
    seen = total > 0
    r, how_many = np.unique(total[seen], return_counts=True)
    low = r <= CUTOFF + 1
    at = np.cumsum([0, *map(len, asked)])
    columns = {
        "kind": ["answer"] * len(asked) + ["model", "counts"],
        "n": [n] * (len(asked) + 2), "bucket": [bucket] * (len(asked) + 2),
        "batch": [*batch.tolist(), None, None],
        "a": [*(_pack(answer[i:j].astype(np.uint32 if total.max(initial=0) < 1 << 30 else np.uint64))
                for i, j in zip(at[:-1], at[1:])), _pack_sorted(grams[seen]), _pack(r[low].astype(np.int64))],
        "b": [*[None] * len(asked), _pack(total[seen]), _pack(how_many[low].astype(np.int64))],
        "total": [*[None] * len(asked), int(total.sum()), None],
        "size": [*map(len, asked), int(seen.sum()), None],
    }
    return pa.table(columns, schema=_COUNTED_ARROW)


_COUNTED = "kind string, n int, bucket int, batch bigint, a binary, b binary, total bigint, size bigint"
_COUNTED_ARROW = pa.schema([("kind", pa.string()), ("n", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()),
                            ("a", pa.binary()), ("b", pa.binary()), ("total", pa.int64()), ("size", pa.int64())])


def discounts(counts_of_counts: dict[int, int], cutoff: int = CUTOFF) -> np.ndarray:
    """d[r] for counts r up to ``cutoff`` (Katz's Good-Turing form); d[0] is unused.

    Where the counts of counts are too few for it (a value outside (0, 1) or a
    missing one), the count is discounted by a half instead.
    """
    n = [float(counts_of_counts.get(r, 0)) for r in range(cutoff + 2)]
    d = np.ones(cutoff + 1)
    high = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] else 1.0
    for r in range(1, cutoff + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - high) / (1 - high) if n[r] and high != 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


@dataclass
class Numbers:
    """What every task must know: a few numbers, whatever the corpus."""

    order: int
    total: int    # training tokens
    types: int    # distinct ones
    discount: dict[int, np.ndarray]
    below: float  # denominator of the unigrams
    unknown: float

    def discounted(self, n: int, counts: np.ndarray) -> np.ndarray:
        d = self.discount[n]
        return counts * np.where(counts < len(d), d[np.minimum(counts, len(d) - 1).astype(np.int64)], 1.0)


def _numbers(order: int, total: int, types: int, counts: dict[int, dict[int, int]]) -> Numbers:
    discount = {n: discounts(c) for n, c in counts.items()}
    d = discount[1]
    left = sum((1 - d[r]) * r * m for r, m in counts[1].items() if r < len(d))
    # no count was discounted: one more in the denominator leaves mass for unknown words
    below = total + (left <= 0)
    return Numbers(order, total, types, discount, below, (left if left > 0 else 1.0) / below)


def _answers(row: dict, n: int) -> np.ndarray:
    """Counts of the batch's distinct n-grams, in their order."""
    parts = sorted((a for a in row["answers"] if a["n"] == n), key=lambda a: a["bucket"])
    return np.concatenate([_unpack(a["a"], np.uint32 if len(a["a"]) == 4 * a["size"] else np.uint64)
                           for a in parts]).astype(np.uint64)


def _probabilities(row: dict, numbers: Numbers, upto: int):
    """P of every token under orders 1 to ``upto``, by recursion; and the batch."""
    batch = _batch_of(row)
    _, place, _ = batch.distinct(1)
    count = (_answers(row, 1) >> np.uint64(1)).astype(np.float64)
    known = count[place]
    p = np.where(known > 0, numbers.discounted(1, known) / numbers.below, numbers.unknown)
    for n in range(2, upto + 1):
        _, place, _ = batch.distinct(n)
        count = (_answers(row, n) >> np.uint64(1)).astype(np.float64)[place]
        history, at = np.unique(batch.histories(n), return_inverse=True)
        below, alpha = _weights(row, n)
        seen = below[at] > 0
        backed_off = np.where(seen, alpha[at], 1.0) * p
        p = np.where(count > 0, numbers.discounted(n, count) / np.maximum(below[at], 1.0), backed_off)
    return batch, known, p


def _weights(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Denominator and alpha of the batch's distinct histories, in their order; 0 and 1 where never seen."""
    parts = sorted((w for w in row["weights"] if w["n"] == n), key=lambda w: w["bucket"])
    return (np.concatenate([_unpack(w["below"], np.uint64) for w in parts]).astype(np.float64),
            np.concatenate([_unpack(w["alpha"], np.float64) for w in parts]))


def _ask_weights(n: int, numbers: Numbers, buckets: int):
    """Per batch and distinct history: its counts, their discounted sum and the lower-order mass."""
    names = ["n", "bucket", "batch", "grams", "sums"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        for row in _rows(batches):
            batch, _, lower = _probabilities(row, numbers, n - 1)
            _, first = np.unique(_grams(batch.words, batch.starts, n), return_index=True)
            answer = _answers(row, n)
            count = (answer >> np.uint64(1)).astype(np.float64)
            mine = ((answer & np.uint64(1)) > 0) & (count > 0)
            history, at = np.unique(batch.histories(n), return_inverse=True)
            of = at[first[mine]]
            sums = np.stack([np.bincount(of, weights=w, minlength=len(history)) for w in (
                count[mine], numbers.discounted(n, count[mine]), lower[first[mine]])])
            cut = _cuts(history, buckets)
            yield _arrow(names, types, [
                [n] * len(cut), [k for k, _, _ in cut], [row["batch"]] * len(cut),
                [_pack_sorted(history[a:e]) for _, a, e in cut],
                [_pack(np.ascontiguousarray(sums[:, a:e]).ravel()) for _, a, e in cut]])

    return run


def _weigh(table: pa.Table) -> pa.Table:
    """Add up the sums of a bucket's histories; answer each batch with denominator and alpha."""
    n, bucket = table.column("n")[0].as_py(), table.column("bucket")[0].as_py()
    batch = table.column("batch").to_numpy()
    order = np.argsort(batch, kind="stable")
    asked = [_unpack_sorted(table.column("grams")[int(i)].as_py()) for i in order]
    sums = np.concatenate([_unpack(table.column("sums")[int(i)].as_py(), np.float64).reshape(3, -1)
                           for i in order], axis=1)
    history, place = np.unique(np.concatenate(asked), return_inverse=True)
    count, kept, lower = (np.bincount(place, weights=s, minlength=len(history)) for s in sums)
    # no count was discounted: one more in the denominator leaves mass for the unseen
    below = np.where(count > 0, count + (count - kept < 1e-9), 0.0)
    left = np.where(count > 0, (below - kept) / np.maximum(below, 1.0), 1.0)
    alpha = np.where(count > 0, left / np.maximum(1.0 - lower, 1e-12), 1.0)
    at = np.cumsum([0, *map(len, asked)])
    cut = list(zip(at[:-1], at[1:]))
    return pa.table({
        "n": [n] * len(asked), "bucket": [bucket] * len(asked), "batch": batch[order],
        "below": [_pack(below[place[i:j]].astype(np.uint64)) for i, j in cut],
        "alpha": [_pack(alpha[place[i:j]]) for i, j in cut],
    }, schema=pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("batch", pa.int64()), ("below", pa.binary()),
                         ("alpha", pa.binary())]))


def _score(numbers: Numbers):
    names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for row in _rows(batches):
            batch, known, p = _probabilities(row, numbers, numbers.order)
            base = np.log10((known + 0.1) / (numbers.total + 0.1 * (numbers.types + 1)))
            add = lambda x: np.add.reduceat(x, batch.starts)  # noqa: E731 - no document is without tokens
            keys = pa.ipc.open_stream(batch.keys).read_all().column(0).combine_chunks()
            yield pa.RecordBatch.from_arrays([
                keys, pa.array(batch.held), pa.array(batch.lengths), pa.array(add((known > 0).astype(np.int64))),
                pa.array(np.full(len(batch.lengths), numbers.total, np.int64)), pa.array(add(base)),
                pa.array(add(np.log10(p))),
            ], names=names)

    return run


def score(docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
          batch_bytes: int = BATCH_BYTES, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Train on the rows where ``held_out`` (a boolean column) is false and score all rows.

    Returns ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10). A null text is empty and has one token, the end; equal rows
    get equal scores; no training rows give the uniform unknown class only (the
    score is 0). Other columns are ignored. The model tables are written under
    ``path`` (by default in the shared folder), partitioned by order.
    """
    spark, id_type = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    path = path or scratch_path(spark, "katz")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0]
    buckets = blocks_for(size, bucket_bytes)
    groups = min(MOST_GROUPS, blocks_for(size, batch_bytes))
    name = f"katz_{uuid.uuid4().hex}"
    (docs.select(id_col, text_col, F.coalesce(held_out, F.lit(False)).alias("held"))
     .mapInArrow(_tokenise(batch_bytes), _BATCH)
     .write.option("path", f"{path}/batches").option("compression", "zstd")
     .bucketBy(groups, "batch").saveAsTable(name))
    try:
        return _score_batches(spark, name, path, order, buckets, groups, id_col, id_type)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _score_batches(spark, name, path, order, buckets, groups, id_col, id_type) -> DataFrame:
    def batches() -> DataFrame:
        return spark.table(name)

    asked = batches().mapInArrow(_ask(range(1, order + 1), buckets),
                                 "n int, bucket int, batch bigint, grams binary, counts binary")
    (asked.groupBy("n", "bucket").applyInArrow(_count, _COUNTED)
     .write.partitionBy("kind", "n").option("compression", "zstd").parquet(f"{path}/counted"))
    counted = spark.read.schema(_COUNTED).parquet(f"{path}/counted")
    sums = {r["n"]: r for r in counted.where("kind = 'model'").groupBy("n").agg(
        F.sum("total").alias("total"), F.sum("size").alias("types")).collect()}
    counts: dict[int, dict[int, int]] = {n: {} for n in range(1, order + 1)}
    # at most CUTOFF + 1 numbers from each bucket, added up by Spark
    per_r = counted.where("kind = 'counts'").select("n", "a", "b").mapInArrow(_unpack_counts, "n int, r bigint, m bigint")
    for r in per_r.groupBy("n", "r").agg(F.sum("m").alias("m")).collect():
        counts[r["n"]][r["r"]] = r["m"]
    numbers = _numbers(order, sums[1]["total"] if 1 in sums else 0, sums[1]["types"] if 1 in sums else 0, counts)
    # the batch table has this many buckets: dealt alike, it stays where it is
    answers = (counted.where("kind = 'answer'").repartition(groups, "batch").groupBy("batch")
               .agg(F.collect_list(F.struct("n", "bucket", "a", "size")).alias("answers")))
    joined = batches().join(answers, "batch")
    none = F.expr("cast(array() AS array<struct<n: int, bucket: int, below: binary, alpha: binary>>)")
    weights = None
    for n in range(2, order + 1):
        with_lower = joined.withColumn("weights", none) if weights is None else joined.join(weights, "batch")
        at = f"{path}/weights{n}"
        asked = with_lower.mapInArrow(_ask_weights(n, numbers, buckets),
                                      "n int, bucket int, batch bigint, grams binary, sums binary")
        (asked.groupBy("n", "bucket").applyInArrow(_weigh, "n int, bucket int, batch bigint, below binary, alpha binary")
         .write.option("compression", "zstd").parquet(at))
        paths = [f"{path}/weights{k}" for k in range(2, n + 1)]
        weights = (spark.read.parquet(*paths).repartition(groups, "batch").groupBy("batch")
                   .agg(F.collect_list(F.struct("n", "bucket", "below", "alpha")).alias("weights")))
    final = joined.withColumn("weights", none) if weights is None else joined.join(weights, "batch")
    out = final.mapInArrow(_score(numbers), (
        f"key {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"))
    return out.withColumnRenamed("key", id_col)


def _unpack_counts(batches):
    for b in batches:
        n, r, m = [], [], []
        for row in b.to_pylist():
            part = _unpack(row["a"], np.int64)
            n += [row["n"]] * len(part)
            r += part.tolist()
            m += _unpack(row["b"], np.int64).tolist()
        yield _arrow(["n", "r", "m"], [pa.int32(), pa.int64(), pa.int64()], [n, r, m])
