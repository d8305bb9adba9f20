"""Benchmark decontamination by Wu-Manber multi-pattern search.

A benchmark item is cut into windows of consecutive words; every window is a
test string. Documents are searched for all windows at once:

* a SHIFT table over blocks of a few bytes says how far the search position
  may jump because no window can end its searched part there;
* where the shift is 0, a bucket keyed by the hash of the block (the suffix)
  and, inside it, by the hash of the first block (the prefix) selects windows;
* comparing the bytes directly confirms an occurrence.

Windows of similar length share one table set, so that short windows do not
shorten the jumps of long ones. A batch of documents is one byte buffer that
many search positions walk at the same time (numpy), each over its own part.

The tables are broadcast. Their size is measured first: windows are cut into
blocks of at most ``block_bytes``, and the documents are searched block by
block, so the benchmark may grow.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import binary_list, blocks_for, by_bytes, rows

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: Bytes of text searched at a time in a task.
BATCH_BYTES = 4 << 20
BLOCK = 6

# ASCII bytes: letters in lower case and digits stay, all others become a space;
# every byte of a non-ASCII character stays.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def item_windows(text: bytes, window: int) -> list[bytes]:
    """The windows of an item, each as b' w1 w2 ... '."""
    w = words(text)
    if not w:
        return []
    n = max(1, len(w) - window + 1)
    return [b" " + b" ".join(w[i:i + window]) + b" " for i in range(n)]


def _mix(blocks: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of bytes."""
    h = np.zeros(blocks.shape[0], np.uint64)
    for j in range(blocks.shape[1]):
        h = (h + blocks[:, j].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _at(buf: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    return buf[start[:, None] + np.arange(width)]


class WuManber:
    """Search tables for patterns of about the same length."""

    def __init__(self, patterns: list[bytes], ids: list[int]):
        self.m = m = min(map(len, patterns))
        self.b = b = min(BLOCK, m)
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        bits = min(22, max(10, int(np.ceil(np.log2(8 * len(patterns) * (m - b + 1))))))
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, m - b + 1, np.int32)
        for j in range(b, m + 1):
            np.minimum.at(self.shift, _mix(heads[:, j - b:j]) >> self.drop, m - j)
        key = self._key(_mix(heads[:, m - b:]), _mix(heads[:, :b]))
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.patterns = [patterns[i] for i in order]
        self.ids = np.asarray(ids, np.int64)[order]

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """Bucket (suffix hash) and, within it, place (prefix hash)."""
        return (suffix >> np.uint64(32) << np.uint64(32)) | (prefix >> np.uint64(32))

    def candidates(self, buf: np.ndarray) -> np.ndarray:
        """Starts at which the shift table cannot rule out a pattern."""
        n, m, b = len(buf), self.m, self.b
        if n < m:
            return np.empty(0, np.int64)
        bounds = np.linspace(m, n + 1, max(2, n // 2048 + 1)).astype(np.int64)
        pos, end, found = bounds[:-1].copy(), bounds[1:].copy(), []
        while pos.size:
            live = pos < end
            pos, end = pos[live], end[live]
            step = self.shift[_mix(_at(buf, pos - b, b)) >> self.drop]
            found.append(pos[step == 0] - m)
            pos = pos + np.maximum(step, 1)
        return np.concatenate(found)

    def search(self, buf: np.ndarray, raw: bytes) -> tuple[list[int], list[int]]:
        """Starts and pattern ids of all occurrences."""
        start = self.candidates(buf)
        key = self._key(_mix(_at(buf, start + self.m - self.b, self.b)), _mix(_at(buf, start, self.b)))
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        at, ids = [], []
        for k in np.flatnonzero(hi > lo):
            s = int(start[k])
            for i in range(lo[k], hi[k]):
                if raw.startswith(self.patterns[i], s):
                    at.append(s)
                    ids.append(int(self.ids[i]))
        return at, ids


class Tables:
    """All windows of one block: search tables by length, and each window's items."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        windows = sorted({w for w, _ in pairs})
        number = {w: i for i, w in enumerate(windows)}
        self.items = sorted({t for _, t in pairs})
        place = {t: i for i, t in enumerate(self.items)}
        owners: list[set[int]] = [set() for _ in windows]
        for w, t in pairs:
            owners[number[w]].add(place[t])
        self.owners = [sorted(s) for s in owners]
        self.n_words = np.array([w.count(b" ") - 1 for w in windows], np.int64)
        classes: dict[int, list[int]] = {}
        for i, w in enumerate(windows):
            classes.setdefault(len(w).bit_length(), []).append(i)
        self.searchers = [WuManber([windows[i] for i in ids], ids) for ids in classes.values()]

    def search(self, docs: list[list[bytes]]) -> tuple[list[np.ndarray], list[list[str]]]:
        """Per document: which words lie in an occurrence, and the items found."""
        raw = b"".join(b" " + b" ".join(w) + b" \x00" if w else b"\x00" for w in docs)
        buf = np.frombuffer(raw, np.uint8)
        spaces = np.flatnonzero(buf == 32)
        counts = np.array([len(w) for w in docs], np.int64)
        first = np.concatenate([[0], np.cumsum(counts + (counts > 0))])
        edge = np.zeros(len(spaces) + 1, np.int64)
        items: list[set[int]] = [set() for _ in docs]
        for s in self.searchers:
            at, ids = s.search(buf, raw)
            if not at:
                continue
            g = np.searchsorted(spaces, at)
            np.add.at(edge, g, 1)
            np.add.at(edge, g + self.n_words[ids], -1)
            doc = np.searchsorted(first, g, "right") - 1
            for d, i in set(zip(doc.tolist(), ids)):
                items[d].update(self.owners[i])
        inside = np.cumsum(edge) > 0
        return ([inside[a:a + n] for a, n in zip(first[:-1].tolist(), counts.tolist())],
                [[self.items[i] for i in sorted(s)] for s in items])


def _pairs(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    def cut(batches):
        schema = pa.schema([("window", pa.binary()), ("item", pa.string())])
        for b in batches:
            out = [(w, i) for i, t in zip(b.column(0).to_pylist(), binary_list(b.column(1)))
                   for w in item_windows(t, window)]
            yield rows(schema, [w for w, _ in out], [i for _, i in out])

    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), text_col)
    return items.mapInArrow(cut, "window binary, item string").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of each document that lie inside a benchmark window.

    Returns, for each input row, ``id_col``, n_words, n_hit, ``hit`` (array of
    [first word, words] of the maximal hit runs) and ``items`` (sorted ids, as
    strings, of the items with a window in the document). A null or empty text
    has no words; an item without words has no window; a null item id is
    reported as 'null'; equal rows give equal results; other columns are
    ignored. An empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    pairs = _pairs(benchmark, item_col, item_text_col, window)
    total = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 16)).first()[0]
    n = blocks_for(total, block_bytes)
    block = F.pmod(F.xxhash64("window", "item"), F.lit(n))
    found = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"),
                        F.lit(None).cast("binary").alias("runs"),
                        F.lit(None).cast("array<string>").alias("found"))
    id_type = docs.schema[id_col].dataType
    for i in range(n):
        part = [(bytes(r["window"]), r["item"]) for r in pairs.where(block == i).collect()]
        tables = spark.sparkContext.broadcast(Tables(part))
        found = found.mapInArrow(_searching(tables, i == n - 1), _schema(id_type, i == n - 1))
        if i < n - 1:
            found = found.checkpoint()
    if id_col in ("n_words", "n_hit", "hit", "items"):
        raise ValueError(f"the id column may not be called {id_col}")
    return found.withColumnRenamed("key", id_col)


def _schema(id_type, last: bool) -> str:
    return (f"key {id_type.simpleString()}, n_words bigint, n_hit bigint, hit array<array<bigint>>, items array<string>"
            if last else f"key {id_type.simpleString()}, text string, runs binary, found array<string>")


def _runs(inside: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
    return [[int(a), int(b - a)] for a, b in zip(edge[::2], edge[1::2])]


def _searching(tables, last: bool):
    def search(batches):
        for b in batches:
            keys, texts = b.column(0), binary_list(b.column(1))
            at = 0
            for run in by_bytes(zip(texts, b.column(2).to_pylist(), b.column(3).to_pylist()),
                                lambda r: len(r[0]), BATCH_BYTES):
                docs = [words(t) for t, _, _ in run]
                inside, items = tables.value.search(docs) if tables.value.items else (
                    [np.zeros(len(d), bool) for d in docs], [[] for _ in docs])
                for k, (_, runs, found) in enumerate(run):
                    if runs:
                        for a, n in np.frombuffer(runs, np.int64).reshape(-1, 2):
                            inside[k][a:a + n] = True
                    if found:
                        items[k] = sorted({*items[k], *found})
                key = keys.slice(at, len(run))
                at += len(run)
                hit = [_runs(x) for x in inside]
                if last:
                    yield pa.RecordBatch.from_arrays([
                        key, pa.array([len(d) for d in docs], pa.int64()),
                        pa.array([int(x.sum()) for x in inside], pa.int64()),
                        pa.array(hit, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string())),
                    ], names=["key", "n_words", "n_hit", "hit", "items"])
                else:
                    yield pa.RecordBatch.from_arrays([
                        key, b.column(1).slice(at - len(run), len(run)),
                        pa.array([np.array(x, np.int64).tobytes() for x in hit], pa.binary()),
                        pa.array(items, pa.list_(pa.string())),
                    ], names=["key", "text", "runs", "found"])

    return search


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; same columns.

    The search runs beside the rows (no join back): every column passes
    through the search task. Null and empty texts stay.
    """
    spark, schema = docs.sparkSession, docs.schema
    pairs = _pairs(benchmark, "item_id", "text", window)
    total = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 16)).first()[0]
    n = blocks_for(total, BLOCK_BYTES)
    block = F.pmod(F.xxhash64("window", "item"), F.lit(n))
    at = docs.columns.index(text_col)
    out = docs
    for i in range(n):
        tables = spark.sparkContext.broadcast(
            Tables([(bytes(r["window"]), r["item"]) for r in pairs.where(block == i).collect()]))

        def keep(batches, tables=tables):
            for b in batches:
                ok = []
                for run in by_bytes(binary_list(b.column(at)), len, BATCH_BYTES):
                    docs_ = [words(t) for t in run]
                    ok += ([not items for items in tables.value.search(docs_)[1]] if tables.value.items
                           else [True] * len(run))
                yield b.filter(pa.array(ok, pa.bool_()))

        out = out.mapInArrow(keep, schema)
        if i < n - 1:
            out = out.checkpoint()
    return out


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


#: The same words as a regular expression, for SQL.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_force(docs: dict, benchmark: dict, window: int = WINDOW) -> dict:
    """Plain nested-loop version for tests: id -> (words, hit words, items)."""
    def split(t):
        return re.findall(WORD_PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    tests = {}
    for item, t in benchmark.items():
        w = split(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            tests.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = {}
    for d, t in docs.items():
        w, hit, items = split(t), set(), set()
        for test, owners in tests.items():
            for i in range(len(w) - len(test) + 1):
                if tuple(w[i:i + len(test)]) == test:
                    hit.update(range(i, i + len(test)))
                    items |= owners
        out[d] = (len(w), len(hit), sorted(items))
    return out
