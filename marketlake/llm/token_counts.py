"""Token counts with a public tokenizer: lengths only, in Arrow functions.

Texts are split at safe boundaries: where a non-space character is followed by
an ASCII space, tab or line break. The byte-level pre-tokenizer never puts the
two sides of such a place into one piece, so the count of a text is the sum of
the counts of its parts. The parts repeat across documents; each task encodes
its new distinct parts in batches balanced by bytes and keeps their lengths in
a bounded cache. No ids leave the tokenizer.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import binary_list, by_bytes

#: Bytes of distinct parts that go to one encode call.
ENCODE_BYTES = 256 << 10
#: Parts whose lengths a worker keeps; beyond it the cache is emptied.
CACHE_PARTS = 300_000
#: Bytes of text taken apart at a time.
BATCH_BYTES = 4 << 20

_PARTS = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
# White space other than ASCII, and the separators that libraries disagree on.
_RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \t-\r])")


def parts(text: str) -> list[str]:
    """Cut at safe boundaries; joined, the parts are the text again."""
    return _SAFE.split(text) if _RARE_SPACE.search(text) else _PARTS.findall(text)


class Counter:
    """Lengths by part for one tokenizer file (.json, or .model)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.lengths: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.parts = lambda text: [text]  # pieces may cross spaces here: whole texts only
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.encode = lambda texts: [len(x) for x in t.encode_batch(texts, add_special_tokens=False)]
            self.parts = parts

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.parts(t) for t in texts]
        known = self.lengths
        new = list(dict.fromkeys(p for c in cut for p in c if p not in known))
        for run in by_bytes(new, len, ENCODE_BYTES):
            known.update(zip(run, self.encode(run)))
        out = [sum(map(known.__getitem__, c)) for c in cut]
        if len(known) > CACHE_PARTS:
            known.clear()
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row.

    ``tokenizer`` is a path that every executor can open. A null text counts as
    empty (0 bytes, 0 tokens). Special strings inside texts are treated as the
    library does by default; begin, end and added tokens are not counted.
    Other columns are ignored; equal rows give equal results.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            at = 0
            for texts in by_bytes(binary_list(b.column(1)), len, BATCH_BYTES):
                n = counter(tokenizer).count([t.decode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()),
                ], names=["key", "n_bytes", "n_tokens", "over_limit"])
                at += len(texts)

    out = docs.select(id_col, text_col).mapInArrow(
        run, f"key {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("key", id_col)
