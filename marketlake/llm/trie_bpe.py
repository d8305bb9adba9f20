"""BPE encoding and decoding by prefix-sharing trie traversal.

The encoding of any prefix of a word ends in one definite token, and a token
sequence is the BPE encoding of its text exactly when every two neighbours
are (no merge crosses their border earlier than the merges inside them). So
the encoding of a prefix is known from its last token and the last tokens of
shorter prefixes.

The distinct words of a batch form a trie, laid out as the sorted word list:
walking it in order is the depth-first traversal, and the common prefix with
the previous word is the part of the path that is already on the stack. Each
trie node holds the last token of its prefix; a node is computed once for all
words below it. The last symbol of a word carries the end-of-word mark, so a
leaf chooses among tokens that end a word.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from marketlake.llm.common import by_bytes

#: Bytes of encodings that a worker keeps, about; half of it is used anew, what was not used meanwhile is forgotten.
CACHE_BYTES = 80 << 20
#: Pairs of tokens whose compatibility a worker keeps.
CACHE_PAIRS = 400_000
BATCH_CHARS = 2 << 20

# White space as the tokenizer's patterns see it (U+001C to U+001F are none).
_SPACE = "\t-\r \x85\xa0  -     　"
# Letters and numbers that this Python's Unicode does not know yet: what they are to a tokenizer, its library says.
_NEW = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
        if unicodedata.category(c) == "Cn"]


# Cuts words into pieces where no character is one of those that a tokenizer's library knows less of.
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")


def _classes(tokenizer: Tokenizer) -> tuple[frozenset[str], regex.Pattern, dict[int, str]]:
    """New characters that are no letters or numbers to the library, the pattern for words that hold one
    (slower by far), and the small letters of new capitals."""
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    other = frozenset(c for c in _NEW if len(split("!" + c)) == 1)
    none = "".join(sorted(other)) or "\0"
    letter, number = (rf"[\p{{{k}}}--[{none}]]" for k in "LN")
    pieces = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|[^{_SPACE}[{letter}||{number}]]+", regex.V1)
    lowered = {ord(c): tokenizer.normalizer.normalize_str(c) for c in _NEW}
    return other, pieces, {c: t for c, t in lowered.items() if t != chr(c)}


_SPACES = regex.compile(f"[{_SPACE}]+")
_ODD = regex.compile("[\x1c-\x1f]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TrieBPE:
    """One tokenizer: vocabulary, merges and the caches of a worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self._special = regex.compile("|".join(regex.escape(t) for t in self.special)) if self.special else None
        self._other, self._pieces, self._lowered = _classes(Tokenizer.from_file(path))
        self._capital = regex.compile("[" + "".join(map(chr, self._lowered)) + "]") if self._lowered else None
        self.digits = {i: str(i) for i in self.tokens}
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.rank: dict[int, int] = {}          # the merge that makes a token
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            made, pair = vocab[a + b], (vocab[a], vocab[b])
            self.merges[pair] = r
            if made not in self.rank:
                self.rank[made], self.halves[made] = r, pair
        inner, final = {}, {}
        ok: dict[int, bool] = {}
        for t, i in sorted(vocab.items(), key=lambda x: self.rank.get(x[1], -1)):
            if i in self.halves:
                a, b = self.halves[i]
                ok[i] = ok.get(a, False) and ok.get(b, False) and self._apart(a, b, self.rank[i])
            else:
                ok[i] = True
            if ok[i]:
                if suffix and t.endswith(suffix) and t != suffix:
                    final[t[:-len(suffix)]] = i
                else:
                    inner[t] = i
        self.inner, self.final = inner, final if suffix else inner
        self.width = {i: len(t) for t, i in inner.items()} | {i: len(t) for t, i in final.items()}
        # every beginning of a token, with the id of the inner token that it is, or -1
        self.begins = {t[:k]: -1 for d in (inner, self.final) for t in d for k in range(1, len(t) + 1)} | inner
        self.pairs: dict[int, bool] = {}
        # special strings are kept under tuples, which no text is equal to
        self.known: dict[str | tuple[str], tuple[str, str]] = {}
        self.older: dict[str | tuple[str], tuple[str, str]] = {}
        self.held = 0

    def _apart(self, a: int, b: int, limit: int) -> bool:
        """No merge joins the border of tokens a and b before merge ``limit``.

        Undoes the merges of both sides from the latest to the earliest. At
        each stage the two symbols at the border must have no merge that comes
        earlier than the one just undone; of equal merges the left one is first.
        """
        bound = (limit, 0)
        while True:
            r = self.merges.get((a, b))
            if r is not None and (r, 1) < bound:
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                bound, a = (ra, 0), self.halves[a][1]
            else:
                bound, b = (rb, 2), self.halves[b][0]

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct word (in byte letters), sharing prefixes.

        A node holds the last token of its prefix and ``low``, the first start
        from which the rest of the prefix still begins some token; no token
        ending further down can start before it.
        """
        out, before = {}, ""
        states, lows = [-1], [0]
        inner, final, width, begins, pairs, apart = (
            self.inner.get, self.final.get, self.width, self.begins.get, self.pairs, self._apart)
        for w in sorted(words):
            n, k = len(w), 0
            top = min(n - 1, len(states) - 1)
            while k < top and w[k] == before[k]:
                k += 1
            del states[k + 1:], lows[k + 1:]
            low = lows[k]
            for end in range(k + 1, n + 1):
                t = begins(w[low:end])
                while t is None:
                    low += 1
                    t = begins(w[low:end]) if low < end else -1
                if end == n:
                    t = final(w[low:end], -1)
                start = low
                while True:
                    if t >= 0:
                        if start == 0:
                            break
                        key = states[start] << 20 | t
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = apart(states[start], t, 1 << 40)
                        if fits:
                            break
                    start += 1
                    if start >= end:
                        raise ValueError(f"no token ends {w[:end]!r}")
                    t = inner(w[start:end], -1) if end < n else final(w[start:end], -1)
                if end < n:
                    states.append(t)
                    lows.append(low)
            ids, end = [t], n - width[t]
            while end > 0:
                t = states[end]
                ids.append(t)
                end -= width[t]
            ids.reverse()
            out[w] = ids
            before = w
        return out

    def learn(self, chunks: list[str]) -> None:
        """Add texts without white space, and their pieces, to the cache: (ids, decoded)."""
        table, digits, tokens, known = str.maketrans(self.letters), self.digits, self.tokens, self.known
        cut, pieces = {}, set()
        for c in chunks:
            if not c.isalpha():
                ps = (_PIECES if c.isascii() or self._other.isdisjoint(c) else self._pieces).findall(c)
                if len(ps) > 1:
                    cut[c] = ps
                    pieces.update(ps)
                    continue
            pieces.add(c)
        pieces.difference_update(known)
        # printable ASCII stands for itself
        letters = {p: p if p.isascii() and p.isprintable() else p.encode("utf-8").decode("latin-1").translate(table)
                   for p in self._unknown(pieces)}
        codes, held = self.encode_words(list(letters.values())), 0
        for p, w in letters.items():
            ids = codes[w]
            known[p] = entry = (" ".join([digits[i] for i in ids]), " ".join([tokens[i] for i in ids]))
            held += len(p) + len(entry[0]) + len(entry[1]) + 300
        for c, ps in cut.items():
            ids, decoded = zip(*[known[p] for p in ps])
            known[c] = entry = (" ".join(ids), " ".join(decoded))
            held += len(c) + len(entry[0]) + len(entry[1]) + 300
        self.held += held
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()

    def _unknown(self, chunks: set) -> set:
        """Those without an older encoding; an older one is kept for longer."""
        again = chunks & self.older.keys()
        for c in again:
            self.known[c] = entry = self.older.pop(c)
            self.held += len(c) + len(entry[0]) + len(entry[1]) + 300
        return chunks - again

    def chunks(self, text: str) -> list[str | tuple[str]]:
        """Normalised pieces between white space; a special string stands as it is, in a tuple."""
        if self._special is not None and self._special.search(text):
            out, at = [], 0
            for m in self._special.finditer(text):
                out += self.chunks(text[at:m.start()]) + [(m[0],)]
                at = m.end()
            return out + self.chunks(text[at:])
        text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()  # letter by letter, without the final-sigma rule
        if self._capital is not None and not text.isascii() and self._capital.search(text):
            text = text.translate(self._lowered)
        return [c for c in _SPACES.split(text) if c] if _ODD.search(text) else text.split()

    def run(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text: number of ids, the ids and the decoded text, joined by spaces."""
        on = gc.isenabled()
        gc.disable()  # many small lists are made, none of them in a cycle
        try:
            return self._run(texts)
        finally:
            if on:
                gc.enable()

    def _run(self, texts: list[str]) -> list[tuple[int, str, str]]:
        cut = [self.chunks(t) for t in texts]
        if self.held > CACHE_BYTES // 2:
            self.older, self.known, self.held = self.known, {}, 0
        new = self._unknown(set().union(*cut).difference(self.known))
        for c in [c for c in new if isinstance(c, tuple)]:
            new.discard(c)
            i = self.special[c[0]]
            self.known[c] = (str(i), self.tokens[i])
        self.learn(list(new))
        out = []
        for cs in cut:
            if cs:
                ids, decoded = zip(*map(self.known.__getitem__, cs))
                ids = " ".join(ids)
                out.append((ids.count(" ") + 1, ids, " ".join(decoded)))
            else:
                out.append((0, "", ""))
        return out


_LOADED: dict[str, TrieBPE] = {}


def load(path: str) -> TrieBPE:
    if path not in _LOADED:
        _LOADED[path] = TrieBPE(path)
    return _LOADED[path]


def bpe(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
        keep: bool = False) -> DataFrame:
    """Encode and decode every text.

    Returns ``id_col``, n_tokens, ids_sha256 (of the decimal ids joined by one
    space), decoded_sha256; with ``keep`` also ``ids`` (array) and ``decoded``.
    The tokenizer has no decoder, so decoding joins the tokens by one space, as
    its library does. A null text is empty: 0 tokens and the digests of ''.
    ``tokenizer`` is a path that every executor can open. Other columns are
    ignored; equal rows give equal results.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            at = 0
            for texts in by_bytes(b.column(1).to_pylist(), lambda t: len(t or ""), BATCH_CHARS):
                got = load(tokenizer).run([t or "" for t in texts])
                sha = [[hashlib.sha256(g[k].encode("utf-8")).hexdigest() for g in got] for k in (1, 2)]
                columns = [b.column(0).slice(at, len(texts)), pa.array([g[0] for g in got], pa.int64()),
                           pa.array(sha[0], pa.string()), pa.array(sha[1], pa.string())]
                names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    columns += [pa.array([[int(i) for i in g[1].split()] for g in got], pa.list_(pa.int32())),
                                pa.array([g[2] for g in got], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at += len(texts)

    schema = f"key {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    out = docs.select(id_col, text_col).mapInArrow(
        run, schema + (", ids array<int>, decoded string" if keep else ""))
    return out.withColumnRenamed("key", id_col)


def decode(ids: list[int], tokenizer: str) -> str:
    return " ".join(load(tokenizer).tokens[i] for i in ids)
