"""Toxicity by weak supervision.

Many weak voters look at a text: shards of a lexicon of words and of word
beginnings, mined from labelled training rows, a fixed list of insults, and
patterns (shouting, rows of exclamation marks, stretched and masked words).
Each says 'toxic' or abstains.

A generative model of all votes and the unseen class estimates how each voter
behaves in either class (its accuracy) and which voters fire together beyond
that (their correlations). It is log-linear, with one weight for each voter and
class and one for each correlated pair, and is fitted by maximum likelihood to
the vote patterns of all documents (there are at most 2^14) and to the patterns
of labelled training rows, whose class is known. All patterns are enumerated,
so its normaliser is exact.

The model's posterior labels then train a linear classifier on the mined words,
word beginnings and votes. The classifier scores every text.

Bounded parameters: the lexicon and the classifier are learnt from at most
about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of their id, and use at
most ``FEATURES`` words and beginnings. Votes are counted over all documents.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.sketch import sketch

SAMPLE_ROWS = 40_000
FEATURES = 2048
#: A feature must occur in so many toxic or clean documents of the sample and tell so much (G²/2).
LEAST_DOCS, LEAST_G2 = 3, 6.0
#: A voter's features must be toxic in this share of their documents.
PRECISION = 0.9
STEMS = (4, 5, 6, 7)
WORD_VOTERS, STEM_VOTERS = 6, 3
PAIRS = 16
CACHE_WORDS = 400_000
#: How much the label of a training row counts beside the votes: an annotator with this accuracy.
ANNOTATOR = 0.99

#: Fixed list of insults, whatever the labels say.
INSULTS = frozenset((
    "idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown dumb imbecile "
    "fool garbage jerk dimwit idiota estúpido basura imbécil asqueroso inútil idiote stupide ordure minable nul "
    "crétin dégoûtant dumm trottel abschaum müll widerlich wertlos erbärmlich").split())

_WORD = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1{3}")
_MASKED = re.compile(r"[^\W\d_][*#@$]{2,}")
_UPPER = bytes(range(0x41, 0x5B))


def _shouts(text: str) -> bool:
    """At least 40 ASCII letters, more than half of them capitals."""
    data = text.encode("utf-8")
    upper = len(data) - len(data.translate(None, _UPPER))
    lower = len(data) - len(data.translate(None, _UPPER.lower()))
    return upper > lower and upper + lower >= 40


#: Besides these, words with a letter four times in a row are a pattern.
_PATTERNS = (
    lambda t: t.count("!!") >= 3,
    _shouts,
    lambda t: any(x in t for x in "*#@$") and _MASKED.search(t) is not None,
)
VOTERS = WORD_VOTERS + STEM_VOTERS + 2 + len(_PATTERNS)


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features(word: str) -> list[str]:
    """A word and its beginnings; a beginning is marked by a trailing '-'."""
    return [word, *(word[:n] + "-" for n in STEMS if len(word) > n)]


# --- the lexicon ---------------------------------------------------------------

def sample_labels(labels: DataFrame, rows: int, id_col: str, label_col: str) -> DataFrame:
    """At most about ``rows`` labelled rows, by a hash of the id."""
    given = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    n = given.count()
    if n > rows:
        given = given.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    return given


def mine(sample: DataFrame, text_col: str, features: int) -> list[tuple[str, int, int]]:
    """(feature, toxic documents, clean documents) of the features that tell most (by G²)."""
    def count(batches):
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for f in {f for w in _words(text or "") for f in _features(w)}:
                    seen.setdefault(f, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()),
                 pa.array([v[0] for v in seen.values()], pa.int64())], names=["feature", "bad", "good"])

    def group(batches):
        for b in batches:
            texts = [t or "" for t in b.column(0).to_pylist()]
            least = [sketch(t, fraction=1.0)[:1].tolist() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), b.column(1), pa.array([x[0] if x else None for x in least], pa.int64())],
                names=["text", "toxic", "least"])

    # copies count once, and so do near copies: those with the same smallest shingle hash
    rows = (sample.select(text_col, "toxic").mapInArrow(group, "text string, toxic int, least bigint")
            .groupBy("least", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0) + 1, n.get(0, 0) + 1
    counted = rows.mapInArrow(count, "feature string, bad bigint, good bigint").groupBy("feature").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(
        F.greatest("bad", "good") >= LEAST_DOCS)

    def part(k, e):
        return F.when(k > 0, k * F.log(k / e)).otherwise(0.0)

    both = F.col("bad") + F.col("good")
    eb, eg = both * bad / (bad + good), both * good / (bad + good)
    g2 = part(F.col("bad"), eb) + part(F.col("good"), eg) + part(bad - F.col("bad"), bad - eb) + part(
        good - F.col("good"), good - eg)
    top = counted.withColumn("g2", g2).where(F.col("g2") > LEAST_G2).orderBy(F.desc("g2"), "feature").limit(features)
    return [(r["feature"], r["bad"], r["good"]) for r in top.collect()]


@dataclass
class Lexicon:
    """The mined features and the voters that use them."""

    number: dict[str, int] = field(default_factory=dict)
    voter: dict[int, int] = field(default_factory=dict)

    @classmethod
    def of(cls, mined: list[tuple[str, int, int]]) -> Lexicon:
        out = cls({f: i for i, (f, _, _) in enumerate(mined)})
        words = stems = 0
        for i, (f, bad, good) in enumerate(mined):
            if (bad + 0.5) / (bad + good + 0.5) < PRECISION:
                continue
            if f.endswith("-"):
                out.voter[i] = WORD_VOTERS + stems % STEM_VOTERS
                stems += 1
            else:
                out.voter[i] = words % WORD_VOTERS
                words += 1
        return out


class Reader:
    """Features and votes of texts; keeps what it found out about words."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, ...]] = {}
        self.stretched: set[str] = set()

    def _word(self, w: str) -> tuple[int, ...]:
        number = self.lexicon.number
        return tuple(number[f] for f in _features(w) if f in number)

    def read(self, text: str) -> tuple[set[int], int]:
        """(features, votes as bits)."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
            self.stretched.clear()
        found: set[int] = set()
        votes = 0
        words = _words(text)
        for w in words:
            f = known.get(w)
            if f is None:
                f = known[w] = self._word(w)
                if _STRETCHED.search(w):
                    self.stretched.add(w)
            if f:
                found.update(f)
        for f in found:
            v = self.lexicon.voter.get(f)
            if v is not None:
                votes |= 1 << v
        if not INSULTS.isdisjoint(words):
            votes |= 1 << (WORD_VOTERS + STEM_VOTERS)
        if not self.stretched.isdisjoint(words):
            votes |= 1 << (WORD_VOTERS + STEM_VOTERS + 1)
        for i, p in enumerate(_PATTERNS):
            if p(text):
                votes |= 1 << (WORD_VOTERS + STEM_VOTERS + 2 + i)
        return found, votes


# --- the generative label model ------------------------------------------------

def _bits(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] >> np.arange(VOTERS) & 1).astype(np.float64)


@dataclass
class LabelModel:
    prior: float             # log odds weight of the toxic class
    weights: np.ndarray      # class, voter
    pairs: list[tuple[int, int]]
    together: np.ndarray     # weight of each pair

    def _energy(self, patterns: np.ndarray) -> np.ndarray:
        """Unnormalised log probability of (class, pattern)."""
        x = _bits(patterns)
        joint = (np.stack([x[:, i] * x[:, j] for i, j in self.pairs], 1) @ self.together) if self.pairs else 0.0
        return np.stack([x @ self.weights[0] + joint, x @ self.weights[1] + joint + self.prior])

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        e = self._energy(patterns)
        return 1 / (1 + np.exp(np.clip(e[0] - e[1], -60, 60)))

    def accuracies(self, every: np.ndarray | None = None) -> np.ndarray:
        """For each voter the model's probability that the class is toxic when it fires."""
        every = np.arange(1 << VOTERS) if every is None else every
        e = self._energy(every)
        p = np.exp(e - e.max())
        x = _bits(every)
        return (p[1] @ x) / np.maximum((p[0] + p[1]) @ x, 1e-300)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, bad: np.ndarray, good: np.ndarray,
                    steps: int = 300, pairs: int = PAIRS) -> LabelModel:
    """Maximum likelihood from all patterns (counts) and labelled ones (bad, good: rows by class).

    The labelled rows are also among ``counts``; they enter as known there
    instead. First the voters are taken as independent given the class (rates
    among the labelled rows, without any by EM), then the pairs that fire together most beyond that get weights, and all
    weights are fitted together (gradient steps on the exact likelihood).
    """
    x = _bits(patterns)
    free = np.maximum(counts - bad - good, 0).astype(np.float64)
    total = max(1.0, free.sum() + bad.sum() + good.sum())
    # start: a row with more votes is likelier toxic; labelled rows, if there are both kinds, know better
    q = np.clip(0.02 + 0.3 * x.sum(1), 0, 0.95)
    labelled = min(bad.sum(), good.sum()) > 0
    for _ in range(2 if labelled else 50):
        toxic, clean = (bad, good) if labelled else (free * q + bad, free * (1 - q) + good)
        rate = np.stack([(x.T @ w + 0.05) / (w.sum() + 1.0) for w in (clean, toxic)])
        prior = np.log((toxic.sum() + 0.5) / (clean.sum() + 0.5))
        odds = np.log(rate / (1 - rate))
        level = np.log(1 - rate).sum(1)
        score = prior + level[1] - level[0] + x @ (odds[1] - odds[0])
        q = 1 / (1 + np.exp(-np.clip(score, -60, 60)))
    weights, bias = odds.copy(), prior + level[1] - level[0]
    # correlations left within the classes
    left = np.zeros((VOTERS, VOTERS))
    for w in (free * (1 - q) + good, free * q + bad):
        n = max(1.0, w.sum())
        m = (x.T @ w) / n
        cov = (x.T * w) @ x / n - np.outer(m, m)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        left += np.abs(cov / np.outer(sd, sd)) * n / total
    chosen = sorted(combinations(range(VOTERS), 2), key=lambda p: -left[p])[:pairs]
    chosen = [p for p in chosen if left[p] > 0.02]
    model = LabelModel(float(bias), weights, chosen, np.zeros(len(chosen)))
    every = np.arange(1 << VOTERS)
    ex = _bits(every)
    joint = lambda y: np.stack([y[:, i] * y[:, j] for i, j in chosen], 1) if chosen else np.zeros((len(y), 0))
    ej, xj = joint(ex), joint(x)
    theta = np.concatenate([[model.prior], model.weights.ravel(), model.together])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    keep = theta.copy()
    for step in range(1, steps + 1):
        model.prior, model.weights, model.together = (
            theta[0], theta[1:1 + 2 * VOTERS].reshape(2, VOTERS), theta[1 + 2 * VOTERS:])
        e = np.stack([ex @ model.weights[0] + ej @ model.together,
                      ex @ model.weights[1] + ej @ model.together + model.prior])
        p = np.exp(e - e.max())
        p /= p.sum()
        q = model.posterior(patterns)
        toxic, clean = (free * q + bad) / total, (free * (1 - q) + good) / total
        grad = np.concatenate([
            [toxic.sum() - p[1].sum()], x.T @ clean - ex.T @ p[0], x.T @ toxic - ex.T @ p[1],
            xj.T @ (toxic + clean) - ej.T @ (p[0] + p[1])]) - 1e-4 * (theta - keep)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        theta = theta + 0.03 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    model.prior = float(theta[0])
    model.weights, model.together = theta[1:1 + 2 * VOTERS].reshape(2, VOTERS), theta[1 + 2 * VOTERS:]
    return model


# --- the linear classifier ------------------------------------------------------

@dataclass
class Classifier:
    bias: float
    weights: np.ndarray  # features, then voters

    def score(self, found: set[int], votes: int) -> float:
        z, w, n = self.bias, self.weights, len(self.weights) - VOTERS
        for f in found:
            z += w[f]
        i = n
        while votes:
            if votes & 1:
                z += w[i]
            votes >>= 1
            i += 1
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, z)))))


def fit_classifier(rows: list[tuple[list[int], int, float]], features: int, steps: int = 400,
                   decay: float = 2e-4) -> Classifier:
    """Logistic regression on (features, votes, posterior label) rows."""
    n = features + VOTERS
    if not rows:
        return Classifier(-3.0, np.zeros(n))
    at = np.repeat(np.arange(len(rows)), [len(f) + v.bit_count() for f, v, _ in rows])
    col = np.array([c for f, v, _ in rows for c in (*f, *(features + i for i in range(VOTERS) if v >> i & 1))], np.int64)
    target = np.array([q for _, _, q in rows])
    theta, m1, m2 = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    theta[n] = np.log((target.sum() + 0.5) / (len(rows) - target.sum() + 0.5))
    for step in range(1, steps + 1):
        z = theta[n] + np.bincount(at, weights=theta[col], minlength=len(rows))
        error = target - 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        grad = np.empty(n + 1)
        grad[:n] = np.bincount(col, weights=error[at], minlength=n) / len(rows) - decay * theta[:n]
        grad[n] = error.mean()
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        theta += 0.05 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return Classifier(float(theta[n]), theta[:n])


# --- the operator ----------------------------------------------------------------

@dataclass
class Model:
    lexicon: Lexicon
    label_model: LabelModel
    classifier: Classifier


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Learn from ``labels`` (training rows only) and the votes on all ``docs``.

    Labels that are null, or whose id is null or not in ``docs``, teach nothing;
    of repeated labels the largest counts. Without any labels the fixed list
    and the patterns are the only voters that fire. Null texts are empty.
    """
    spark = docs.sparkSession
    # at most about sample_rows rows of two numbers: broadcast
    picked = F.broadcast(sample_labels(labels, sample_rows, id_col, label_col).withColumnsRenamed({id_col: "picked_id"}))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        picked, F.col("id") == F.col("picked_id")).select("text", "toxic")
    mined = mine(sample, "text", features)
    lexicon = spark.sparkContext.broadcast(Lexicon.of(mined))

    def votes(batches):
        reader = Reader(lexicon.value)
        for b in batches:
            v = [reader.read(t or "")[1] for t in b.column(0).to_pylist()]
            patterns, n = np.unique(np.array(v, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(patterns), pa.array(n.astype(np.int64))], names=["votes", "n"])

    def examples(batches):
        reader = Reader(lexicon.value)
        for b in batches:
            got = [reader.read(t or "") for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(f) for f, _ in got], pa.list_(pa.int32())), pa.array([v for _, v in got], pa.int64()),
                 b.column(1)], names=["features", "votes", "toxic"])

    # at most 2^VOTERS patterns, whatever the corpus
    counted = (docs.select(text_col).mapInArrow(votes, "votes bigint, n bigint").groupBy("votes")
               .agg(F.sum("n").alias("n")).collect())
    rows = sample.mapInArrow(examples, "features array<int>, votes bigint, toxic int").collect()
    patterns = np.array([r["votes"] for r in counted], np.int64)
    counts = np.array([r["n"] for r in counted], np.float64)
    place = {int(p): i for i, p in enumerate(patterns)}
    known = np.zeros((2, len(patterns)))
    for r in rows:
        known[r["toxic"], place[r["votes"]]] += 1
    label_model = fit_label_model(patterns, counts, known[1], known[0])
    posterior = dict(zip(patterns.tolist(), label_model.posterior(patterns).tolist()))
    annotator = np.log(ANNOTATOR / (1 - ANNOTATOR))
    taught = []
    for r in rows:
        p = min(1 - 1e-9, max(1e-9, posterior[r["votes"]]))
        z = np.log(p / (1 - p)) + (annotator if r["toxic"] else -annotator)
        taught.append((r["features"], r["votes"], float(1 / (1 + np.exp(-z)))))
    return Model(lexicon.value, label_model, fit_classifier(taught, len(mined)))


def _scorer(model):
    """A function text -> score, in a task."""
    reader = Reader(model.value.lexicon)
    classifier = model.value.classifier
    return lambda text: classifier.score(*reader.read(text or ""))


def scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = 0.5) -> DataFrame:
    """``id_col``, score and predicted for every row; a null text scores like an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        score = _scorer(shared)
        for b in batches:
            s = [score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
                names=["key", "score", "predicted"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"key {id_type}, score double, predicted int").withColumnRenamed("key", id_col)


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; same columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches):
        score = _scorer(shared)
        for b in batches:
            yield b.filter(pa.array([score(t) < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def training_labels(labels: DataFrame, id_col: str = "doc_id", folds: int = 5) -> DataFrame:
    """The labels of rows outside the held-out fold (crc32 of the id as text, modulo ``folds``, is 0)."""
    return labels.where(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != 0)


def held_out(doc_id, folds: int = 5) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == 0
