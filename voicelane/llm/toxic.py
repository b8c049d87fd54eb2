"""Toxic spans by a linear-chain conditional random field.

Labels are given per document, so token labels are derived from them: affixes and
words that occur in toxic training documents far more often than chance form a
lexicon of weights, and a token of a toxic document is labelled toxic if its weight is
high. A chain of two states is fitted to token sequences from a bounded sample of
training rows, by the gradient of its likelihood. A document is scored from the
forward-backward marginals of its tokens and from the probability that no token is
toxic, calibrated on training rows; spans are tokens whose marginal is at least 1/2.

The lexicon counts all training rows. Tokens whose own and neighbouring weights are
all low see constant potentials, so the chain jumps over them by matrix powers; the
result is that of the plain recursion.

Null and empty texts have no tokens and get the score of a document without hits.
Without training rows of both classes every score is the share of toxic rows (0.5
without rows). Repeated rows are scored row by row; a document with several labels
counts with the largest; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voicelane.llm.common import (
    folded_words, record_batch, slices, small_batches, staged, word_spans,
)

#: Labels that a task may hold (16 bytes each); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000


@dataclass(frozen=True)
class Settings:
    #: Training rows per class used to fit the chain and the calibration. Counts of
    #: words and affixes use all training rows.
    sample: int = 2_000
    #: Tokens of a sampled text that may enter the chain's training sequences.
    sequence: int = 64
    max_features: int = 50_000
    min_toxic: int = 5
    affixes: tuple[int, ...] = (4, 5, 6)
    #: Bounds of the weight buckets (log-odds).
    bounds: tuple[float, ...] = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0)
    #: From this weight on a token of a toxic document is labelled toxic.
    label_weight: float = 3.0
    l2: float = 1e-3
    steps: int = 200


DEFAULT = Settings()


def features(word: str, affixes: tuple[int, ...]) -> list[str]:
    """A word, its heads and its tails, each marked by its kind."""
    return [
        word,
        *[f"<{word[:k]}" for k in affixes if len(word) > k],
        *[f">{word[-k:]}" for k in affixes if len(word) > k],
    ]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per class that hold a word, added up within a task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush():
        words = sorted(counts[0].keys() | counts[1].keys())
        columns = [pa.array(words, pa.binary()), *[pa.array([c[w] for w in words], pa.int64()) for c in counts]]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "clean", "toxic"])

    for part in slices(batches):
        for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
            counts[label].update(set(folded_words(text)))
        if len(counts[0]) + len(counts[1]) > 300_000:
            yield flush()
    yield flush()


def lexicon(train: DataFrame, settings: Settings = DEFAULT) -> dict[str, float]:
    """Log-odds of features in toxic documents, the ``max_features`` clearest ones."""
    words = (
        train.select("text", "label").mapInArrow(_count_words, "word binary, clean bigint, toxic bigint")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("word", F.col("word").cast("string"))
    )
    words = staged(words, "toxic-words")
    n = F.length("word")
    kinds = [F.struct(F.col("word").alias("f"))]
    for k in settings.affixes:
        kinds += [
            F.when(n > k, F.struct(F.concat(F.lit("<"), F.substring("word", 1, k)).alias("f"))),
            F.when(n > k, F.struct(F.concat(F.lit(">"), F.substring(F.col("word"), F.lit(-k), F.lit(k))).alias("f"))),
        ]
    listed = F.filter(F.array(*kinds), lambda s: s.isNotNull())
    # Only features that occur in toxic rows often enough can be chosen.
    often = (
        words.filter("toxic > 0").select("toxic", F.explode(listed).alias("s"))
        .groupBy("s.f").agg(F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= settings.min_toxic)
    )
    clean = words.filter("clean > 0").select("clean", F.explode(listed).alias("s")).groupBy("s.f").agg(F.sum("clean").alias("clean"))
    met = often.join(clean, "f", "left").fillna(0, ["clean"])
    totals = words.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not totals["t"] or not totals["c"]:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (totals["t"] + 1.0)) - F.log((F.col("clean") + 0.5) / (totals["c"] + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = (
        met.select("f", odds.alias("weight"), (odds / error).alias("z"))
        .filter((F.col("weight") >= settings.bounds[0]) & (F.col("z") >= 3))
    )
    # A histogram of z finds the bound first, so only about max_features rows travel.
    steps = best.groupBy(F.floor(F.col("z") * 20).alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step"))
    kept, limit = 0, None
    for row in steps.collect():  # one row per twentieth of z
        if kept + row["n"] > settings.max_features:
            break
        kept, limit = kept + row["n"], row["step"]
    if limit is None:
        return {}
    rows = best.filter(F.floor(F.col("z") * 20) >= limit).select("f", "weight").collect()
    return {r["f"]: r["weight"] for r in rows}


class Buckets(dict):
    """Weight bucket of a word (0: none), the best of its features."""

    def __init__(self, weights: dict[str, float], settings: Settings):
        super().__init__()
        self.weights, self.settings = weights, settings

    def weight(self, word: bytes) -> float:
        names = features(word.decode("utf-8", "replace"), self.settings.affixes)
        return max([self.weights.get(f, 0.0) for f in names])

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = int(np.searchsorted(self.settings.bounds, self.weight(word), "right"))
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int8, len(words))


@dataclass
class Chain:
    """Two states; potentials from the buckets of a token and of its neighbours."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    move: np.ndarray
    start: np.ndarray
    calibration: np.ndarray = field(default_factory=lambda: np.zeros(5))

    @classmethod
    def blank(cls, k: int) -> Chain:
        return cls(np.zeros(k), np.zeros(k), np.zeros(k), np.zeros((2, 2)), np.zeros(2))

    def vector(self) -> np.ndarray:
        return np.concatenate([self.own, self.before, self.after, self.move.ravel(), self.start])

    @classmethod
    def of(cls, v: np.ndarray, k: int) -> Chain:
        return cls(v[:k], v[k : 2 * k], v[2 * k : 3 * k], v[3 * k : 3 * k + 4].reshape(2, 2), v[3 * k + 4 :])

    def log_odds(self, b: np.ndarray) -> np.ndarray:
        """Potential of state 1 against state 0 for each token (last axis)."""
        zero = np.zeros((*b.shape[:-1], 1), b.dtype)
        left = np.concatenate((zero, b[..., :-1]), -1)
        right = np.concatenate((b[..., 1:], zero), -1)
        return self.own[b] + self.before[left] + self.after[right]


def fit_chain(b: np.ndarray, y: np.ndarray, mask: np.ndarray, k: int, settings: Settings) -> Chain:
    """Fit the chain to sequences (rows) of buckets and token labels by gradient ascent."""
    n, length = b.shape
    zero = np.zeros((n, 1), b.dtype)
    left, right = np.concatenate((zero, b[:, :-1]), 1), np.concatenate((b[:, 1:], zero), 1)
    vector = Chain.blank(k).vector()
    speed, memory = np.zeros_like(vector), np.zeros_like(vector)
    last = mask.sum(1) - 1
    for step in range(1, settings.steps + 1):
        chain = Chain.of(vector, k)
        emit = np.stack((np.zeros((n, length)), chain.log_odds(b)), -1)
        alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        alpha[:, 0] = chain.start + emit[:, 0]
        for t in range(1, length):
            alpha[:, t] = np.logaddexp(
                alpha[:, t - 1, :1] + chain.move[0], alpha[:, t - 1, 1:] + chain.move[1]
            ) + emit[:, t]
        for t in range(length - 2, -1, -1):
            ahead = emit[:, t + 1] + beta[:, t + 1]
            new = np.stack([np.logaddexp(chain.move[s, 0] + ahead[:, 0], chain.move[s, 1] + ahead[:, 1]) for s in (0, 1)], -1)
            beta[:, t] = np.where((t < last)[:, None], new, 0)
        total = np.logaddexp(*alpha[np.arange(n), last].T)[:, None]
        p = np.where(mask, np.exp(alpha[..., 1] + beta[..., 1] - total), 0)
        gap = np.where(mask, y - p, 0)
        both = mask[:, 1:]
        move = np.zeros((2, 2))
        for s in (0, 1):
            for t in (0, 1):
                joint = np.exp(alpha[:, :-1, s] + chain.move[s, t] + emit[:, 1:, t] + beta[:, 1:, t] - total)
                seen = (y[:, :-1] == s) & (y[:, 1:] == t)
                move[s, t] = ((seen - joint) * both).sum()
        first = gap[:, 0].sum()
        weigh = lambda x: np.bincount(x.ravel(), gap.ravel(), k)
        slope = np.concatenate([weigh(b), weigh(left), weigh(right), move.ravel(), [-first, first]]) / n - settings.l2 * vector
        speed = 0.9 * speed + 0.1 * slope
        memory = 0.99 * memory + 0.01 * slope**2
        vector = vector + 0.2 * (speed / (1 - 0.9**step)) / (np.sqrt(memory / (1 - 0.99**step)) + 1e-8)
    return Chain.of(vector, k)


def marginals(chain: Chain, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Places that need a look, P(toxic) there, and log P(no toxic token at all).

    A place needs a look if its own or a neighbouring bucket is not 0. Between such
    places the step matrix is constant, so a gap is one matrix power.
    """
    n = len(b)
    near = b > 0
    near[1:] |= b[:-1] > 0
    near[:-1] |= b[1:] > 0
    near[0] = True
    places = np.flatnonzero(near)
    odds = chain.log_odds(b)[places]
    plain = float(chain.own[0] + chain.before[0] + chain.after[0])
    # Step into a plain token: move, then its potential. Eigenvalues give powers.
    step = np.exp(chain.move + np.array([0.0, plain]))
    values, vectors = np.linalg.eig(step)
    values, vectors = values.real, vectors.real
    top = values.max()
    inverse = np.linalg.inv(vectors)
    gaps = np.diff(np.concatenate((places, [n]))) - 1

    def power(g: int) -> np.ndarray:
        return (vectors * (values / top) ** g) @ inverse

    move = np.exp(chain.move)
    forward, scale, log_total = [], [], 0.0
    now = np.exp(chain.start) * np.array([1.0, np.exp(odds[0])])
    for k in range(len(places)):
        if k:
            now = (forward[-1] @ power(gaps[k - 1]) @ move) * np.array([1.0, np.exp(odds[k])])
        size = now.sum()
        forward.append(now / size)
        scale.append(size)
        log_total += np.log(size)
    log_total += np.log((forward[-1] @ power(gaps[-1])).sum()) + gaps.sum() * np.log(top)
    log_none = chain.start[0] + (n - 1) * chain.move[0, 0]
    behind = power(gaps[-1]) @ np.ones(2)
    p = np.empty(len(places))
    for k in range(len(places) - 1, -1, -1):
        both = forward[k] * behind
        p[k] = both[1] / both.sum()
        if k:
            behind = power(gaps[k - 1]) @ move @ (np.array([1.0, np.exp(odds[k])]) * behind)
            behind /= behind.sum()
    return places, p, float(log_none - log_total)


def summary(chain: Chain, b: np.ndarray) -> tuple[list[float], np.ndarray, np.ndarray]:
    """What the calibration sees of a document; places and marginals of its tokens."""
    if not len(b) or not b.any():
        return [0.0, 0.0, 0.0, np.log1p(len(b))], np.empty(0, np.int64), np.empty(0)
    places, p, log_none = marginals(chain, b)
    expected = float(p[b[places] > 0].sum())
    none = min(0.0, log_none - plain_log_none(chain, len(b)))
    top = float(p.max())
    return [top, np.log1p(expected), np.log1p(-none), np.log1p(len(b))], places, p


def plain_log_none(chain: Chain, n: int) -> float:
    """log P(no toxic token) of n tokens without any weight."""
    _, _, log_none = marginals(chain, np.zeros(n, np.int8))
    return log_none


def fit_calibration(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - 1e-2 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Tagger:
    """A fitted model; small enough to be sent to every task."""

    weights: dict[str, float]
    chain: Chain | None
    prior: float
    settings: Settings

    def score(self, buckets: Buckets, words: list[bytes]) -> tuple[float, np.ndarray]:
        """Score of a document and the places of its toxic words."""
        if self.chain is None:
            return self.prior, np.empty(0, np.int64)
        seen, places, p = summary(self.chain, buckets.of(words))
        z = float(self.chain.calibration @ np.array([1.0, *seen]))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), places[p >= 0.5]


def train(rows: DataFrame, settings: Settings = DEFAULT) -> Tagger:
    """Fit a tagger on rows (doc_id, text, label 0 or 1)."""
    rows = rows.select("doc_id", "text", F.col("label").cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n, toxic = sum(sizes.values()), sizes.get(1, 0)
    prior = toxic / n if n else 0.5
    weights = lexicon(rows, settings) if 0 < toxic < n else {}
    if not weights:
        return Tagger({}, None, prior, settings)
    # Per class the rows with the smallest hashes of their ids, about `sample` of them.
    rate = {k: min(1.0, settings.sample / v) for k, v in sizes.items()}
    draw = (F.xxhash64(F.lit("sample"), "doc_id") / 2.0**64) + 0.5
    drawn = rows.filter(draw < F.when(F.col("label") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0)))
    kept = drawn.select("text", "label").mapInPandas(
        functools.partial(_shrink, weights, settings), "label int, buckets binary"
    ).collect()
    docs = [np.frombuffer(r["buckets"], np.int8) for r in kept]
    labels = np.array([r["label"] for r in kept])
    limit = int(np.searchsorted(settings.bounds, settings.label_weight, "right"))
    sequences, marks, masks = [], [], []
    for b, label in zip(docs, labels, strict=True):
        if not len(b):
            continue
        # One window per document, around its strongest token.
        at = max(0, min(int(np.argmax(b)) - settings.sequence // 2, len(b) - settings.sequence))
        own = b[at : at + settings.sequence]
        pad = settings.sequence - len(own)
        sequences.append(np.pad(own, (0, pad)))
        marks.append(np.pad((own >= limit) * label, (0, pad)))
        masks.append(np.pad(np.ones(len(own), bool), (0, pad)))
    k = len(settings.bounds) + 1
    chain = fit_chain(np.array(sequences), np.array(marks), np.array(masks), k, settings)
    seen = np.array([summary(chain, b)[0] for b in docs])
    w = fit_calibration(seen, labels)
    # The sample holds classes in other shares than the rows; the intercept is put right.
    odds = np.log(rate.get(1, 1.0)) - np.log(rate.get(0, 1.0))
    chain.calibration = w - np.array([odds, 0, 0, 0, 0])
    return Tagger(weights, chain, prior, settings)


def _shrink(weights, settings: Settings, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    buckets = Buckets(weights, settings)
    for pdf in batches:
        yield pd.DataFrame(
            {"label": pdf["label"], "buckets": [buckets.of(folded_words(t)).tobytes() for t in pdf["text"]]}
        )


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _score(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tagger = shared.value
    buckets = Buckets(tagger.weights, tagger.settings)
    for part in slices(batches):
        scores, spans = [], []
        for text in part.column("text").to_pylist():
            score, places = tagger.score(buckets, folded_words(text))
            starts, stops = word_spans(text) if len(places) else ((), ())
            scores.append(score)
            spans.append([{"start": int(starts[k]), "stop": int(stops[k])} for k in places])
        yield record_batch(
            [part.column("doc_id"), scores, spans], ["doc_id", "score", "spans"],
            [pa.int64(), pa.float64(), _SPANS],
        )


def tag(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, score and the character spans of toxic words, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    rows = small_batches(docs).select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(
        functools.partial(_score, shared),
        "doc_id bigint, score double, spans array<struct<start:int,stop:int>>",
    )


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label of documents with a label; labels are joined by id."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("label")
    )
    # Sent to all tasks only if counted to be small; else both sides are shuffled.
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return docs.select("doc_id", "text").join(known, "doc_id")
