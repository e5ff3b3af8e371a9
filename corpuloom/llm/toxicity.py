"""Toxicity by subword bags: a linear softmax over averaged embeddings, trained jointly in numpy.

The features of a word are the word and its character n-grams, hashed into buckets, so a misspelling never seen in
training still shares most n-gram vectors with the word it stands for. A document is the average over the features of
all its words. The model is linear behind the average, so at scoring time each distinct word has one number (the sum
of its features' logits) and one count, and a document is two sums; no window or prefix is taken.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuloom.llm.labelled import fold, training_sample
from corpuloom.llm.shared import slices

WORDS = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dim: int = 4
    least: int = 3
    longest: int = 5
    epochs: int = 14
    rate: float = 0.2
    prior_docs: float = 2.0
    least_docs: int = 5
    share: float = 0.2
    false_alarm: float = 3.0  # what share of clean texts accepted weighs against a share of toxic texts caught
    set_aside: int = 8
    slack: float = 0.02
    seed: int = 7


def features(word: str, s: Settings) -> list[int]:
    """Buckets of the word and of its n-grams, with marks at its ends; a very long word has them all."""
    marked = f"<{word}>".encode()
    n, mask = len(marked), s.buckets - 1
    out = [crc32(marked) & mask]
    for k in range(s.least, s.longest + 1):
        out += [crc32(marked[i : i + k]) & mask for i in range(n - k + 1)]
    return out


def words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


@dataclass
class Model:
    """weights: the logit (class 1 less class 0) of each bucket; bias: of an empty text."""

    settings: Settings
    weights: np.ndarray
    bias: float


class Rows:
    """A sparse matrix by rows, with the order of its columns for the backward pass."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.shape = shape
        self.forward = self.ordered(row, col, value)
        self.backward = self.ordered(col, row, value)

    @staticmethod
    def ordered(row, col, value):
        at = np.argsort(row, kind="stable")
        row, col, value = row[at], col[at], value[at].astype(np.float32)[:, None]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
        return row[starts], starts, col.astype(np.int32), value

    @staticmethod
    def times(side, dense, n):
        rows, starts, col, value = side
        out = np.zeros((n, dense.shape[1]), np.float32)
        if len(starts):
            out[rows] = np.add.reduceat(dense[col] * value, starts, axis=0)
        return out

    def dot(self, dense):
        return self.times(self.forward, dense, self.shape[0])

    def transposed_dot(self, dense):
        return self.times(self.backward, dense, self.shape[1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and offset of a logistic regression on one feature, by damped Newton steps."""
    scale = float(np.abs(x).max()) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1).astype(np.float64)
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        h = a.T @ (a * (weight * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        beta += np.linalg.solve(h, a.T @ (weight * (y - p)) - 1e-6 * beta)
    return float(beta[0] / scale), float(beta[1])


def train(texts: list[str], labels: list[int], s: Settings = Settings()) -> Model:
    """Full-batch Adam on the cross entropy, embeddings and softmax together. One class or no text: the prior."""
    y = np.asarray(labels, dtype=np.float32)
    prior = float((y.sum() + 1) / (len(y) + 2))
    bias = math.log(prior / (1 - prior))
    if not len(y) or y.min() == y.max():
        return Model(s, np.zeros(s.buckets, np.float32), bias)
    counts = [Counter(words(t)) for t in texts]
    vocabulary: dict[str, int] = {}
    for c in counts:
        for w in c:
            vocabulary.setdefault(w, len(vocabulary))
    lists = [np.array(features(w, s), np.int32) for w in vocabulary]
    n_features = np.array([len(x) for x in lists], np.float32)
    word_of = np.repeat(np.arange(len(lists), dtype=np.int32), n_features.astype(np.int64))
    bucket = np.concatenate(lists) if lists else np.empty(0, np.int32)
    row = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    col = np.array([vocabulary[w] for c in counts for w in c], np.int64)
    value = np.array([n for c in counts for n in c.values()], np.float32)
    total = np.bincount(row, value * n_features[col], len(counts)).astype(np.float32) if len(row) else np.ones(len(counts), np.float32)
    by_word = Rows(row, col, value / np.maximum(total[row], 1), (len(counts), len(lists)))
    # Only buckets met several times (a word of a document counts once) are learnt: others can't be told from chance.
    seen = np.bincount(bucket, weights=np.bincount(col, minlength=len(lists))[word_of], minlength=s.buckets)
    live = np.flatnonzero(seen >= s.least_docs)
    place = np.full(s.buckets, -1)
    place[live] = np.arange(len(live))
    ok = place[bucket] >= 0
    by_bucket = Rows(word_of[ok], place[bucket[ok]], np.ones(int(ok.sum()), np.float32), (len(lists), len(live)))

    weight = np.where(y == 1, s.share / y.sum(), (1 - s.share) / (len(y) - y.sum())).astype(np.float32)[:, None]
    # The first axis of the embeddings starts as smoothed log odds of a bucket, the others near zero.
    share_1, share_0 = (by_bucket.transposed_dot(by_word.transposed_dot((rows / max(rows.sum(), 1))[:, None]))[:, 0] for rows in (y, 1 - y))
    typical = np.float32(1 / max(seen[live].sum(), 1)) if len(live) else np.float32(1)
    odds = np.log((share_1 + s.prior_docs * typical * s.least_docs) / (share_0 + s.prior_docs * typical * s.least_docs)).astype(np.float32)
    slope, off = logistic(by_word.dot(by_bucket.dot(odds[:, None]))[:, 0], y, weight[:, 0])
    rng = np.random.default_rng(s.seed)
    emb = rng.normal(0, 0.01, (len(live), s.dim)).astype(np.float32)
    emb[:, 0] = odds
    soft = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32)
    soft[0] = -slope / 2, slope / 2
    params = [emb, soft, np.array([-off / 2, off / 2], np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.stack([1 - y, y], axis=1)
    for step in range(1, s.epochs + 1):
        emb, soft, off = params
        hidden = by_word.dot(by_bucket.dot(emb))
        logits = hidden @ soft + off
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - target) * weight
        d_emb = by_bucket.transposed_dot(by_word.transposed_dot(d @ soft.T))
        grads = [d_emb, hidden.T @ d, d.sum(axis=0)]
        # One scale for all embeddings: steps stay in proportion to a bucket's gradient, so chance words barely move.
        for k, (param, g) in enumerate(zip(params, grads)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * (g * g if k else (g * g).max())
            change = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-12)
            param -= s.rate * change * (1 if k == 0 else np.maximum(np.abs(param), 0.1))
    emb, soft, off = params
    weights = np.zeros(s.buckets, np.float32)
    weights[live] = emb @ (soft[:, 1] - soft[:, 0])
    return Model(s, weights, float(off[1] - off[0]))


def fitted(texts: list[str], labels: list[int], threshold: float, s: Settings = Settings()) -> Model:
    """A model of most of the sample, its bias moved so that the best cut on the rest is at the threshold.

    One text in set_aside, drawn, isn't trained on. The best cut on those catches the largest share of toxic texts less
    false_alarm times the share of clean ones.
    """
    drawn = np.random.default_rng(s.seed).permutation(len(texts)).tolist()
    cut = len(texts) // s.set_aside
    tried, rest = sorted(drawn[:cut]), sorted(drawn[cut:])
    y = np.array([labels[k] for k in tried])
    if len({labels[k] for k in rest}) < 2 or len(set(y.tolist())) < 2:
        return train(texts, labels, s)
    model = train([texts[k] for k in rest], [labels[k] for k in rest], s)
    known = Logits(model, 500_000, 64)
    logits = np.array([known.logit(texts[k]) for k in tried])
    order = np.argsort(-logits, kind="stable")
    gain = np.cumsum(y[order]) / y.sum() - s.false_alarm * np.cumsum(1 - y[order]) / (len(y) - y.sum())
    # Several cuts may be nearly as good on so few texts: the middle of those is taken.
    good = np.flatnonzero(gain >= gain.max() - s.slack)
    cut = float(np.mean(logits[order[good]]))
    return Model(s, model.weights, model.bias - cut + math.log(threshold / (1 - threshold)))


class Logits(dict):
    """word -> the sum of its features' logits, and their number as the imaginary part."""

    def __init__(self, model: Model, most_words: int, longest_kept: int):
        super().__init__()
        self.settings, self.weights, self.bias = model.settings, model.weights.astype(float).tolist(), model.bias
        self.most_words, self.longest_kept = most_words, longest_kept

    def __missing__(self, word: str) -> complex:
        ids = features(word, self.settings)
        weights = self.weights
        out = complex(sum([weights[i] for i in ids]), len(ids))
        if len(word) <= self.longest_kept:
            if len(self) >= self.most_words:
                self.clear()
            self[word] = out
        return out

    def logit(self, text: str | None) -> float:
        total = sum(map(self.__getitem__, words(text)), 0j)
        return self.bias + (total.real / total.imag if total.imag else 0.0)

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.logit(text)))))


def score(docs: DataFrame, model: Model, text: str = "text", id: str = "doc_id", most_words: int = 500_000, longest_kept: int = 64) -> DataFrame:
    """id and score (0 to 1) of each row of docs; null and empty texts get the score of the bias alone. No shuffle."""
    # About 1 MB whatever the corpus: buckets is a setting.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        known = Logits(shared.value, most_words, longest_kept)
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), pa.array([known.score(x) for x in batch.column(1).to_pylist()], pa.float64())], ["id", "score"])

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(scored, f"id {kind}, score double").withColumnRenamed("id", id)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, threshold: float = 0.7, most_rows: tuple[int, int] = (3000, 1500), most_chars: int = 6_000, settings: Settings = Settings(), text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row a row of docs: id, held_out, score, predicted.

    Learns from at most most_rows[y] labelled documents a class outside the held-out fold (see training_sample); only
    texts enter a score. Without labels of both classes every score is the prior. Repeated rows get equal scores;
    null and empty texts are scored too; an empty table gives an empty table; other columns of docs aren't read.
    """
    model = fitted(*training_sample(docs, labels, "toxic", folds, held_out, most_rows, most_chars, text, id), threshold, settings)
    out = score(docs, model, text, id)
    return out.select(id, (fold(F.col(id), folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
