"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of some fifty words. A passage is encoded by a small layer from what numpy takes over
a whole batch at once: the mean embedding of its words, hashed into buckets and learnt with all else, and counts of
kinds of characters, lengths of words and repetition. Gated attention, softmax of v . (tanh(V h) * sigmoid(U h)),
weights the passages; the weighted sum of the encodings is scored. Word embeddings, encoder, attention and score are
trained together from document labels by gradient descent in numpy.

Long texts are scored piece by piece: a text's state is the largest attention logit so far, the sum of the weights and
the weighted sum of the encodings, so its length is bounded by nothing but its own bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from corpuloom.llm.labelled import fold, training_sample
from corpuloom.llm.shared import inner_names, slices

UPPER, LOWER, DIGIT, STOP, MARK, SYMBOL, HIGH, BLANK = range(8)
KIND = np.full(256, SYMBOL, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = BLANK
KIND[ord("A") : ord("Z") + 1] = UPPER
KIND[ord("a") : ord("z") + 1] = LOWER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[[ord(c) for c in ".,;:'\"()-"]] = STOP
KIND[[ord(c) for c in "!?"]] = MARK
KIND[128:] = HIGH
MIX = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
N_FEATURES = 13
BUCKET_BITS = 12


@dataclass(frozen=True)
class Settings:
    passage_words: int = 50
    hidden: int = 16
    attention: int = 8
    epochs: int = 80
    rate: float = 0.02
    decay: float = 1e-4
    attend: bool = True  # False: every passage of a document weighs the same, to tell what attention is worth
    share: float = 0.3
    seed: int = 5


def segments(texts: list[bytes], most: int) -> tuple[list[bytes], np.ndarray]:
    """Texts in pieces of at most about `most` bytes, cut at white space (anywhere if there is none), and their rows."""
    pieces, rows = [], []
    for row, text in enumerate(texts):
        low = 0
        while len(text) - low > most:
            at = max(text.rfind(c, low + most // 2, low + most) for c in (b" ", b"\n", b"\t"))
            at = at if at > 0 else low + most
            pieces.append(text[low:at])
            rows.append(row)
            low = at
        pieces.append(text[low:] if low else text)
        rows.append(row)
    return pieces, np.array(rows, np.int64)


@dataclass
class Passages:
    """x: counts of each passage; piece: which piece it is of; word_bucket, first: hashed words and where a passage's begin."""

    x: np.ndarray
    piece: np.ndarray
    word_bucket: np.ndarray
    first: np.ndarray


def passages(pieces: list[bytes], size: int) -> Passages:
    """All passages of all pieces. A piece without words has none."""
    data = np.frombuffer(b"\n".join(pieces) + b"\n", np.uint8)
    begins = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    kind = KIND[data]
    solid = kind != BLANK
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return Passages(np.empty((0, N_FEATURES), np.float32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
    piece = np.searchsorted(begins, starts, side="right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(starts, begins[:-1])[piece]
    opens = np.flatnonzero(nth % size == 0)
    passage = np.zeros(len(starts), np.int64)
    passage[opens[1:]] = 1
    passage = np.cumsum(passage)
    n = len(opens)
    words = np.bincount(passage, minlength=n).astype(np.float32)

    edges = starts[opens]
    counts = np.stack([np.add.reduceat(kind == k, edges, dtype=np.int32) for k in range(8)], axis=1).astype(np.float32)
    ends = np.flatnonzero(solid & ~np.r_[solid[1:], False]) + 1
    length = (ends - starts).astype(np.float32)

    at = np.arange(len(data), dtype=np.int64)
    at -= np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    coded = (data.astype(np.uint64) + np.uint64(1)) * MIX[at & 63] * solid
    word = np.add.reduceat(coded, starts)
    word ^= word >> np.uint64(29)
    same = np.zeros(len(starts), bool)
    same[1:] = (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])
    keyed = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (word & np.uint64((1 << 40) - 1)))
    new = np.r_[True, keyed[1:] != keyed[:-1]]
    distinct = np.bincount((keyed[new] >> np.uint64(40)).astype(np.int64), minlength=n).astype(np.float32)

    solid_bytes = np.maximum(counts.sum(axis=1) - counts[:, BLANK], 1)
    lengths = np.bincount(passage, length, n).astype(np.float32)
    spread = np.sqrt(np.maximum(np.bincount(passage, length * length, n) / words - (lengths / words) ** 2, 0)).astype(np.float32)
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER] + counts[:, HIGH], 1)
    singles = np.bincount(passage, length <= 1, n).astype(np.float32)
    out = np.stack(
        [
            counts[:, UPPER] / letters,
            counts[:, LOWER] / solid_bytes,
            counts[:, DIGIT] / solid_bytes,
            counts[:, STOP] / solid_bytes,
            counts[:, MARK] / solid_bytes,
            counts[:, SYMBOL] / solid_bytes,
            counts[:, HIGH] / solid_bytes,
            np.bincount(passage, same, n) / words,
            distinct / words,
            np.log1p(lengths / words),
            np.log1p(spread),
            singles / words,
            np.log(words),
        ],
        axis=1,
    ).astype(np.float32)
    return Passages(out, piece[opens], (word >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), opens)


@dataclass
class Model:
    settings: Settings
    centre: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray] = field(default_factory=dict)
    prior: float = 0.0  # the logit of a document without passages

    def encoded(self, found: Passages) -> dict[str, np.ndarray]:
        """The encoding h of each passage and its attention logit e, with what the gradients need."""
        p = self.params
        x = np.clip((found.x - self.centre) / self.scale, -6, 6)
        n = np.diff(np.r_[found.first, len(found.word_bucket)]).astype(np.float32)[:, None]
        lexical = np.add.reduceat(p["E"][found.word_bucket], found.first, axis=0) / n
        h = np.tanh(x @ p["W"] + lexical + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["v"] if self.settings.attend else np.zeros(len(h), np.float32)
        return {"x": x, "n": n, "h": h, "t": t, "g": g, "e": e}

    def forward(self, found: Passages, starts: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """The same with the weights a, bags z and logits of documents whose passages begin at starts."""
        f = self.encoded(found)
        w = np.exp(f["e"] - np.repeat(np.maximum.reduceat(f["e"], starts), sizes))
        f["a"] = w / np.repeat(np.add.reduceat(w, starts), sizes)
        f["z"] = np.add.reduceat(f["h"] * f["a"][:, None], starts, axis=0)
        f["logit"] = f["z"] @ self.params["c"] + self.params["d"]
        return f

    def scores(self, texts: list[bytes], piece_bytes: int = 1 << 19) -> np.ndarray:
        """The scores of whole texts, piece by piece of about piece_bytes bytes."""
        logit = np.full(len(texts), self.prior)
        if self.params:
            top, total, bags = np.full(len(texts), -np.inf), np.zeros(len(texts)), np.zeros((len(texts), self.settings.hidden))
            pieces, rows = segments(texts, piece_bytes)
            low = 0
            while low < len(pieces):
                high, size = low, 0
                while high < len(pieces) and (high == low or size + len(pieces[high]) <= piece_bytes):
                    size += len(pieces[high])
                    high += 1
                found = passages(pieces[low:high], self.settings.passage_words)
                if len(found.piece):
                    f = self.encoded(found)
                    starts = np.flatnonzero(np.r_[True, found.piece[1:] != found.piece[:-1]])
                    sizes = np.diff(np.r_[starts, len(found.piece)])
                    most = np.maximum.reduceat(f["e"], starts).astype(np.float64)
                    w = np.exp(f["e"] - np.repeat(most, sizes))
                    sums, parts = np.add.reduceat(w, starts), np.add.reduceat(f["h"] * w[:, None], starts, axis=0)
                    for row, m, s, z in zip(rows[low + found.piece[starts]], most, sums, parts):
                        new = max(top[row], m)
                        before, now = np.exp(top[row] - new), np.exp(m - new)
                        top[row], total[row], bags[row] = new, total[row] * before + s * now, bags[row] * before + z * now
                low = high
            ok = total > 0
            logit[ok] = (bags[ok] / total[ok, None]) @ self.params["c"] + self.params["d"]
        return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def gradients(model: Model, found: Passages, starts: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The weighted cross entropy of the documents and its gradient by each parameter."""
    p, f = model.params, model.forward(found, starts, sizes)
    prob = 1 / (1 + np.exp(-f["logit"]))
    loss = float((weight * np.logaddexp(0, np.where(y == 1, -f["logit"], f["logit"]))).sum())
    d_logit = (prob - y) * weight
    d_z = np.repeat(d_logit[:, None] * p["c"], sizes, axis=0)
    d_a = (d_z * f["h"]).sum(axis=1)
    d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, starts), sizes))
    if not model.settings.attend:
        d_e = np.zeros_like(d_e)
    d_tg = d_e[:, None] * p["v"]
    d_t, d_g = d_tg * f["g"] * (1 - f["t"] ** 2), d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_pre = (d_z * f["a"][:, None] + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - f["h"] ** 2)
    return loss, {"W": f["x"].T @ d_pre, "E": by_bucket(found, d_pre / f["n"], len(p["E"])), "b": d_pre.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g, "v": (f["t"] * f["g"]).T @ d_e, "c": f["z"].T @ d_logit, "d": d_logit.sum()}


def by_bucket(found: Passages, rows: np.ndarray, buckets: int) -> np.ndarray:
    """Sums over the words of a bucket of the rows of their passages."""
    order = found.__dict__.get("order")
    if order is None:
        at = np.argsort(found.word_bucket, kind="stable")
        passage = np.repeat(np.arange(len(found.first)), np.diff(np.r_[found.first, len(found.word_bucket)]))[at]
        bucket = found.word_bucket[at]
        begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        order = found.__dict__["order"] = passage, bucket[begin], begin
    passage, bucket, begin = order
    out = np.zeros((buckets, rows.shape[1]), rows.dtype)
    out[bucket] = np.add.reduceat(rows[passage], begin, axis=0)
    return out


def joined(parts: list[Passages]) -> Passages:
    words = np.cumsum([0, *(len(p.word_bucket) for p in parts)])
    return Passages(np.concatenate([p.x for p in parts]), np.concatenate([p.piece for p in parts]), np.concatenate([p.word_bucket for p in parts]), np.concatenate([p.first + w for p, w in zip(parts, words)]))


def train(texts: list[str], labels: list[int], s: Settings = Settings()) -> Model:
    """Full-batch Adam on the cross entropy of the documents. One class or no passage at all: the prior."""
    y = np.asarray(labels, np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(s, np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32), prior=float(np.log(share / (1 - share))))
    # A few texts at a time: describing passages takes many times the memory of their bytes, what comes out little.
    parts = []
    for k in range(0, len(texts), 64):
        found = passages([t.encode("utf-8", "replace") for t in texts[k : k + 64]], s.passage_words)
        parts.append(Passages(found.x, found.piece + k, found.word_bucket.astype(np.int16), found.first))
    if not sum(len(p.piece) for p in parts):
        return model
    found = joined(parts)
    starts = np.flatnonzero(np.r_[True, found.piece[1:] != found.piece[:-1]])
    sizes = np.diff(np.r_[starts, len(found.piece)])
    y = y[found.piece[starts]]
    if y.min() == y.max():
        return model
    model.centre, model.scale = found.x.mean(axis=0), found.x.std(axis=0) + 1e-3
    rng = np.random.default_rng(s.seed)
    draw = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
    p = model.params = {"W": draw(N_FEATURES, s.hidden), "E": np.zeros((1 << BUCKET_BITS, s.hidden), np.float32), "b": np.zeros(s.hidden, np.float32), "V": draw(s.hidden, s.attention), "U": draw(s.hidden, s.attention), "v": draw(s.attention), "c": draw(s.hidden), "d": np.zeros((), np.float32)}
    weight = np.where(y == 1, (1 - s.share) / y.sum(), s.share / (len(y) - y.sum())).astype(np.float32)
    m, q = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, s.epochs + 1):
        _, grads = gradients(model, found, starts, sizes, y, weight)
        for k, g in grads.items():
            g = g + s.decay * p[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            # One scale for all embeddings, so that a word met by chance barely moves.
            q[k] = 0.999 * q[k] + 0.001 * (g * g if k != "E" else (g * g).max())
            p[k] = (p[k] - s.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", piece_bytes: int = 1 << 19) -> DataFrame:
    """docs with a column score (0 to 1). Texts are taken whole, in pieces of about piece_bytes bytes. No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a quarter of a megabyte
    at = docs.columns.index(text)

    def scored(batches):
        model = shared.value
        for batch in slices(batches):
            texts = [x or b"" for x in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(model.scores(texts, piece_bytes))], [*batch.schema.names, "score"])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most_rows: tuple[int, int] = (750, 750), most_chars: int = 6_000, settings: Settings = Settings(), text: str = "text", id: str = "doc_id") -> Model:
    """A model of at most most_rows[y] labelled documents a class outside the held-out fold (see training_sample)."""
    return train(*training_sample(docs, labels, "quality", folds, held_out, most_rows, most_chars, text, id), settings)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, text: str = "text", id: str = "doc_id", **how) -> DataFrame:
    """One row a row of docs: id, held_out, score, predicted.

    Only texts enter a score. Texts without a word (null, empty, white space) get the prior. Without labels of both
    classes every score is the prior. Repeated rows get equal scores; an empty table gives an empty table; other
    columns of docs aren't read.
    """
    model = fitted(docs, labels, folds, held_out, text=text, id=id, **how)
    out = score(docs.select(F.col(id).alias(id), F.col(text).alias("__text")), model, "__text")
    return out.select(id, (fold(F.col(id), folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text", id: str = "doc_id", **how) -> DataFrame:
    """The rows of docs with a score of at least threshold, all columns of docs; scored where they are, without a join."""
    model = fitted(docs, labels, text=text, id=id, **how)
    out = score(inner_names(docs), model, f"c{docs.columns.index(text)}").where(F.col("score") >= threshold).drop("score")
    return out.toDF(*docs.columns)
