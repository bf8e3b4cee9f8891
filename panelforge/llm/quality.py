"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Each unit (a word, and beside it the shape of what was written) has a sparse random index vector made
from its hash. A word's vector is the sum of the index vectors met around it in the sample, which is
random indexing; a document is the mean of its words' vectors and the mean of its shapes' vectors. The
network on top is trained in numpy; its probabilities are calibrated by one temperature on a part of
the sample that the training doesn't see.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import WordCache, hashed, labelled_sample, sigmoid, temperature

DIM, NONZERO, REACH = 64, 6, 2
HIDDEN = 24
#: A text of so many words counts half as much as its own, half as the mean document.
FEW = 6.0
#: Bound of the sample that is fitted on: documents of label 0 and of label 1.
PER_CLASS = (1000, 1000)
THRESHOLD = 0.3
_RUN = re.compile(r"(.)\1+")
_PATTERN = re.compile(r"(.{2,8}?)\1+")


def index_vector(unit: str, dim: int = DIM) -> np.ndarray:
    """NONZERO entries of +1 or -1 at places that only the unit decides."""
    v = np.zeros(dim, dtype=np.float32)
    for i in range(NONZERO):
        h = hashed(unit, i + 1)
        v[(h >> 1) % dim] += 1.0 if h & 1 else -1.0
    return v


def shape(word: str) -> str:
    """Kinds of characters in order, runs as one: ``Word!!`` is ``Aa!``; of long ones repeated patterns too."""
    if word.isalpha():
        if word.islower():
            return "a"
        if word[1:].islower():
            return "Aa"
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    kinds = _RUN.sub(r"\1", kinds)
    return kinds if len(kinds) <= 12 else _PATTERN.sub(r"\1", kinds)


def stem(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()[]*#$%&|-")


AGAIN, FRESH = "<again>", "<fresh>"  # whether a word repeats the one before it


@dataclass
class QualityModel:
    vectors: dict[str, np.ndarray]   # of the words seen often enough; others have none
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    t: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        """Pooled vectors, drawn to the mean document the more the fewer words they come from."""
        n = x[:, -1:]
        return (x[:, :-1] - self.centre) * (n / (n + FEW)) / self.scale

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(0.0, self.inputs(x) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.t)


class Pooler:
    """Documents to pooled vectors; keeps the vectors of words met, up to a bound."""

    def __init__(self, vectors: dict[str, np.ndarray], limit: int = 60_000):
        self.vectors, self.limit = vectors, limit
        self.again, self.fresh = index_vector(AGAIN), index_vector(FRESH)
        self.shapes: dict[str, np.ndarray] = {}
        self.reset()

    def reset(self) -> None:
        self.rows = np.zeros((1024, 2 * DIM), dtype=np.float32)
        self.cache = WordCache(self.learn, self.limit)

    def learn(self, word: str) -> None:
        n = len(self.cache) - 1
        if n >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        v = self.vectors.get(stem(word))
        if v is not None:
            self.rows[n, :DIM] = v
        kind = shape(word)
        v = self.shapes.get(kind)
        if v is None:
            if len(self.shapes) > self.limit:
                self.shapes.clear()
            v = self.shapes[kind] = index_vector(kind)
        self.rows[n, DIM:] = v

    def pool(self, text: str | None) -> np.ndarray:
        """Mean vector of words, mean vector of shapes, number of words."""
        words = (text or "").split()
        if not words:
            return np.zeros(2 * DIM + 1, dtype=np.float32)
        total, before, again = np.zeros(2 * DIM), "", 0
        for at in range(0, len(words), 20_000):  # long texts part by part, none left out
            if self.cache.full():
                self.reset()
            part = words[at:at + 20_000]
            ids = self.cache.numbers(part)
            found, n = np.unique(ids, return_counts=True)
            total += n.astype(np.float32) @ self.rows[found]
            again += int((ids[1:] == ids[:-1]).sum()) + (part[0] == before)
            before = part[-1]
        total[DIM:] += again * self.again + (len(words) - again) * self.fresh
        return np.append(total / len(words), len(words)).astype(np.float32)


def word_vectors(texts: list[str], least: int = 3) -> dict[str, np.ndarray]:
    """Random-indexing vectors of unit length of the words in at least ``least`` texts."""
    split = [[stem(w) for w in t.split()] for t in texts]
    seen = Counter(w for words in split for w in set(words))
    known = {w: i for i, (w, n) in enumerate(sorted(seen.items())) if n >= least}
    if not known:
        return {}
    number = {w: i for i, w in enumerate(sorted(known))}
    index = np.stack([index_vector(w) for w in sorted(known)])
    out = np.zeros_like(index)
    for words in split:
        ids = np.array([number.get(w, -1) for w in words], dtype=np.int64)
        for d in range(1, REACH + 1):
            a, b = ids[:-d], ids[d:]
            ok = (a >= 0) & (b >= 0)
            np.add.at(out, a[ok], index[b[ok]])
            np.add.at(out, b[ok], index[a[ok]])
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out /= np.where(norm > 0, norm, 1.0)
    return {w: out[i] for w, i in number.items()}


def fit(sample: list[tuple[str, int]], epochs: int = 40, seed: int = 5) -> QualityModel:
    """Trained on (text, label) pairs; with fewer than two labels every score is the share of ones."""
    y = np.array([l for _, l in sample], dtype=np.float32)
    vectors = word_vectors([t for t, _ in sample])
    pooler = Pooler(vectors)
    x = np.stack([pooler.pool(t) for t, _ in sample]) if sample else np.zeros((0, 2 * DIM + 1), dtype=np.float32)
    rng = np.random.default_rng(seed)
    centre = x[:, :-1].mean(axis=0) if len(x) else np.zeros(2 * DIM, dtype=np.float32)
    scale = x[:, :-1].std(axis=0) + 1e-3 if len(x) else np.ones(2 * DIM, dtype=np.float32)
    model = QualityModel(vectors, centre, scale, rng.normal(0, 0.15, (2 * DIM, HIDDEN)), np.zeros(HIDDEN),
                         rng.normal(0, 0.2, HIDDEN), 0.0, 1.0)
    if len(set(y.tolist())) < 2:
        model.w2[:] = 0
        model.b2 = 6.0 if len(y) and y[0] == 1 else -6.0 if len(y) else 0.0
        return model
    order = rng.permutation(len(y))
    held, train = order[: len(y) // 6], order[len(y) // 6:]
    z = model.inputs(x)
    params = [model.w1, model.b1, model.w2]
    m, v, step = [np.zeros_like(p) for p in params] + [0.0], [np.zeros_like(p) for p in params] + [0.0], 0
    for _ in range(epochs):
        train = rng.permutation(train)
        for at in range(0, len(train), 64):
            rows = train[at:at + 64]
            a = z[rows] @ model.w1 + model.b1
            h = np.maximum(0.0, a)
            g = (sigmoid(h @ model.w2 + model.b2) - y[rows]) / len(rows)
            gh = np.outer(g, model.w2) * (a > 0)
            grads = [z[rows].T @ gh + 1e-3 * model.w1, gh.sum(axis=0), h.T @ g + 1e-3 * model.w2, g.sum()]
            step += 1
            for i, grad in enumerate(grads):  # Adam
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                move = 0.003 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
                if i < 3:
                    params[i] -= move
                else:
                    model.b2 -= float(move)
    logit = model.logits(x[held])
    model.t = temperature(np.stack([np.zeros_like(logit), logit], axis=1), y[held].astype(int))
    return model


def scores(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 of each whole text; NULL and blank texts get that of no words at all."""
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pooler = Pooler(model.vectors)
        for s in batches:
            x = np.stack([pooler.pool(t) for t in s]) if len(s) else np.zeros((0, 2 * DIM + 1))
            yield pd.Series(model.probability(x).astype(float))

    return udf.asNondeterministic()(text)  # computed once, not again for each filter on it


def train(docs: DataFrame, labels: DataFrame, n_folds: int = 5, held_fold: int = 0,
          per_class: tuple[int, int] = PER_CLASS) -> QualityModel:
    """Fitted on at most ``per_class`` documents of either label outside the held-out fold."""
    return fit(labelled_sample(docs, labels, "quality", n_folds, held_fold, per_class))


def classify(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct ``quality``: score and predicted (1 from ``threshold`` on).

    Every row stays, repeated ones too; NULL, empty and blank texts get one defined score. A column
    named ``quality`` is replaced, others pass through.
    """
    scored = docs.drop("quality").withColumn("__s", scores(F.col("text"), model))
    return scored.withColumn("quality", F.struct(
        F.col("__s").alias("score"), (F.col("__s") >= threshold).cast("int").alias("predicted"))).drop("__s")
