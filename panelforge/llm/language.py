"""Language identification: averaged hashed subword embeddings under a linear softmax.

A word is its letters between two marks; its subwords are the word and all runs of 2 to 4 characters,
each hashed into a bucket of embeddings. A text is the mean of its subwords' embeddings; a linear layer
gives a logit per language. Both are trained in numpy by stochastic gradient descent. Probabilities are
calibrated by a temperature, and the least probability to accept is set on texts the training hasn't
seen. As everything before the softmax is linear, a word's part of the logits is computed once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import SAMPLE_CHARS, WordCache, drawn, fold, hashed, temperature

BUCKETS, DIM = 1 << 14, 16
#: Bound of the sample that is fitted on, for each language.
SAMPLE = 300
UNKNOWN = "und"
#: Subwords of a word summed at once.
PIECE = 1 << 16
_WORD = re.compile(r"[^\W\d_]+")  # also takes numbers that aren't decimal digits, such as fractions
_LETTERS = regex.compile(r"\p{L}+")


def letter_runs(text: str) -> list[str]:
    """Runs of letters, in order."""
    found = _WORD.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [run for w in found for run in ([w] if w.isalpha() else _LETTERS.findall(w))]


class Buckets(dict):
    """Buckets of subwords met, up to a bound; most subwords come back very often."""

    def __missing__(self, gram: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[gram] = bucket = hashed(gram, len(gram)) % BUCKETS
        return bucket


def subwords(word: str, buckets: Buckets) -> list[int]:
    """Buckets of a lower-cased word: the whole of it, and its runs of 2, 3 and 4 characters."""
    w = f"<{word}>"
    n = len(w)
    grams = [w[i:i + 2] for i in range(n - 1)] + [w[i:i + 3] for i in range(n - 2)] + [w[i:i + 4] for i in range(n - 3)]
    return [hashed(w, n) % BUCKETS, *map(buckets.__getitem__, grams)]


@dataclass
class LanguageModel:
    languages: list[str]
    embed: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    t: float
    least: float      # accepted from this probability on

    def bucket_logits(self) -> np.ndarray:
        """What a subword of each bucket adds to the logits."""
        return self.embed @ self.weight

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.t
        e = np.exp(z - z.max())
        return e / e.sum()


class Reader:
    """Logits of whole texts; keeps the parts of words met, up to a bound."""

    def __init__(self, model: LanguageModel, limit: int = 250_000):
        self.model, self.limit = model, limit
        self.buckets, self.logits_of = Buckets(), model.bucket_logits()
        self.reset()

    def reset(self) -> None:
        self.parts = np.zeros((1024, len(self.model.languages) + 1))
        self.cache = WordCache(self.learn, self.limit)

    def learn(self, word: str) -> None:
        n = len(self.cache) - 1
        if n >= len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)])
        ids = subwords(word, self.buckets)
        for at in range(0, len(ids), PIECE):  # a run of letters without spaces may be very long
            self.parts[n, :-1] += self.logits_of.take(ids[at:at + PIECE], axis=0).sum(axis=0)
        self.parts[n, -1] = len(ids)

    def logits(self, text: str | None) -> np.ndarray | None:
        """None for a text without letters."""
        words = letter_runs((text or "").lower())
        if not words:
            return None
        total = np.zeros(self.parts.shape[1])
        for at in range(0, len(words), 20_000):
            if self.cache.full():
                self.reset()
            found, n = np.unique(self.cache.numbers(words[at:at + 20_000]), return_counts=True)
            total += n @ self.parts[found]
        return total[:-1] / total[-1] + self.model.bias


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, known, buckets = [], {}, Buckets()
    for t in texts:
        ids: list[int] = []
        for w in letter_runs(t.lower()):
            if w not in known:
                known[w] = subwords(w, buckets)
            ids += known[w]
        found, n = np.unique(np.array(ids, dtype=np.int64), return_counts=True)
        out.append((found, n / max(1, n.sum())))
    return out


def fit(sample: list[tuple[str, str]], epochs: int = 4, rate: float = 2.0, seed: int = 11) -> LanguageModel:
    """Trained on (text, language) pairs: each text as a whole and one short piece of it."""
    rng = np.random.default_rng(seed)
    sample = [(t, l) for t, l in sample if letter_runs(t)]
    languages = sorted({l for _, l in sample})
    number = {l: i for i, l in enumerate(languages)}
    texts, y = [], []
    for t, l in sample:
        words = t.split()
        at = int(rng.integers(0, max(1, len(words) - 12)))
        for piece in (t, " ".join(words[at:at + int(rng.integers(3, 13))])):
            if letter_runs(piece):
                texts.append(piece), y.append(number[l])
    model = LanguageModel(languages, rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32),
                          rng.normal(0, 0.1, (DIM, max(1, len(languages)))), np.zeros(max(1, len(languages))), 1.0, 0.0)
    if not languages:
        return model
    y_ = np.array(y)
    bags, order = _bags(texts), rng.permutation(len(texts))
    held, train = order[: len(texts) // 6], order[len(texts) // 6:]
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        for i in rng.permutation(train):
            ids, share = bags[i]
            h = share @ model.embed[ids]
            z = h @ model.weight + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y_[i]] -= 1.0
            back = model.weight @ p
            model.weight -= 0.1 * lr * np.outer(h, p)
            model.bias -= 0.02 * lr * p
            model.embed[ids] -= (lr * share[:, None] * back[None, :]).astype(np.float32)
    logits = np.stack([bags[i][1] @ model.embed[bags[i][0]] @ model.weight + model.bias for i in held]) \
        if len(held) else np.zeros((0, len(languages)))
    model.t = temperature(logits, y_[held])
    if len(held):
        z = logits / model.t
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best, right = p.max(axis=1), p.argmax(axis=1) == y_[held]
        for least in np.linspace(0, 0.99, 100):  # the least that leaves 99 % right
            model.least = float(least)
            if not (best >= least).any() or right[best >= least].mean() >= 0.99:
                break
    return model


def train(docs: DataFrame, n_folds: int = 3, held_fold: int = 1, sample: int = SAMPLE) -> LanguageModel:
    """Fitted on at most ``sample`` documents of each language, outside the held-out fold, drawn by hash."""
    rows = (docs.select("doc_id", "text", "lang")
            .where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                    & (F.length("text") <= SAMPLE_CHARS) & (fold(F.col("doc_id"), n_folds) != held_fold)))
    return fit([(r.text, r.lang) for r in drawn(rows, sample, "lang")])


def predictions(text: Column, model: LanguageModel) -> Column:
    """Struct of language, score and accepted for each whole text."""
    @F.pandas_udf("language string, score double, accepted boolean")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for s in batches:
            rows = []
            for t in s:
                z = reader.logits(t) if model.languages else None
                if z is None:
                    rows.append((UNKNOWN, 0.0, False))
                else:
                    p = model.probabilities(z)
                    rows.append((model.languages[int(p.argmax())], float(p.max()), bool(p.max() >= model.least)))
            yield pd.DataFrame(rows, columns=["language", "score", "accepted"])

    return udf.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with a struct ``language``: language, score (0 to 1), accepted.

    ``language`` is the likeliest one even where it is rejected; ``und`` with score 0 for a text that is
    NULL or has no letter, or if nothing could be learned. Every row stays, repeated ones too; a column
    named ``language`` is replaced, others pass through.
    """
    return docs.drop("language").withColumn("language", predictions(F.col("text"), model))
