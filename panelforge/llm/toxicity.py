"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer turns words into classes with weights: insults (stems learned from labelled
documents), and fixed words for threats, targets, negation and reported speech. Five small transducers
read the classes of a clause; composed, they are one automaton whose state says whether a negation, a
speech verb, a target or a threat came before. What it emits is not that a word is there but how its
clause uses it: a bare insult, one at a target, one that is negated, one that is reported, a threat to a
target. A document's score is a logistic model of those emissions, with weights fitted to labels and
held near priors that make negated and reported matches count for less.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import WordCache, labelled_sample, sigmoid

OTHER, BREAK, NEGATION, SPEECH, TARGET, THREAT, INSULT = range(7)

# Closed-class words of the grammar in English, German, French and Spanish.
WORDS = {
    NEGATION: "not no never without nobody isn't aren't wasn't don't doesn't nicht kein keine keinen nie niemand "
              "pas ne jamais aucun aucune sans nunca jamás ningún ninguna sin tampoco",
    SPEECH: "said says say saying called calls wrote writes quoted quote quotes claimed claims reported reports "
            "sagte sagt schrieb nannte behauptete zitiert zitierte dit disait écrit appelait déclaré cité "
            "dijo dice decía escribió llamó declaró citó",
    TARGET: "you your you're yours they them their he him she her people everyone du dich dir dein deine ihr euch "
            "sie ihnen tu te toi ton ta tes vous votre ils elles eux ustedes tú usted ti tus ellos ellas",
    THREAT: "kill hurt destroy beat stab shoot burn hang punch smash töten umbringen schlagen erschießen verbrennen "
            "tuer frapper brûler détruire abattre matar golpear quemar destruir disparar",
}
CLOSED = {w: c for c, words in WORDS.items() for w in words.split()}
#: What a clause can emit, and the prior weight of each.
EMISSIONS = ("insult", "insult at target", "negated insult", "reported insult", "threat at target")
PRIOR = np.array([1.0, 1.4, 0.1, 0.4, 1.0])
#: Bound of the sample that is fitted on: documents of label 0 and of label 1.
PER_CLASS = (5000, 1500)
THRESHOLD = 0.3
_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
_STEMS = (4, 5, 6, 7, 8)


# --- transducers: state, class -> state (and, for the last, an emission)

def _flag(raised_by: int):
    """Two states: whether a word of the class came before in the clause."""
    return {(s, c): 0 if c == BREAK else 1 if c == raised_by else s for s in (0, 1) for c in range(7)}


def compose() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission (-1: none) of the composed automaton by state and class.

    A state is the four flags negation, speech, target, threat as bits. An insult is emitted by the
    flags in force; a target after a threat, or a threat after a target, emits a threat unless negated.
    """
    flags = [_flag(c) for c in (NEGATION, SPEECH, TARGET, THREAT)]
    step, emit = np.zeros((16, 7), dtype=np.int64), np.full((16, 7), -1, dtype=np.int64)
    for bits in product((0, 1), repeat=4):
        state = sum(b << i for i, b in enumerate(bits))
        negated, reported, aimed, menaced = bits
        for c in range(7):
            step[state, c] = sum(t[b, c] << i for i, (t, b) in enumerate(zip(flags, bits)))
            if c == INSULT:
                emit[state, c] = 2 if negated else 3 if reported else 1 if aimed else 0
            elif (c == TARGET and menaced or c == THREAT and aimed) and not negated:
                emit[state, c] = 3 if reported else 4
    return step, emit


STEP, EMIT = compose()


@dataclass
class ToxicityModel:
    stems: dict[str, float] = field(default_factory=dict)   # "stem" or "word$" -> weight
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = -3.0

    def lexical(self, word: str) -> tuple[int, float]:
        """Class and weight of a token."""
        if len(word) == 1 and word in ".!?;:\n":
            return BREAK, 0.0
        best = max((self.stems.get(k, 0.0) for k in units(word)), default=0.0)
        if best > 0:
            return INSULT, best
        return CLOSED.get(word, OTHER), 1.0


def units(word: str) -> list[str]:
    """What can stand for a word in the lexicon: its beginnings, and the whole of it."""
    return [*(word[:n] for n in _STEMS if len(word) > n), word + "$"] if len(word) > 3 else []


class Reader:
    """Emissions of whole texts; keeps the classes of words met, up to a bound."""

    def __init__(self, model: ToxicityModel, limit: int = 150_000):
        self.model, self.limit = model, limit
        self.reset()

    def reset(self) -> None:
        self.kind, self.weight = np.zeros(1024, dtype=np.int64), np.zeros(1024)
        self.cache = WordCache(self.learn, self.limit)

    def learn(self, word: str) -> None:
        n = len(self.cache) - 1
        if n >= len(self.kind):
            self.kind, self.weight = np.concatenate([self.kind, self.kind]), np.concatenate([self.weight, self.weight])
        self.kind[n], self.weight[n] = self.model.lexical(word)

    def read(self, text: str | None) -> np.ndarray:
        """Summed weight of each emission, as log(1 + sum)."""
        out = np.zeros(len(EMISSIONS))
        words = _TOKEN.findall((text or "").lower())
        state = 0
        for at in range(0, len(words), 20_000):
            if self.cache.full():
                self.reset()
            ids = self.cache.numbers(words[at:at + 20_000])
            kinds, weights = self.kind[ids], self.weight[ids]
            seen = np.flatnonzero(kinds)
            loud = (kinds == INSULT) | (kinds == THREAT)
            if not loud.any() and not state & 8:  # only states can change: those of the last clause begun here
                ends = np.flatnonzero(kinds == BREAK)
                if len(ends):
                    state, seen = 0, seen[seen > ends[-1]]
            for c, w in zip(kinds[seen].tolist(), weights[seen].tolist()):
                e = EMIT[state, c]
                if e >= 0:
                    out[e] += w
                state = STEP[state, c]
        return np.log1p(out)


def learn_stems(sample: list[tuple[str, int]]) -> dict[str, float]:
    """Beginnings and words that mark toxic documents, with log-odds weights (1 to 5).

    A unit counts if so many of its documents being toxic is beyond chance over all units tried
    (Bonferroni at 0.05). Of nested units the shortest is kept, but for one that stands for hardly more
    than a longer one does.
    """
    toxic, clean = Counter(), Counter()
    n1, n0 = sum(y for _, y in sample), sum(1 - y for _, y in sample)
    if not n1 or not n0:
        return {}
    for text, y in sample:
        seen = {u for w in set(_TOKEN.findall(text.lower())) for u in units(w)}
        (toxic if y else clean).update(seen)
    tried = sum(1 for u, a in toxic.items() if a + clean[u] >= 3)
    need = math.log(20 * max(1, tried)) / math.log((n1 + n0) / n1)
    found = {}
    for u, a in toxic.items():
        b = clean[u]
        if a >= max(3.0, need) and b * n1 <= 0.02 * a * n0:
            found[u] = min(5.0, max(1.0, math.log((a + 0.5) * (n0 + 1) / ((b + 0.5) * (n1 + 1))) / 2))
    lexicon: dict[str, float] = {}
    for u in sorted(found, key=lambda u: (len(u), u)):
        inner = u.rstrip("$")
        if any(inner[:n] in lexicon for n in _STEMS if n < len(inner) or n == len(inner) and u != inner):
            continue
        longer = [v for v in found if v != u and v.startswith(u)] if u == inner else []
        if not any(toxic[v] >= 0.95 * toxic[u] for v in longer):
            lexicon[u] = found[u]
    return lexicon


def fit(sample: list[tuple[str, int]], pull: float = 0.002) -> ToxicityModel:
    """Stems, then the weights of the emissions by logistic regression near PRIOR."""
    model = ToxicityModel(learn_stems(sample))
    if not sample:
        return model
    reader = Reader(model)
    x, y = np.stack([reader.read(t) for t, _ in sample]), np.array([l for _, l in sample], dtype=float)
    w, b = PRIOR.copy(), -3.0
    for _ in range(1500):
        g = sigmoid(x @ w + b) - y
        w -= 0.5 * (x.T @ g / len(y) + pull * (w - PRIOR))
        b -= 0.5 * float(g.mean())
        w = np.maximum(w, 0.0)
    model.weights, model.bias = w, b
    return model


def train(docs: DataFrame, labels: DataFrame, n_folds: int = 4, held_fold: int = 2,
          per_class: tuple[int, int] = PER_CLASS) -> ToxicityModel:
    """Fitted on at most ``per_class`` documents of either label outside the held-out fold."""
    return fit(labelled_sample(docs, labels, "toxic", n_folds, held_fold, per_class))


def scores(text: Column, model: ToxicityModel) -> Column:
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model)
        for s in batches:
            x = np.stack([reader.read(t) for t in s]) if len(s) else np.zeros((0, len(EMISSIONS)))
            yield pd.Series(sigmoid(x @ model.weights + model.bias).astype(float))

    return udf.asNondeterministic()(text)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct ``toxicity``: score and predicted (1 from ``threshold`` on).

    Every row stays, repeated ones too; NULL, empty and wordless texts get the score of no match. A
    column named ``toxicity`` is replaced, others pass through.
    """
    scored = docs.drop("toxicity").withColumn("__s", scores(F.col("text"), model))
    return scored.withColumn("toxicity", F.struct(
        F.col("__s").alias("score"), (F.col("__s") >= threshold).cast("int").alias("predicted"))).drop("__s")
