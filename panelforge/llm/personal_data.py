"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find e-mail and IP addresses, payment cards and phone numbers by fixed rules. The network
is trained in numpy on spans labelled in a bounded sample (the rules', keys and passwords after their
names, and variants of them with other digits) and finds what the rules have no pattern for: credentials,
and numbers and addresses written otherwise. It reads overlapping windows of characters; the tag of a
character is taken from the window in which it stands farthest from a border, so spans are reconciled
over the whole text, whatever windows they cross.

Every labelled kind holds a digit or an at sign, so windows are laid over the surroundings of all of
those, of the whole text; text far from any has no span to find.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import SAMPLE_CHARS, drawn, fold

KINDS = ("email", "ip", "card", "phone", "secret")  # the rules know all but the last
WIDTH, STRIDE, AROUND = 64, 32, 24
HIDDEN = 16
#: Bound of the sample that is fitted on: documents, and windows cut from them.
SAMPLE, WINDOWS = 1500, 1600
#: A span of the network alone has at least so many characters and this mean probability.
LEAST, SURE = 7, 0.9

Span = tuple[str, int, int]


# --- the rules

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starting only where a run of digits starts finds the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SECRET = re.compile(r"\bAKIA[0-9A-Z]{16}\b|(?<=[=:\"'\s])[0-9a-f]{24,}(?=[\"'\s]|$)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The rules' spans by kind, then start; leftmost and non-overlapping within a kind."""
    out: list[Span] = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group())) if m.end() - m.start() <= 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


# --- the network

N_CHARS = 101


def classes(text: str) -> np.ndarray:
    """Printable ASCII by itself, line breaks, other letters, the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    out = np.where((points >= 32) & (points < 127), points - 31, np.where(points == 10, 96, np.where(points >= 192, 97, 98)))
    return out


@dataclass
class Tagger:
    """Parameters: per direction an input table and a recurrent matrix, the output layer, CRF transitions."""
    params: dict[str, np.ndarray]

    def emissions(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Scores (time, batch, tag) of windows x (time, batch); with ``keep``, what the gradient needs."""
        p, hidden, kept = self.params, [], []
        for side in ("f", "b"):
            steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
            h = c = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
            hs, memory = np.zeros((*x.shape, HIDDEN), dtype=np.float32), {}
            for t in steps:
                z = p["x" + side][x[t]] + h @ p["u" + side]
                gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * HIDDEN], -30, 30)))
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
                g = np.tanh(z[:, 3 * HIDDEN:])
                before = (h, c)
                c = f * c + i * g
                tc = np.tanh(c)
                h = o * tc
                hs[t] = h
                if keep:
                    memory[t] = (before, i, f, o, g, tc)
            hidden.append(hs)
            kept.append((list(steps), memory))
        both = np.concatenate(hidden, axis=2)
        return both @ p["w"] + p["c"], [both, kept]

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags and their marginal probabilities, both (time, batch)."""
        e, _ = self.emissions(x)
        trans = self.params["t"]
        best, back = e[0], []
        for t in range(1, len(e)):
            total = best[:, :, None] + trans[None]
            back.append(total.argmax(axis=1))
            best = total.max(axis=1) + e[t]
        tags = np.zeros(x.shape, dtype=np.int64)
        tags[-1] = best.argmax(axis=1)
        for t in range(len(e) - 2, -1, -1):
            tags[t] = back[t][np.arange(x.shape[1]), tags[t + 1]]
        a, b, z = forward_backward(e, trans)
        m = np.exp(a + b - z[None, :, None])
        return tags, np.take_along_axis(m, tags[:, :, None], axis=2)[:, :, 0]


def _lse(v: np.ndarray, axis: int) -> np.ndarray:
    top = v.max(axis=axis, keepdims=True)
    return (np.log(np.exp(v - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def forward_backward(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[0] = e[0]
    for t in range(1, len(e)):
        a[t] = _lse(a[t - 1][:, :, None] + trans[None], 1) + e[t]
    for t in range(len(e) - 2, -1, -1):
        b[t] = _lse(trans[None] + (e[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, _lse(a[-1], 1)


def gradients(model: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of tags y, and its gradient by every parameter."""
    p, (steps, batch) = model.params, x.shape
    e, (both, kept) = model.emissions(x, keep=True)
    trans = p["t"]
    a, b, z = forward_backward(e, trans)
    rows = np.arange(batch)
    gold = sum(e[t, rows, y[t]] for t in range(steps)) + sum(trans[y[t], y[t + 1]] for t in range(steps - 1))
    de = np.exp(a + b - z[None, :, None])
    dt = np.zeros_like(trans)
    for t in range(steps - 1):
        dt += np.exp(a[t][:, :, None] + trans[None] + (e[t + 1] + b[t + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.add.at(dt, (y[t], y[t + 1]), -1.0)
    np.subtract.at(de, (np.arange(steps)[:, None], rows[None, :], y), 1.0)
    de /= batch
    grad = {"t": dt / batch, "w": np.tensordot(both, de, axes=((0, 1), (0, 1))), "c": de.sum(axis=(0, 1))}
    dboth = de @ p["w"].T
    for n, side in enumerate(("f", "b")):
        order, memory = kept[n]
        dx, du = np.zeros_like(p["x" + side]), np.zeros_like(p["u" + side])
        dh_next = dc_next = np.zeros((batch, HIDDEN), dtype=np.float32)
        for t in reversed(order):
            (h0, c0), i, f, o, g, tc = memory[t]
            dh = dboth[t, :, n * HIDDEN:(n + 1) * HIDDEN] + dh_next
            dc = dh * o * (1 - tc * tc) + dc_next
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(dx, x[t], dz)
            du += h0.T @ dz
            dh_next, dc_next = dz @ p["u" + side].T, dc * f
        grad["x" + side], grad["u" + side] = dx, du
    return float((z - gold).mean()), grad


def new_tagger(seed: int = 3) -> Tagger:
    rng, k = np.random.default_rng(seed), len(KINDS) + 1
    r = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
    params = {"w": r(2 * HIDDEN, k), "c": np.zeros(k, dtype=np.float32), "t": np.eye(k, dtype=np.float32)}
    for side in ("f", "b"):
        params["x" + side], params["u" + side] = r(N_CHARS, 4 * HIDDEN), r(HIDDEN, 4 * HIDDEN)
        params["x" + side][:, HIDDEN:2 * HIDDEN] += 1.0  # keep memory at first
    return Tagger(params)


def labelled_spans(text: str) -> list[Span]:
    return base_spans(text) + [("secret", m.start(), m.end()) for m in _SECRET.finditer(text)]


def training_windows(texts: list[str], most: int = WINDOWS, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Windows (time, n) and tags around labelled spans, around other digits, and of plain text.

    Each span comes as it is and once with its digits drawn anew, so that no number is learned by heart.
    """
    rng = np.random.default_rng(seed)
    xs, ys = [], []

    def cut(chars: str, tags: np.ndarray, centre: int) -> None:
        at = int(np.clip(centre - int(rng.integers(8, WIDTH - 8)), 0, max(0, len(chars) - WIDTH)))
        c, t = classes(chars[at:at + WIDTH]), tags[at:at + WIDTH]
        pad = WIDTH - len(c)
        xs.append(np.pad(c, (0, pad))), ys.append(np.pad(t, (0, pad)))

    for text in texts:
        if len(xs) >= most:
            break
        tags = np.zeros(len(text), dtype=np.int64)
        spans = labelled_spans(text)
        for kind, s, e in spans:
            tags[s:e] = KINDS.index(kind) + 1
        for kind, s, e in spans[:4]:
            cut(text, tags, (s + e) // 2)
            drawn = "".join(str(rng.integers(0, 10)) if c in "123456789" else c for c in text[s:e])
            cut(text[:s] + drawn + text[e:], tags, (s + e) // 2)
        others = [m.start() for m in _DIGIT.finditer(text) if not tags[m.start()]]
        for i in others[:2]:
            cut(text, tags, i)
        if not spans and text:
            cut(text, tags, int(rng.integers(0, len(text))))
    if not xs:
        return np.zeros((WIDTH, 0), dtype=np.int64), np.zeros((WIDTH, 0), dtype=np.int64)
    return np.stack(xs[:most], axis=1), np.stack(ys[:most], axis=1)


def fit(texts: list[str], epochs: int = 6, batch: int = 64, seed: int = 3) -> Tagger:
    """Trained by Adam on windows of the texts; untrained (and used for nothing) if they hold no span."""
    model = new_tagger(seed)
    x, y = training_windows(texts)
    if not (y > 0).any():
        return model
    rng, step = np.random.default_rng(seed), 0
    m = {k: np.zeros_like(v) for k, v in model.params.items()}
    v = {k: np.zeros_like(w) for k, w in model.params.items()}
    for epoch in range(epochs):
        order = rng.permutation(x.shape[1])
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            _, grad = gradients(model, x[:, some], y[:, some])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            step += 1
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                rate = 0.03 * (1 - 0.8 * epoch / epochs)
                model.params[k] = (model.params[k] - rate * (m[k] / (1 - 0.9 ** step))
                                   / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return model


def train(docs: DataFrame, n_folds: int = 3, held_fold: int = 1, sample: int = SAMPLE) -> Tagger:
    """Fitted on at most ``sample`` documents with a digit or an at sign, drawn by a hash of doc_id."""
    rows = docs.select("doc_id", "text").where(
        F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") <= SAMPLE_CHARS)
        & F.col("text").rlike("[0-9@]") & (fold(F.col("doc_id"), n_folds) != held_fold))
    return fit([r.text for r in drawn(rows, sample)])


def plausible(kind: str, piece: str) -> bool:
    """What a span of the network alone must have besides its probability."""
    digits = "".join(_DIGIT.findall(piece))
    if kind == "email":
        return "@" in piece
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return len(digits) >= (8 if kind == "phone" else 4)


# --- reading whole texts

_SEED = re.compile(r"[0-9@]")


def window_starts(text: str) -> list[int]:
    """Starts of windows every STRIDE that cover AROUND characters on both sides of each seed."""
    out: list[int] = []
    done = -1  # the grid cell reached
    for m in _SEED.finditer(text):
        low, high = max(0, m.start() - AROUND) // STRIDE, (m.start() + AROUND) // STRIDE
        for cell in range(max(low - 1, done + 1, 0), high + 1):
            if cell * STRIDE < len(text):
                out.append(cell * STRIDE)
        done = max(done, high)
    return out


class Finder:
    """Spans of whole texts, some texts' windows at a time."""

    def __init__(self, model: Tagger, batch: int = 1024):
        self.model, self.batch = model, batch

    def tags(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text: places read, their tags and probabilities, by the window they are most inside of."""
        starts = [window_starts(t) for t in texts]
        held: list[tuple[int, int, np.ndarray]] = []
        done: dict[int, list] = {i: [] for i in range(len(texts))}

        def flush():
            if held:
                x = np.zeros((WIDTH, len(held)), dtype=np.int64)
                for j, (_, _, c) in enumerate(held):
                    x[:len(c), j] = c
                tag, prob = self.model.decode(x)
                for j, (i, at, c) in enumerate(held):
                    done[i].append((at, tag[:len(c), j], prob[:len(c), j]))
                held.clear()

        for i, text in enumerate(texts):
            for at in starts[i]:
                held.append((i, at, classes(text[at:at + WIDTH])))
                if len(held) >= self.batch:
                    flush()
        flush()
        depth = np.minimum(np.arange(WIDTH), np.arange(WIDTH)[::-1])
        for i, text in enumerate(texts):
            if not done[i]:
                yield (np.zeros(0, dtype=np.int64),) * 3
                continue
            place = np.concatenate([np.arange(at, at + len(t)) for at, t, _ in done[i]])
            tag, prob = (np.concatenate([d[k] for d in done[i]]) for k in (1, 2))
            # at the text's own ends a border is none
            deep = np.concatenate([np.where((np.arange(at, at + len(t)) < depth[:len(t)] + 1) | (at + WIDTH >= len(text)),
                                            WIDTH, depth[:len(t)]) for at, t, _ in done[i]])
            order = np.lexsort((-deep, place))
            first = np.concatenate([[True], np.diff(place[order]) > 0])
            keep = order[first]
            yield place[keep], tag[keep], prob[keep]

    def added(self, text: str, base: list[Span], place: np.ndarray, tag: np.ndarray, prob: np.ndarray) -> list[Span]:
        """Spans of the network: runs of a tag, trimmed to what isn't space, off the rules' spans."""
        if not len(place):
            return []
        cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(tag) != 0)) + 1
        taken = [(s, e) for _, s, e in base]
        out = []
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(place)]):
            if not tag[lo]:
                continue
            s, e = int(place[lo]), int(place[hi - 1]) + 1
            while s < e and not text[s].isalnum() and text[s] != "+":
                s += 1
            while s < e and not text[e - 1].isalnum():
                e -= 1
            while s < e and s > 0 and text[s].isalnum() and text[s - 1].isalnum():
                s -= 1  # never a part of a word or number
            while s < e < len(text) and text[e - 1].isalnum() and text[e].isalnum():
                e += 1
            kind = KINDS[tag[lo] - 1]
            if (e - s >= LEAST and plausible(kind, text[s:e]) and prob[lo:hi].mean() >= SURE
                    and not any(s < b and a < e for a, b in taken)):
                out.append((kind, s, e))
                taken.append((s, e))
        return out

    def find(self, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
        """(the rules' spans, all spans), each by kind and start."""
        for text, (place, tag, prob) in zip(texts, self.tags(texts)):
            base = base_spans(text)
            more = self.added(text, base, place, tag, prob)
            yield base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


def spans(text: Column, model: Tagger) -> Column:
    """Struct of base and all: arrays of (kind, start, end) in code points, end exclusive."""
    kind = "array<struct<kind:string,start:long,end:long>>"

    @F.pandas_udf(f"base {kind}, all {kind}")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        finder = Finder(model)
        for s in batches:
            texts = [t or "" for t in s]
            base, every = [], []
            for at in range(0, len(texts), 256):
                for b, a in finder.find(texts[at:at + 256]):
                    base.append([dict(zip(("kind", "start", "end"), x)) for x in b])
                    every.append([dict(zip(("kind", "start", "end"), x)) for x in a])
            yield pd.DataFrame({"base": base, "all": every})

    return udf.asNondeterministic()(text)


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with a struct ``personal``: base (the rules' spans) and all (with the network's).

    NULL and empty texts have none. Spans of different kinds may overlap. Every row stays, repeated ones
    too; a column named ``personal`` is replaced, others pass through.
    """
    return docs.drop("personal").withColumn("personal", spans(F.col("text"), model))


def redact(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets, and ``n_chars`` set anew.

    Of overlapping spans one mark with the kind of the first stands for all of their characters. NULL
    texts stay NULL. Other columns and texts without spans are unchanged.
    """
    @F.pandas_udf("string")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(model)
        for s in batches:
            texts, out = list(s), []
            for at in range(0, len(texts), 256):
                some = texts[at:at + 256]
                for t, (_, every) in zip(some, finder.find([t or "" for t in some])):
                    out.append(t if t is None else masked(t, every))
            yield pd.Series(out, dtype=object)

    out = docs.withColumn("text", udf.asNondeterministic()(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def masked(text: str, found: list[Span]) -> str:
    out, end = [], 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], x[2])):
        if s >= end:
            out += [text[end:s], f"[{kind.upper()}]"]
        end = max(end, e)
    return "".join(out) + text[end:]


def digest(personal: Column) -> list[Column]:
    """The columns of the query from the struct that ``find`` adds."""
    def joined(a):
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(personal["base"], lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [*map(count, KINDS[:4]), F.sha2(joined(personal["base"]), 256).alias("base_sha256"), joined(personal["all"]).alias("spans")]
