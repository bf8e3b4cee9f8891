"""Quality rules by tokeniser fertility.

Public vocabularies encode the whole text. For each, three measures say how well the text fits what
tokenisers are made from: characters per token, the share of tokens that are lone bytes of a character the
vocabulary can't spell (byte fallback), and the entropy of the tokens. The bands of a script and language
come from quantiles of all its documents that pass the base; a text outside them is rejected. Beside them
stand plain counts: words, symbols, repeated lines, repeated windows.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: By the ending of their columns' names.
VOCABULARIES = {"": VOCABULARY, "_multi": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
# Fixed value: how the public vocabulary's authors cut a text into pieces before merging bytes.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where a script has too few documents to learn from, by script: least and most characters per token, most
#: byte fallback, least entropy in bits (of texts of SURE tokens or more; the entropy of a short text is
#: bounded by its length).
BANDS = {"LATIN": (1.2, 9.0, 0.35, 3.0), "": (0.3, 12.0, 0.9, 2.0)}
SURE = 64
#: Fewest distinct documents that a band is learned from, and how many interquartile ranges beyond the
#: quartiles it reaches (Tukey's outer fence).
LEAST_DOCS, REACH = 50, 3.0
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FIT = ("n_tokens", "chars_per_token", "byte_share", "entropy")


@lru_cache(maxsize=4)
def encoder(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and which of its tokens are lone bytes beyond ASCII."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    lone = np.zeros(max(ranks.values()) + 1, dtype=bool)
    for token, i in ranks.items():
        try:
            token.decode()
        except UnicodeDecodeError:
            lone[i] = True
    return tiktoken.Encoding("public", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}), lone


def repeated_words(words: list[str], window: int = 5) -> int:
    """Words that stand in a window of words found twice or more, its first place included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    if n <= 50_000:  # windows of a long text would take much memory
        windows = list(zip(*(words[k:k + n] for k in range(window))))
        times = Counter(windows)
        if len(times) == n:
            return 0
        often = np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=n)
        return _covered(often, window)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    code = ids[:n]
    for k in range(1, window):  # exact: windows so far are numbered anew, then extended by a word
        code = np.unique(code * len(number) + ids[k:k + n], return_inverse=True)[1]
    return _covered(np.bincount(code)[code] > 1, window)


def _covered(often: np.ndarray, window: int) -> int:
    covered = np.zeros(len(often) + window, dtype=np.int64)
    starts = np.flatnonzero(often)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def script(text: str) -> str:
    """The script of most of the letters (by Unicode name, least name of a tie); '' without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    beyond = points >= 128
    names = {"LATIN": int((((points[~beyond] | 32) - 97) < 26).sum())}
    for c, n in zip(*np.unique(points[beyond], return_counts=True)):
        if chr(c).isalpha():
            name = unicodedata.name(chr(c), "").split(" ")[0]
            names[name] = names.get(name, 0) + int(n)
    best = max(sorted(names), key=names.get)
    return best if names[best] else ""


def fit(text: str, vocabulary: bytes) -> tuple[int, float, float, float]:
    """The measures of FIT; ratios and entropy of an empty text are 0."""
    encoding, lone = encoder(vocabulary)
    ids = np.concatenate([np.array(encoding.encode_ordinary(piece), dtype=np.int32) for piece in _pieces(text)])
    ids.sort()
    n, first = len(ids), np.flatnonzero(np.diff(ids, prepend=-1))
    tokens, counts = ids[first], np.diff(first, append=n)
    p = counts / max(1, n)
    return (n, len(text) / n if n else 0.0, float(counts[lone[tokens]].sum() / n) if n else 0.0,
            float(-(p * np.log2(p)).sum()) + 0.0 if n else 0.0)


def measure(text: str | None, *vocabularies: bytes) -> tuple:
    """The columns of ``result``. A NULL text counts as an empty one."""
    text = text or ""
    words = _WORD.findall(text)
    return (len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), duplicate_lines(text), repeated_words(words),
            *(x for v in vocabularies for x in fit(text, v)), script(text))


def _pieces(text: str, size: int = 100_000) -> Iterator[str]:
    """A very long text in parts that end before a space, so that tokens are those of the whole text."""
    at = 0
    while len(text) - at > size:
        cut = text.find(" ", at + size)
        # a space that other spaces surround is merged with them: cut at a lone one
        while 0 <= cut < len(text) - 1 and (text[cut + 1].isspace() or text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def result(endings: Iterable[str]) -> str:
    """Names and types of the measures: counts, the fit to each vocabulary, script."""
    fits = [f"{c}{e} {'long' if c == 'n_tokens' else 'double'}" for e in endings for c in FIT]
    return ", ".join([COUNTS, *fits, "script string"])


def measures(text: Column, vocabularies: dict[str, bytes]) -> Column:
    kinds = result(vocabularies)

    @F.pandas_udf(kinds)
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split(" ")[0] for c in kinds.split(", ")]
        for s in batches:
            yield pd.DataFrame([measure(t, *vocabularies.values()) for t in s], columns=names)

    return udf.asNondeterministic()(text)


def measured(docs: DataFrame, vocabularies: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with a struct ``rules`` of the columns of ``result`` and base_failed.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated windows. The vocabularies are
    read by the driver and sent along, so workers need no file.
    """
    read = {}
    for ending, path in (VOCABULARIES if vocabularies is None else vocabularies).items():
        with open(path, "rb") as f:
            read[ending] = f.read()
    m = F.col("__m")
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    names = [c.split(" ")[0] for c in result(read).split(", ")]
    return (docs.drop("rules").withColumn("__m", measures(F.col("text"), read))
            .withColumn("rules", F.struct(*(m[c].alias(c) for c in names), failed.alias("base_failed"))).drop("__m"))


def _octave(m: Column, ending: str) -> Column:
    """Texts of like length: the power of two at or under the number of tokens."""
    return F.floor(F.log2(F.greatest(m["n_tokens" + ending], F.lit(1)))).cast("int")


def learned_bands(rows: DataFrame, by: list[str], endings: list[str]) -> DataFrame:
    """``*by, band``: per group and vocabulary low, high, most, and least entropy by octave of tokens (``bits``).

    From the quartiles of all rows that pass the base (``by`` and ``rules``); rows with equal measures count
    once, so that a text copied very often is no norm. Values are rounded, which bounds what an exact
    quantile keeps, and added up before the shuffle. Groups, and octaves of a group, of under LEAST_DOCS have none.
    """
    m = F.col("rules")
    values = [F.round(m[c + e], 3).alias(c + e) for e in endings for c in FIT[1:]]
    rows = stage(rows.where(~m["base_failed"]).select(*by, *values, *(_octave(m, e).alias("octave" + e) for e in endings))
                 .distinct(), "fits")

    def fence(c: str, up: bool, slack: float) -> Column:
        q = [F.percentile(c, p) for p in (0.25, 0.75)]
        return q[up] + (REACH if up else -REACH) * F.greatest(q[1] - q[0], F.lit(slack))

    many = F.count("*") >= LEAST_DOCS
    out = rows.groupBy(*by).agg(F.struct(*(F.struct(
        fence("chars_per_token" + e, False, 0.02).alias("low"), fence("chars_per_token" + e, True, 0.02).alias("high"),
        fence("byte_share" + e, True, 0.01).alias("most")).alias("fit" + e) for e in endings)).alias("band"),
        many.alias("many")).where("many").drop("many")
    for e in endings:
        bits = (rows.groupBy(*by, "octave" + e).agg(fence("entropy" + e, False, 0.1).alias("least"), many.alias("many"))
                .where("many").groupBy(*by).agg(F.collect_list(F.struct(F.col("octave" + e).alias("octave"), "least")).alias("bits" + e)))
        out = out.join(bits, by, "left")
    ends = [F.col("band")[f"fit{e}"].alias(f"fit{e}") for e in endings] + [F.col(f"bits{e}") for e in endings]
    return stage(out.select(*by, F.struct(*ends).alias("band")), "bands")  # staged: joined by its measured size


def decide(rows: DataFrame, bands: dict[str, tuple[float, float, float, float]] | None = None, language: str = "lang") -> DataFrame:
    """``rows`` (of ``measured``, staged, as they are read more than once) with in_band and kept in ``rules``.

    A text is held against the bands of its script and language; without a column ``language``, or with too few
    documents of it, of its script; with too few of that too, against the fixed ``bands`` (BANDS; '' is for
    scripts not listed). An octave of tokens without a least entropy takes that of the shorter ones.
    """
    bands, m = BANDS if bands is None else bands, F.col("rules")
    endings = [c.removeprefix("n_tokens") for c in rows.schema["rules"].dataType.names if c.startswith("n_tokens")]
    keyed = rows.withColumn("__script", m["script"])
    found = []
    for i, by in enumerate([["__script", language], ["__script"]] if language in rows.columns else [["__script"]]):
        known = learned_bands(keyed, by, endings).withColumnRenamed("band", f"__band{i}")
        for c in by:
            known = known.withColumnRenamed(c, f"__{i}{c}")
        keyed = keyed.join(known, [keyed[c] == known[f"__{i}{c}"] for c in by], "left").drop(*(f"__{i}{c}" for c in by))
        found.append(F.col(f"__band{i}"))

    def inside(e: str, low, high, most, bits):
        return m["chars_per_token" + e].between(low, high) & (m["byte_share" + e] <= most) & bits

    def fixed(e: str, low, high, most, bits):
        return inside(e, low, high, most, (m["n_tokens" + e] < SURE) | (m["entropy" + e] >= bits))

    band, in_band = F.coalesce(*found), F.lit(True)
    for e in endings:
        known = fixed(e, *bands.get("", (0.0, float("inf"), 1.0, 0.0)))
        for name, limits in bands.items():
            if name:
                known = F.when(m["script"] == name, fixed(e, *limits)).otherwise(known)
        octave = _octave(m, e)
        shorter = F.filter(band["bits" + e], lambda b: b["octave"] <= octave)  # noqa: B023
        least = F.array_max(F.transform(shorter, lambda b: b["least"]))
        fit = band["fit" + e]
        in_band &= F.when(band.isNull(), known).otherwise(inside(
            e, fit["low"], fit["high"], fit["most"], least.isNull() | (m["entropy" + e] >= least)))
    names = rows.schema["rules"].dataType.names
    return (keyed.withColumn("__in", in_band)
            .withColumn("rules", F.struct(*(m[c].alias(c) for c in names), F.col("__in").alias("in_band"),
                                          (~m["base_failed"] & F.col("__in")).alias("kept"))).select(*rows.columns))


def judge(docs: DataFrame, vocabularies: dict[str, str] | None = None,
          bands: dict[str, tuple[float, float, float, float]] | None = None, language: str = "lang") -> DataFrame:
    """``docs`` with a struct ``rules``: the measures of ``result``, base_failed, in_band and kept.

    ``kept``: base passed, and the text inside the bands of its script and language for each vocabulary (see
    ``decide``). NULL, empty and blank texts fail the base. Every row stays; a column named ``rules`` is
    replaced, others pass through and are staged with the measures, so leave out what isn't needed.
    """
    return decide(stage(measured(docs, vocabularies), "measures"), bands, language)
