"""Passages that stand word for word in several places, wherever their lines begin and end.

The words of a document are one stream, folded as paragraphs are. Of the runs of RUN words, those with the
least hash among WINDOW neighbours are selected (winnowing): the content alone decides, so both copies of a
passage of RUN + WINDOW - 1 words or more select the same runs of it, in lines of any length, broken anywhere.
Selected runs that occur again are joined to passages; as they lie at most WINDOW words apart, they overlap,
and every word of a passage is verified. Up to WINDOW - 1 words at either end of it may not be reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.words import Words, by_words
from panelforge.session import stage

RUN, WINDOW = 26, 13
_BASE = np.uint64(0x9E3779B97F4A7C15)


def rolled(hashes: np.ndarray, run: int) -> np.ndarray:
    """A value of each run of words, polynomial in their hashes; by doubling, not word by word."""
    power = lambda n: np.uint64(pow(int(_BASE), n, 1 << 64))
    n, block, size, value, done = len(hashes) - run + 1, hashes, 1, None, 0
    while size <= run:  # block: of each run of size words; value: of each run of done words, the end of the wanted run
        if run & size:
            value = block if value is None else block[:len(value) - size] * power(done) + value[size:]
            done += size
        if 2 * size <= run:
            block = block[:-size] * power(size) + block[size:]
        size *= 2
    return value[:n]


def sliding(f: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """``f`` (least or greatest) of each ``window`` neighbours."""
    size = 1
    while 2 * size <= window:
        values, size = f(values[:-size], values[size:]), 2 * size
    rest = window - size
    return f(values[:-rest], values[rest:]) if rest else values


def selected(hashes: np.ndarray, run: int = RUN, window: int = WINDOW, sizes: np.ndarray | None = None) -> np.ndarray:
    """Places of the selected runs, given a 64-bit hash of each word; of several texts, with ``sizes`` words each."""
    n = len(hashes) - run + 1
    if n < 1:
        return np.empty(0, dtype=np.int64)
    value = rolled(hashes, run).copy()
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    sizes = np.array([len(hashes)]) if sizes is None else sizes
    most, whole = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)  # whole: runs and windows that lie in one text
    least = sliding(np.minimum, value, window) if n >= window else np.empty(0, dtype=np.uint64)
    inside = np.zeros(len(least), dtype=bool)
    ends = np.cumsum(sizes).tolist()
    for start, end in zip([0, *ends], ends):
        few = end - start - run + 1
        whole[start:start + max(few, 0)] = True
        if few >= window:
            inside[start:start + few - window + 1] = True
        elif few > 0:  # a text of less than a window is one
            most[start:start + few] = value[start:start + few].min()
    if len(least):
        most = np.maximum(most, sliding(np.maximum, np.pad(np.where(inside, least, np.uint64(0)), window - 1), window))
    taken = (value == most) & whole
    first = np.zeros(n, dtype=bool)
    first[[start for start in [0, *ends] if start < n]] = True
    taken[1:] &= (value[1:] != value[:-1]) | first[1:]  # of one word said on and on, the first run
    return np.flatnonzero(taken)


def runs_in(words: Words, run: int = RUN, window: int = WINDOW) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest, text, place, first and last line of each selected run; places count words of the text from 0 on."""
    begin = words.first_word[words.first_line]
    at = selected(words.hashes, run, window, np.diff(np.append(begin, len(words.words))))
    digests = [xxhash.xxh3_128_digest(words.joined[i:j])
               for i, j in zip(words.begins[at].tolist(), words.ends[at + run - 1].tolist())]
    last_of = np.cumsum(words.counts)
    text, line = words.place(np.searchsorted(last_of, at, side="right"))
    _, last = words.place(np.searchsorted(last_of, at + run - 1, side="right"))
    return digests, text, at - begin[text], line, last


def runs_of(text: str, run: int = RUN, window: int = WINDOW) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Digest, place, first and last line of each selected run of one text."""
    digests, _, at, line, last = runs_in(Words([text.encode("utf-8", "surrogatepass")]), run, window)
    return digests, at, line, last


#: Columns of the selected runs; key and rest are halves of the digest.
COLUMNS = {"key": "long", "rest": "long", "at": "int", "line": "int", "last": "int"}


def run_columns(ids: pa.Array, words: Words, run: int = RUN, window: int = WINDOW) -> dict[str, pa.Array]:
    """``doc_id`` and COLUMNS of the selected runs of some texts."""
    digests, text, *numbers = runs_in(words, run, window)
    digest = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    return {"doc_id": ids.take(pa.array(text)), "key": pa.array(digest[:, 0]), "rest": pa.array(digest[:, 1]),
            **{c: pa.array(x.astype(np.int32)) for c, x in zip(("at", "line", "last"), numbers)}}


def runs(docs: DataFrame, run: int = RUN, window: int = WINDOW) -> DataFrame:
    """``doc_id, key, rest, at, line, last`` of the selected runs of all texts."""
    return by_words(docs, COLUMNS, lambda ids, words: [run_columns(ids, words, run, window)])


def passages(docs: DataFrame, lines: DataFrame | None = None, run: int = RUN, window: int = WINDOW,
             found: DataFrame | None = None) -> DataFrame:
    """``doc_id, para_no, first_doc_id, first_para_no, kept, first_word, n_words``: every repeated passage.

    ``first_word`` counts the words of the text from 0 on; ``para_no`` is the line it stands in, and the passage
    may go on over lines after it. ``first_*`` names the place its first words stand first (least doc_id,
    then place), which is kept. Runs that begin or end in a line that ``lines`` (of ``paragraphs.repeats``)
    doesn't keep are left to it. Rows with the same doc_id count once where they are equal. ``found``: the
    staged ``runs`` of ``docs``, where they are known already.
    """
    found = stage(runs(docs, run, window), "runs") if found is None else found
    # by half of the digest, which lets a few more through than occur again: the whole of it decides below;
    # written before it is joined, so that a run of very many places can be split
    often = stage(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "often")
    left = found.join(often.hint("merge"), "key").select("key", "rest", "doc_id", "at", "line", "last").distinct()
    if lines is not None:
        gone = stage(lines.where("not kept").select(F.col("doc_id"), F.col("para_no").alias("__gone")).distinct(), "gone")
        for c in ("line", "last"):
            g = gone.select(F.col("doc_id").alias("__doc"), "__gone").hint("merge")
            left = left.join(g, (F.col("doc_id") == F.col("__doc")) & (F.col(c) == F.col("__gone")), "left_anti")
    left = stage(left, "repeated")
    first = stage(left.groupBy("key", "rest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at", "line")).alias("first"))
                  .where("n > 1").select("key", "rest", "first"), "first-runs")
    placed = left.join(first.hint("merge"), ["key", "rest"]).select(
        "doc_id", "at", "line", "first", ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("at") == F.col("first.at"))).alias("kept"))
    order = Window.partitionBy("doc_id").orderBy("at", "line")
    new = ((F.col("at") > F.lag("at").over(order) + run) | (F.col("kept") != F.lag("kept").over(order))
           | (F.col("first.doc_id") != F.lag("first.doc_id").over(order)))
    placed = placed.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    return (placed.withColumn("passage", F.sum("new").over(order)).groupBy("doc_id", "passage").agg(
        F.min(F.struct("at", "line", "first", "kept")).alias("p"), (F.max("at") - F.min("at") + run).alias("n_words"))
        .select("doc_id", F.col("p.line").alias("para_no"), F.col("p.first.doc_id").alias("first_doc_id"),
                F.col("p.first.line").alias("first_para_no"), F.col("p.kept").alias("kept"),
                F.col("p.at").alias("first_word"), "n_words"))
