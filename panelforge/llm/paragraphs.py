"""Substring deduplication by paragraph MinHash banding.

A paragraph is a line. Equal paragraphs (after folding case and white space) are one class.
Each class is sketched by the minima of its word shingles under a few hash functions, and classes that agree on a
band of minima collide. The query sketches all lines; with a least number of words, shorter lines are compared by equality only. Colliding paragraphs are joined to the leader of their band and compared by exact
Jaccard similarity of their shingles; those that it doesn't match are compared with each other where
their differences from it allow a match, so a band costs about as many rows as it has members, not
as many as it has pairs. Classes that match are clustered by connected components; the first paragraph
of a cluster stays, the others go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import ascii_lower
from panelforge.llm.components import components
from panelforge.llm.words import Words, by_words
from panelforge.session import stage

SHINGLE, SIMILARITY = 5, 0.8
#: Lines of fewer words are compared by their digest alone.
LEAST_WORDS = 20
#: Lines without a whole shingle are no paragraphs; ``passages`` reads them as part of the text around them.
SHORT_WORDS = SHINGLE
HASHES = 30
#: Shingles hashed at once.
BLOCK = 1024


def bands_for(similarity: float, hashes: int = HASHES, recall: float = 0.999) -> tuple[int, int]:
    """(bands, rows): the most rows per band at which pairs of this similarity still collide so often."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = hashes // rows
        if 1 - (1 - similarity ** rows) ** bands >= recall:
            best = (bands, rows)
    return best


def digests(text: str, size: int = SHINGLE) -> list[int]:
    """A hash of each word shingle; of the whole of a shorter text."""
    data, digest = text.encode("utf-8", "surrogatepass"), xxhash.xxh64_intdigest
    gaps = (np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32)).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(data)]
    if len(starts) <= size:
        return [digest(data)]
    return [digest(data[i:j]) for i, j in zip(starts, ends[size - 1:])]


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles; the whole of a shorter text."""
    return np.unique(np.array(digests(text, size), dtype=np.uint64))


def hash_functions(n: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of n hash functions of 64 bits."""
    rng = np.random.default_rng(2024)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def minima(hashes: np.ndarray, sizes: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A row for each line, given the hashes of all lines' shingles and how many each has: their minimum under each function."""
    mult, add = (f[:, None] for f in functions)
    ends = np.cumsum(sizes)
    begins, low = ends - sizes, np.empty((len(mult), len(sizes)), dtype=np.uint64)

    def mixed(start: int, end: int) -> np.ndarray:  # a row per function, so that minima run along memory
        m = hashes[start:end] * mult
        m += add
        m ^= m >> np.uint64(31)
        m *= np.uint64(0x9E3779B97F4A7C15)
        return m

    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + BLOCK, side="right")))
        start, end = int(begins[i]), int(ends[j - 1])
        if end - start <= BLOCK:
            low[:, i:j] = np.minimum.reduceat(mixed(start, end), begins[i:j] - start, axis=1)
        else:  # so that a very long line needs no large matrix
            low[:, i] = np.iinfo(np.uint64).max
            for k in range(start, end, BLOCK):
                low[:, i] = np.minimum(low[:, i], mixed(k, min(k + BLOCK, end)).min(axis=1))
        i = j
    return low.T


def keys_of(low: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A signed 64-bit key of each band of each row of ``minima``; bands with equal minima at different places differ."""
    data, width, digest = low.tobytes(), 8 * rows, xxhash.xxh64_intdigest
    keys = [digest(data[k + i * width:k + (i + 1) * width], seed=i)
            for k in range(0, len(data), bands * width) for i in range(bands)]
    return np.array(keys, dtype=np.uint64).view(np.int64).reshape(-1, bands)


def band_keys(text: str, bands: int, rows: int, functions: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """The key of each band of one line."""
    # repeated shingles change no minimum
    hashes = np.array(digests(text), dtype=np.uint64)
    low = minima(hashes, np.array([len(hashes)]), tuple(f[:bands * rows] for f in functions))
    return keys_of(low, bands, rows)[0].tolist()


def line_digests(words: Words, line: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The ``digests`` of these lines one after another, and how many each has."""
    n = words.counts[line]
    many = np.maximum(n - size, 0) + 1
    begin = np.repeat(words.first_word[line], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    end = np.minimum(begin + size, np.repeat(words.first_word[line] + n, many))
    of_words, digest, joined = np.append(words.begins, len(words.joined)), xxhash.xxh64_intdigest, words.joined
    ends = np.where(end > begin, words.ends[end - 1] if len(words.ends) else 0, of_words[begin])  # a blank line is ''
    return np.array([digest(joined[i:j]) for i, j in zip(of_words[begin].tolist(), ends.tolist())], dtype=np.uint64), many


#: Columns of the places of lines; cls is the MD5 of the folded line, bands is NULL for lines that are not sketched.
COLUMNS = {"para_no": "int", "cls": "binary", "bands": "array<long>"}


def place_columns(ids: pa.Array, words: Words, least_words: int, sketched: int, bands: int, rows: int) -> dict[str, pa.Array]:
    """``doc_id`` and COLUMNS of the lines of some texts: of ``least_words`` or more, with bands of ``sketched`` or more."""
    n = np.maximum(words.counts, 1)
    wanted = n >= least_words
    if least_words < 2:  # white space is a word where one is enough
        wanted &= (words.counts > 0) | (words.raw_lengths >= 2 * least_words - 1)
    line = np.flatnonzero(wanted)
    some = np.flatnonzero(words.counts[line] > 0)
    begin, end = np.zeros(len(line), dtype=np.int64), np.zeros(len(line), dtype=np.int64)
    begin[some] = words.begins[words.first_word[line[some]]]
    end[some] = words.ends[words.first_word[line[some]] + words.counts[line[some]] - 1]
    cls = [hashlib.md5(words.joined[i:j], usedforsecurity=False).digest() for i, j in zip(begin.tolist(), end.tolist())]
    long = np.flatnonzero(n[line] >= sketched)
    keys = keys_of(minima(*line_digests(words, line[long]), tuple(f[:bands * rows] for f in hash_functions())), bands, rows)
    has = np.zeros(len(line), dtype=np.int64)
    has[long] = bands
    offsets = pa.array(np.concatenate([[0], np.cumsum(has)]).astype(np.int32), mask=np.append(has == 0, False))
    text, para_no = words.place(line)
    return {"doc_id": ids.take(pa.array(text)), "para_no": pa.array(para_no.astype(np.int32)), "cls": pa.array(cls, pa.binary()),
            "bands": pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))}


def folded(line: Column) -> Column:
    """A-Z lower-cased, runs of white space one space, none at the ends."""
    # in a line of ASCII only, lower() is A-Z and far cheaper; a single space is left as it is, not replaced by one
    lower = F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(ascii_lower(line))
    return F.trim(F.regexp_replace(lower, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " "))


def paragraphs(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, para_no, para, cls``: folded lines of at least ``least_words`` words, from 0 on."""
    # folded within the array: a column made after the explode would be worked out again for each use
    lines = docs.where("text is not null and doc_id is not null").select(
        "doc_id", F.posexplode(F.transform(F.split("text", "\n"), lambda line: F.when(
            F.length(line) >= 2 * least_words - 1, folded(line)))).alias("para_no", "para"))
    return (lines.where(words(F.col("para")) >= least_words)
            .withColumn("cls", F.unhex(F.md5("para"))))


def words(para: Column) -> Column:
    return F.length(para) - F.length(F.replace(para, F.lit(" "), F.lit(""))) + 1


def places(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, para_no, cls, bands``: the lines that ``repeats`` compares, with the band keys of those it compares by similarity."""
    bands, rows = bands_for(similarity)
    least = min(SHORT_WORDS, least_words)
    return by_words(docs, COLUMNS, lambda ids, words: [place_columns(ids, words, least, least_words, bands, rows)])


def alike(n: Column, other: Column, apart: Column, similarity: float) -> Column:
    """Whether sets of ``n`` and ``other`` elements that differ in ``apart`` elements have this Jaccard similarity."""
    return (n + other - apart) / (n + other + apart) >= similarity


def differences(para: Column, leader: Column, size: int = SHINGLE) -> Column:
    """Per row, how many shingles both paragraphs have (n, lead_n) and the hashes that only one of them has."""
    @F.pandas_udf("n int, lead_n int, diff array<long>")
    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        last, of_last = None, None
        for texts, leaders in batches:
            out = []
            for x, y in zip(texts, leaders):
                if y != last:  # rows of a leader come one after another
                    last, of_last = y, shingle_hashes(y, size)
                p = shingle_hashes(x, size)
                out.append((len(p), len(of_last), np.setxor1d(p, of_last, assume_unique=True).view(np.int64)))
            yield pd.DataFrame(out, columns=["n", "lead_n", "diff"])

    return udf.asNondeterministic()(para, leader)


def matches(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that connect all classes at least ``similarity`` alike among ``members`` (key, cls, n) of shared bands.

    A band's leader is the member that collides with most others. Every member is compared with the leaders
    of its bands (at most one row per band), which gives its exact similarity and its difference from the leader.
    Two members of a leader are judged by these differences: they are alike only if their differences
    are, so members that were each edited elsewhere never meet, however many there are (see ``unsettled``).
    No pair of a band is left out but those that the bounds exclude or that are both edges to their leader.
    """
    score = stage(members.groupBy("cls").agg(F.sum("n").alias("score")), "scores")
    lead = stage(members.join(score.hint("merge"), "cls").groupBy("key")
                 .agg(F.max(F.struct("score", "cls")).alias("top")).select("key", F.col("top.cls").alias("leader")), "leaders")
    asked = members.join(lead.hint("merge"), "key").where("cls != leader").select("leader", "cls").distinct()
    judged = (asked.join(texts.select("cls", "para").hint("merge"), "cls")
              .join(texts.select(F.col("cls").alias("leader"), F.col("para").alias("first")).hint("merge"), "leader")
              .select("leader", "cls", differences(F.col("para"), F.col("first")).alias("d")).select("leader", "cls", "d.*"))
    judged = stage(judged.withColumn("same", alike(F.col("n"), F.col("lead_n"), F.size("diff"), similarity)), "judged")
    edges = judged.where("same").select(F.col("leader").alias("a"), F.col("cls").alias("b"))
    return edges.unionByName(stage(unsettled(judged, similarity), "unsettled"))


def unsettled(judged: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) of members of one leader, not both alike to it, that are alike to each other.

    ``judged`` holds leader, cls, n (shingles), diff (shingles that only cls or only the leader has) and
    same. For sets A and B and their differences X and Y from a leader, A and B differ where X and Y
    do, and A and B are alike if they differ in at most t(|A| + |B|) shingles, t = (1 - s) / (1 + s). If
    |X| + |Y| is no more than that, both are alike to the leader. Otherwise X and Y share
    (|X| + |Y| - t(|A| + |B|)) / 2 elements or more, so with elements in order of rarity they share one among
    the first of each: (1 - s) / s * |A| + 1 of the larger, half as many of the smaller. Only members with
    such a shared element are joined; the verdict on them is exact.
    """
    t, most = (1 - similarity) / (1 + similarity), (1 - similarity) / similarity + 1e-9
    mixed = (judged.groupBy("leader").agg(F.count("*").alias("members"), F.count_if(~F.col("same")).alias("apart"))
             .where("members > 1 and apart > 0").select("leader"))
    rest = judged.join(stage(mixed, "mixed").hint("merge"), "leader")
    tokens = stage(rest.select("leader", "cls", "n", "same", F.size("diff").alias("d"), F.explode("diff").alias("token")), "tokens")
    often = stage(tokens.groupBy("leader", "token").agg(F.count("*").alias("df")), "often")
    order = Window.partitionBy("leader", "cls").orderBy("df", "token")
    ranked = (tokens.join(often.hint("merge"), ["leader", "token"]).withColumn("place", F.row_number().over(order))
              .where((F.col("place") <= F.floor(F.col("n") * most) + 1) & (F.col("df") > 1)))
    ranked = stage(ranked.select("leader", "token", "cls", "n", "same", "d", "place"), "ranked")
    x, y = ranked.alias("x"), ranked.where(F.col("place") <= F.floor(F.col("n") * most / 2) + 1).alias("y")
    apart = t * (F.col("x.n") + F.col("y.n")) + 1e-9
    left = F.least(F.col("x.d") - F.col("x.place"), F.col("y.d") - F.col("y.place")) + 1
    pairs = (x.join(y.hint("merge"), ["leader", "token"])
             .where(~(F.col("x.same") & F.col("y.same")))
             .where((F.col("x.d") > F.col("y.d")) | (F.col("x.d") == F.col("y.d")) & (F.col("x.cls") > F.col("y.cls")))
             .where((F.col("x.d") - F.col("y.d") <= apart) & (2 * left >= F.col("x.d") + F.col("y.d") - apart))
             .select("leader", F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    side = {c: judged.select("leader", F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("diff").alias(f"diff_{c}"))
            .hint("merge") for c in "ab"}
    both = F.size(F.array_intersect("diff_a", "diff_b"))
    return (stage(pairs, "pairs").join(side["a"], ["leader", "a"]).join(side["b"], ["leader", "b"])
            .where(alike(F.col("n_a"), F.col("n_b"), F.size("diff_a") + F.size("diff_b") - 2 * both, similarity))
            .select("a", "b").distinct())


def texts_of(docs: DataFrame, at: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``cls, para`` of the lines that ``at`` (cls, doc_id, para_no; one place for each cls) names.

    Only lines found by their place are folded. Rows with the same doc_id have several lines there; that of the cls counts.
    """
    lines = docs.where("text is not null and doc_id is not null").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("para_no", "line")).where(F.length("line") >= 2 * least_words - 1)
    # what grows with the corpus is merged, never broadcast, at any size
    found = lines.join(at.hint("merge"), ["doc_id", "para_no"]).select("cls", folded(F.col("line")).alias("para"))
    # a filter by the digest would become a key of the join, and all lines be folded for it
    own = F.first(F.when(F.unhex(F.md5("para")) == F.col("cls"), F.col("para")), ignorenulls=True)
    return found.groupBy("cls").agg(own.alias("para")).where("para is not null")


def repeats(docs: DataFrame, similarity: float = SIMILARITY, least_words: int = LEAST_WORDS,
            found: DataFrame | None = None) -> DataFrame:
    """``doc_id, para_no, first_doc_id, first_para_no, kept``: every paragraph that occurs again.

    Lines of ``least_words`` words or more are compared by similarity, those of SHORT_WORDS or more by equality;
    with ``least_words`` 1, which the query gives, all that hold a word are compared by similarity.
    A row for each paragraph whose cluster has two or more; ``first_*`` names the cluster by its first
    paragraph (least doc_id, then place), which alone is kept. NULL texts and rows without doc_id have
    no paragraphs; rows with the same doc_id share their places, and equal lines at one place count
    once. Documents without repeats have no row. An empty table gives none. ``found``: the staged
    ``places`` of ``docs``, where they are known already.
    """
    found = stage(places(docs, similarity, least_words), "places") if found is None else found
    found = found.where(F.col("cls") != F.unhex(F.md5(F.lit(""))))  # white space alone says nothing
    classes = found.where("bands is not null").groupBy("cls").agg(F.first(F.struct("bands", "doc_id", "para_no")).alias("one"))
    # most classes share no band; they are sorted out by a number, which takes far less room than a digest
    classes = stage(classes.select(F.monotonically_increasing_id().alias("id"), "cls", "one.*"), "classes")
    members = classes.select(F.explode("bands").alias("key"), "id")
    # written before it is joined, so that a band of very many members can be split
    shared = stage(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = stage(members.join(shared.hint("merge"), "key").select("key", "id", "n"), "numbers")
    at = stage(classes.drop("bands").join(members.select("id").distinct().hint("merge"), "id", "left_semi"), "at")
    members = stage(members.join(at.select("id", "cls").hint("merge"), "id").select("key", "cls", "n"), "members")
    texts = stage(texts_of(docs, at.drop("id"), least_words), "texts")
    group = components(matches(members, texts, similarity))
    occur = found.select("doc_id", "para_no", "cls").distinct()
    named = stage(occur.join(group.withColumnRenamed("node", "cls").hint("merge"), "cls", "left")
                  .select("doc_id", "para_no", F.coalesce("component", "cls").alias("component")), "named")
    first = (named.groupBy("component").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "para_no")).alias("first"))
             .where("n > 1").select("component", "first"))
    return named.join(stage(first, "firsts").hint("merge"), "component").select(
        "doc_id", "para_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.para_no").alias("first_para_no"),
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("para_no") == F.col("first.para_no"))).alias("kept"))


def remove_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the lines that ``found`` (of ``repeats``) doesn't keep; other columns unchanged.

    Of the query's result, rows with a ``first_word`` are passages inside lines; those are not cut out here.
    """
    found = found.where("first_word is null") if "first_word" in found.columns else found
    gone = (found.where("not kept").groupBy("doc_id").agg(F.collect_set("para_no").alias("__gone"))
            .withColumnRenamed("doc_id", "__doc"))
    lines = F.split("text", "\n")
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    return (docs.join(gone, F.col("doc_id") == F.col("__doc"), "left")
            .withColumn("text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(left)).drop("__gone", "__doc"))
