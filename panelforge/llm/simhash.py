"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are sorted by the Gray rank of their bits. Close in Gray order means a long common run of
leading bits, so a run of neighbours is summed up by an upper node: the bits all of them share (mask)
and their values (pattern). The differing bits between two patterns under both masks are a lower bound
for every pair below the two nodes, so whole groups are pruned by differences that have already
accumulated, and only surviving groups are opened.

Distribution: two fingerprints with at most ``k`` differing bits agree on at least one of k + 1 equal
pieces of the 64 bits. Each of the k + 1 rotations puts another piece in front; the rotated fingerprints
are range-partitioned by (rotation, Gray rank), which splits evenly however many fingerprints agree on
a piece, and cut into blocks of at most BLOCK leaves that agree on the front piece. Block nodes (not
fingerprints) are joined on the front piece; pairs of blocks that survive the bound are opened, each by
one call. It returns edges between the groups it finds, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.components import components
from panelforge.session import stage

BLOCK = 1024          # leaves of a block: a pair of blocks is at most a million comparisons
NODE = 32             # leaves of the lowest nodes inside a block
_SPACE = str.maketrans({"\t": " ", "\n": " ", "\x0b": " ", "\x0c": " ", "\r": " "})
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- fingerprints

def _words(text: str) -> list[str]:
    return [w for w in text.translate(_SPACE).split(" ") if w]


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of all word shingles, repeats included; 0 for a text without words."""
    if not text:
        return 0
    words = _words(text.translate(_LOWER))
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        some = range(at, min(n, at + (1 << 16)))
        h = np.fromiter((digest(" ".join(words[i:i + size]).encode("utf-8", "surrogatepass"), seed) for i in some),
                        dtype=np.uint64, count=len(some))
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int = 3) -> Column:
    """The fingerprint as a signed long; a NULL text has no words and gives 0."""
    @F.pandas_udf("long")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t, size) for t in s], dtype=np.uint64).view(np.int64))

    return udf(text)


def to_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- the index

def rotate(fp: np.ndarray, by: int) -> np.ndarray:
    return fp if by == 0 else (fp << np.uint64(by)) | (fp >> np.uint64(64 - by))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each bit pattern in the reflected Gray sequence: a prefix XOR of the bits."""
    rank = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def nodes_of(fp: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, patterns and masks of the runs of ``size`` leaves of Gray-ordered ``fp``."""
    starts = np.arange(0, len(fp), size)
    every, any_ = np.bitwise_and.reduceat(fp, starts), np.bitwise_or.reduceat(fp, starts)
    return starts, every, ~(every ^ any_)


def linked(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Which leaves of a and b have at most k differing bits; nodes whose bound is over k stay closed."""
    if max(len(a), len(b)) <= NODE:
        return np.bitwise_count(a[:, None] ^ b[None, :]) <= k
    (sa, pa_, ma), (sb, pb, mb) = nodes_of(a, NODE), nodes_of(b, NODE)
    bound = np.bitwise_count((pa_[:, None] ^ pb[None, :]) & ma[:, None] & mb[None, :])
    found = np.zeros((len(a), len(b)), dtype=bool)
    for i, j in zip(*(x.tolist() for x in np.nonzero(bound <= k))):
        rows, cols = slice(sa[i], sa[i] + NODE), slice(sb[j], sb[j] + NODE)
        found[rows, cols] = np.bitwise_count(a[rows][:, None] ^ b[cols][None, :]) <= k
    return found


def labels(found: np.ndarray) -> np.ndarray:
    """Least leaf number that each leaf reaches over a symmetric ``found``."""
    label = np.arange(len(found))
    while True:
        least = np.where(found, label[None, :], len(found)).min(axis=1)
        least = np.minimum(label, least)
        least = np.minimum(least, least[least])
        if np.array_equal(least, label):
            return label
        label = least


def block_links(a: np.ndarray, b: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links inside a block, or those between two blocks, connect.

    Inside a block each leaf is tied to the least one it reaches. Between two blocks the groups inside
    each are known already (their own tasks tie them), so two blocks of one tight group give one edge.
    """
    la = labels(linked(a, a, k))
    if b is None:
        tied = np.flatnonzero(la != np.arange(len(a)))
        return a[tied], a[la[tied]]
    lb = labels(linked(b, b, k))
    u, v = np.nonzero(linked(a, b, k))
    pairs = np.unique(la[u].astype(np.int64) * len(b) + lb[v])
    return a[pairs // len(b)], b[pairs % len(b)]


def _pieces(k: int) -> list[tuple[int, int]]:
    """(rotation, length) of the k + 1 pieces of the 64 bits."""
    cuts = [round(64 * i / (k + 1)) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def near_edges(distinct: DataFrame, k: int = 3) -> DataFrame:
    """Edges (a, b) of signed fingerprints that connect what links of at most ``k`` bits connect.

    ``distinct`` holds each fingerprint once in ``fp``. No link is lost: the edges connect exactly
    what all links connect.
    """
    pieces = _pieces(k)

    def rotated(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for r, (by, length) in enumerate(pieces):
                turned = rotate(fp, by)
                front = (turned >> np.uint64(64 - length)).astype(np.int64)
                # ranks are unsigned; flipping the top bit makes the signed order the same
                rank = (gray_rank(turned) ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), r, dtype=np.int32)), pa.array(front), pa.array(rank),
                     pa.array(turned.view(np.int64))], names=["r", "front", "rank", "turned"])

    def blocks(batches):
        # a partition is a run of the index; block numbers are unique by their first leaf
        kept: list[np.ndarray] = []
        for batch in batches:
            kept.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in
                                  (batch.column(0), batch.column(1), batch.column(3))]))
            rows = np.concatenate(kept, axis=1)
            change = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            ends = change[-1] if len(change) else (rows.shape[1] // BLOCK) * BLOCK
            yield from cut(rows[:, :ends])
            kept = [rows[:, ends:]]
        if kept:
            yield from cut(kept[0])

    def cut(rows):
        if not rows.shape[1]:
            return
        edge = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        r, front, first, pattern, mask, leaves = [], [], [], [], [], []
        for s, e in zip([0, *edge.tolist()], [*edge.tolist(), rows.shape[1]]):
            for at in range(s, e, BLOCK):
                some = rows[2, at:min(e, at + BLOCK)]
                _, p, m = nodes_of(some.view(np.uint64), BLOCK)
                r.append(rows[0, at]), front.append(rows[1, at]), first.append(some[0])
                pattern.append(p.view(np.int64)[0]), mask.append(m.view(np.int64)[0]), leaves.append(some.tolist())
        for at in range(0, len(r), 4096):
            to = at + 4096
            yield pa.RecordBatch.from_arrays(
                [pa.array(r[at:to], pa.int32()), pa.array(front[at:to], pa.int64()), pa.array(first[at:to], pa.int64()),
                 pa.array(pattern[at:to], pa.int64()), pa.array(mask[at:to], pa.int64()),
                 pa.array(leaves[at:to], pa.list_(pa.int64()))],
                names=["r", "front", "first", "pattern", "mask", "leaves"])

    spark = distinct.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = (distinct.select("fp").mapInArrow(rotated, "r int, front long, rank long, turned long")
             .repartitionByRange(parts, "r", "front", "rank").sortWithinPartitions("r", "front", "rank")
             .mapInArrow(blocks, "r int, front long, first long, pattern long, mask long, leaves array<long>"))
    index = stage(index, "gray-index")
    node = index.select("r", "front", "first", "pattern", "mask", F.size("leaves").alias("n"))
    inside = index.where(F.size("leaves") > 1).select("r", "leaves", F.lit(None).cast("array<long>").alias("others"))
    left = node.select("r", "front", *(F.col(c).alias(f"{c}_a") for c in ("first", "pattern", "mask")))
    right = node.select("r", "front", *(F.col(c).alias(f"{c}_b") for c in ("first", "pattern", "mask")))
    differ = F.col("pattern_a").bitwiseXOR(F.col("pattern_b")).bitwiseAND(F.col("mask_a")).bitwiseAND(F.col("mask_b"))
    pairs = (left.join(right, ["r", "front"])
             .where((F.col("first_a") < F.col("first_b")) & (F.bit_count(differ) <= k)).select("r", "first_a", "first_b"))
    leaf = index.select("r", "first", "leaves")
    between = (pairs.join(leaf.withColumnRenamed("first", "first_a"), ["r", "first_a"])
               .join(leaf.select("r", F.col("first").alias("first_b"), F.col("leaves").alias("others")), ["r", "first_b"])
               .select("r", "leaves", "others"))

    def opened(batches):
        for batch in batches:
            for r, one, two in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                a = np.asarray(one.values, dtype=np.int64).view(np.uint64)
                b = np.asarray(two.values, dtype=np.int64).view(np.uint64) if two.is_valid else None
                x, y = block_links(a, b, k)
                if len(x):
                    back = (64 - pieces[r][0]) % 64
                    yield pa.RecordBatch.from_arrays([pa.array(rotate(x, back).view(np.int64)),
                                                      pa.array(rotate(y, back).view(np.int64))], names=["a", "b"])

    work = inside.unionByName(between).repartition(parts)  # open block pairs evenly, hot pieces included
    return work.mapInArrow(opened, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 3, size: int = 3) -> DataFrame:
    """``docs`` (doc_id, text) to ``doc_id, fp, component_id``, a row for each row.

    Rows with equal fingerprints form one class from the start; classes are linked at ``k`` or fewer
    differing bits. ``component_id`` is the least doc_id reachable. NULL, empty and blank texts have
    fingerprint 0 and are linked like any other. A NULL doc_id gets a component but never names one;
    a component of such rows only has NULL. Repeated rows stay. An empty table gives no rows.
    """
    rows, linked = _linked(docs, k, size)
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _linked(docs: DataFrame, k: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of each row, and (fp, least doc_id, component) of each fingerprint, named by one of them."""
    rows = stage(docs.select("doc_id", fingerprints(F.col("text"), size).alias("fp")), "simhash")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    reached = components(near_edges(classes, k)).withColumnRenamed("node", "fp")
    linked = classes.join(reached, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    return rows, linked


def keep_one(docs: DataFrame, k: int = 3, size: int = 3) -> DataFrame:
    """One row of each group of near-duplicates: the least doc_id's, of its texts the one of least fingerprint.

    A group without any doc_id keeps the row of its least fingerprint. Of rows with that id and
    fingerprint the one whose columns hash lowest stays, so the order of rows decides nothing. Columns and texts of the
    kept rows are unchanged. An empty table gives no rows.
    """
    rows, linked = _linked(docs, k, size)
    # NULL ids come last
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp")
    kept = stage(rows.join(linked.select("fp", "component"), "fp").groupBy("component").agg(F.min(first).alias("w"))
                 .select("w.doc_id", "w.fp"), "kept")
    # an id whose rows share a fingerprint tells its rows; of others, few, the fingerprints are looked at again
    ids = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg((F.min("fp") != F.max("fp")).alias("several"))
    kept = stage(kept.join(ids, "doc_id", "left").select("doc_id", "fp", F.coalesce("several", F.lit(True)).alias("several")), "kept")
    choice = F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row")
    plain = (docs.join(kept.where("NOT several").select("doc_id").hint("merge"), "doc_id", "left_semi")  # merged: it grows
             .groupBy("doc_id").agg(choice).select("__row.*"))
    some = kept.where("several").select(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"))
    if some.isEmpty():
        return plain
    named = docs.join(some.select(F.col("__id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    mixed = named.unionByName(docs.where("doc_id IS NULL"))  # rows without an id meet by fingerprint only
    looked = mixed.withColumn("__look", fingerprints(F.col("text"), size)).join(
        some, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__look") == F.col("__fp")), "left_semi")
    return plain.unionByName(looked.groupBy("doc_id", "__look").agg(choice).select("__row.*"))
