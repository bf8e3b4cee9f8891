"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked pairs.

A byte-level BPE vocabulary (side A) encodes a space and the text, a piece vocabulary with byte fallback (side B)
the text; both then spell the same bytes. Where tokens of both sides end, a group ends; an A and a B token whose
bytes overlap are a link. Each byte range between neighbouring ends of either side belongs to one token of each, so
there is a link for each such range.

Pairs are counted by external spill counting. A chunk of documents writes its pair-document records, sorted side B
first, radix-partitioned by the B id, as zstd runs into the shared folder. A k-way merge over a heap of the runs'
blocks counts each pair; tasks' counts are added up by Spark, and as the pairs of a B id stand together, one
pass in that order yields each B id's highest count. The runs are then read again and stream what each pair
contributes back to its documents. Runs of a radix are dealt to several tasks, so a frequent B id is no larger
for one task than a rare one.

A text that is NULL, empty, or that either side doesn't spell byte for byte as a space and the text (a piece
vocabulary may normalise it) has no tokens: zeros, and an empty ``groups_sha256``. Strings of special tokens are
plain text. Every row is a document of its own, with repeated ids, repeated texts or without an id; all count.
Columns beside doc_id and text are not read. Without rows both results are empty.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.bpe import byte_of_character, read
from panelforge.llm.fertility import PIECES
from panelforge.llm.frames import narrow, pack, unpack
from panelforge.session import stage

VOCABULARY_A, VOCABULARY_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of a chunk of documents, records of a block of a run, chunks whose runs one task merges.
CHUNK_CHARS, BLOCK, CHUNKS_A_TASK = 6_000_000, 32_768, 64
#: Parts of the B ids. A part of the table of distinct pairs is held whole by a task.
RADIXES = 32
#: Bytes of compressed runs that are merged at once.
MERGE_BYTES = 32_000_000
#: Texts over this go to the slower library, which neither recurses nor slows down on long words.
LONG_TEXT = 200_000
#: Bits of a document's number in its chunk, and of an A id.
_DOC_BITS, _A_BITS = 24, 16


# --- the two vocabularies ---


class Tokenizers:
    """Both vocabularies, the bytes of their ids, and the ids as text with what follows them in a group."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(a)
        special = {t["content"] for t in spec["added_tokens"]}
        to_byte = byte_of_character()
        ranks = {bytes(map(to_byte.__getitem__, p)): i for p, i in spec["model"]["vocab"].items() if p not in special}
        self.fast = tiktoken.Encoding("a", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_str(a)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.pieces_a = _table(ranks)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.pieces_b = _table({i: bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(names)}, by_id=True)
        if len(self.pieces_a) > 1 << _A_BITS or len(self.pieces_b) > 1 << (63 - _DOC_BITS - _A_BITS):
            raise ValueError("the ids don't fit in a record's key")
        self.lengths_a, self.lengths_b = (np.fromiter(map(len, p), dtype=np.int64, count=len(p)) for p in (self.pieces_a, self.pieces_b))
        # A inside and at the end of its side of a group, then B likewise
        n, m = len(self.pieces_a), len(self.pieces_b)
        self.shown = np.array([f"{i}{after}".encode() for k, ends in ((n, ",|"), (m, ",;")) for after in ends for i in range(k)], dtype=object)

    def ids_a(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


def _table(of: dict, by_id: bool = False) -> np.ndarray:
    pairs = of.items() if by_id else ((i, p) for p, i in of.items())
    table = np.empty(max(of if by_id else of.values()) + 1, dtype=object)
    table[:] = b""
    for i, piece in pairs:
        table[i] = piece
    return table


@lru_cache(maxsize=2)
def tokenizers(a: str, b: bytes) -> Tokenizers:
    return Tokenizers(a, b)


# --- tokens, groups and links of some documents ---


@dataclass
class Aligned:
    """For each document: tokens of either side, groups, links, digest; for each link: document and pair."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups_sha256: list[str]
    link_doc: np.ndarray
    link_pair: np.ndarray


def aligned(t: Tokenizers, texts: Sequence[str | None]) -> Aligned:
    """All texts at once, on one axis of bytes: a text's tokens end where it ends, on both sides."""
    n = len(texts)
    given = [i for i in range(n) if texts[i]]
    found_b = t.ids_b([texts[i] for i in given])
    of_a, of_b, docs = [], [], []
    for i, b in zip(given, found_b):
        spaced = " " + texts[i]
        raw, ids_b = spaced.encode(), np.array(b, dtype=np.int64)
        if int(t.lengths_b[ids_b].sum()) != len(raw) or b"".join(t.pieces_b[ids_b].tolist()) != raw:
            continue
        ids_a = t.ids_a(spaced)
        if b"".join(t.pieces_a[ids_a].tolist()) != raw:
            continue
        of_a.append(ids_a)
        of_b.append(ids_b)
        docs.append(i)
    counts = [np.zeros(n, dtype=np.int64) for _ in range(4)]
    digests = [""] * n
    if not docs:
        return Aligned(*counts, digests, np.empty(0, np.int64), np.empty(0, np.int64))
    a, b = np.concatenate(of_a), np.concatenate(of_b)
    n_a, n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (of_a, of_b))
    ends_a, ends_b = np.cumsum(t.lengths_a[a]), np.cumsum(t.lengths_b[b])
    size = int(ends_a[-1])
    at_a, at_b = np.zeros(size + 1, dtype=bool), np.zeros(size + 1, dtype=bool)
    at_a[ends_a] = True
    at_b[ends_b] = True
    both = at_a & at_b
    # which token of either side, and which group, a byte is in: how many end at or before it
    tokens_a, tokens_b, groups = (np.cumsum(x, dtype=np.int32) for x in (at_a, at_b, both))
    ends = np.flatnonzero(at_a | at_b)
    pair = b[tokens_b[ends - 1]] << _A_BITS | a[tokens_a[ends - 1]]
    doc_ends = ends_a[np.cumsum(n_a) - 1]
    n_links = np.diff(np.searchsorted(ends, doc_ends, side="right"), prepend=0)
    n_groups = np.diff(groups[doc_ends].astype(np.int64), prepend=0)
    for column, values in zip(counts, (n_a, n_b, n_groups, n_links)):
        column[docs] = values
    # the tokens in order of groups, A before B, as text
    group = np.concatenate([groups[ends_a - 1] * 2, groups[ends_b - 1] * 2 + 1])
    text = np.concatenate([a + both[ends_a] * len(t.pieces_a),
                           2 * len(t.pieces_a) + b + both[ends_b] * len(t.pieces_b)])
    shown = t.shown[text[np.argsort(group, kind="stable")]].tolist()
    stops = np.cumsum(n_a + n_b).tolist()
    for i, start, stop in zip(docs, [0, *stops], stops):
        digests[i] = hashlib.sha256(b"".join(shown[start:stop])[:-1]).hexdigest()
    return Aligned(*counts, digests, np.repeat(np.array(docs, dtype=np.int64), n_links), pair)


# --- pair-document records, spilled as sorted runs ---


def run_blocks(pair: np.ndarray, doc: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A run: blocks of (first pair, differences of pairs, records of each, documents, links), sorted by pair."""
    blocks = []
    for start in range(0, len(pair), BLOCK):
        p, d, m = (x[start:start + BLOCK] for x in (pair, doc, n))
        first = np.flatnonzero(np.diff(p, prepend=-1))
        distinct = p[first]
        blocks.append(pack(distinct[:1].astype(np.int64), narrow(np.diff(distinct)),
                           narrow(np.diff(np.append(first, len(p)))), narrow(d), narrow(m)))
    return blocks


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs, records of each, documents, links)"""
    first, steps, records, doc, n = unpack(block)
    return np.cumsum(np.concatenate([first, steps.astype(np.int64)])), records.astype(np.int64), doc.astype(np.int64), n.astype(np.int64)


def block_counts(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs, links of each)"""
    pairs, records, _, n = read_block(block)
    return pairs, np.add.reduceat(n, np.cumsum(records) - records)


def merged(runs: Sequence[Sequence[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) over all runs in order of pairs, each pair once.

    A heap holds each run by the last pair of its block at hand. Whatever lies at or below the least of these is
    complete in all runs and leaves; the runs whose block that ends take their next one. A pair that a block
    border cuts comes on in the run's next block, so the highest pair that leaves waits for the next round.
    """
    at, heap = {}, []
    for k, run in enumerate(runs):
        if run:
            at[k] = [iter(run[1:]), *block_counts(run[0])]
            heapq.heappush(heap, (int(at[k][1][-1]), k))
    held_pair, held_count = -1, 0
    while heap:
        bound = heap[0][0]
        pairs, counts = [], []
        for k, (_, p, c) in list(at.items()):
            cut = int(np.searchsorted(p, bound, side="right"))
            if cut:
                pairs.append(p[:cut])
                counts.append(c[:cut])
                at[k][1:] = p[cut:], c[cut:]
        ended = []
        while heap and heap[0][0] <= bound:
            ended.append(heapq.heappop(heap)[1])
        for k in ended:
            block = next(at[k][0], None)
            if block is None:
                del at[k]
            else:
                at[k][1:] = block_counts(block)
                heapq.heappush(heap, (int(at[k][1][-1]), k))
        p, c = np.concatenate(pairs), np.concatenate(counts)
        order = np.argsort(p, kind="stable")
        p, c = p[order], c[order]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        p, c = p[first], np.add.reduceat(c, first)
        if held_pair == p[0]:
            c[0] += held_count
        elif held_pair >= 0:
            yield np.array([held_pair]), np.array([held_count])
        held_pair, held_count = int(p[-1]), int(c[-1])
        if len(p) > 1:
            yield p[:-1], c[:-1]
    if held_pair >= 0:
        yield np.array([held_pair]), np.array([held_count])


RECORDS = ("chunk bigint, doc int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups_sha256 string, radix int, run array<binary>")


def _document_rows(chunk: int, first: int, ids: list, found: Aligned) -> pa.RecordBatch:
    n = len(ids)
    numbers = [pa.array(x, pa.int64()) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
    return pa.record_batch([
        pa.array(np.full(n, chunk)), pa.array(np.arange(first, first + n, dtype=np.int32)), pa.array(ids, pa.int64()),
        *numbers, pa.array(found.groups_sha256, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.binary()))],
        names=[c.split()[0] for c in RECORDS.split(", ")])


def _run_rows(chunk: int, keys: list[np.ndarray], radixes: int) -> Iterator[pa.RecordBatch]:
    if not keys:
        return
    key = np.sort(np.concatenate(keys))  # side B, side A, document
    first = np.flatnonzero(np.diff(key, prepend=-1))
    n, key = np.diff(np.append(first, len(key))), key[first]
    pair, doc = key >> _DOC_BITS, key & ((1 << _DOC_BITS) - 1)
    radix = (pair >> _A_BITS) % radixes
    for r in range(radixes):
        mine = np.flatnonzero(radix == r)
        if len(mine):
            blocks = run_blocks(pair[mine], doc[mine], n[mine])
            yield pa.record_batch([
                pa.array([chunk], pa.int64()), pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()),
                pa.array([r], pa.int32()), pa.array([blocks], pa.list_(pa.binary()))], names=[c.split()[0] for c in RECORDS.split(", ")])


def spilled(docs: DataFrame, a: str, b: bytes, chunk_chars: int = CHUNK_CHARS, radixes: int = RADIXES) -> DataFrame:
    """A row for each document, and a row for each chunk and radix with the run of its records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, task = tokenizers(a, b), TaskContext.get().partitionId()
        seq, numbered, chars, keys = 0, 0, 0, []
        ids, texts, waiting = [], [], 0

        def align_waiting() -> pa.RecordBatch:
            nonlocal ids, texts, waiting, numbered
            found = aligned(t, texts)
            keys.append(found.link_pair << _DOC_BITS | (found.link_doc + numbered))
            rows = _document_rows(task << 32 | seq, numbered, ids, found)
            numbered, ids, texts, waiting = numbered + len(ids), [], [], 0
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size = len(texts[-1] or "") + 64
                waiting, chars = waiting + size, chars + size
                if chars >= chunk_chars or waiting >= chunk_chars // 8:
                    yield align_waiting()
                if chars >= chunk_chars:
                    yield from _run_rows(task << 32 | seq, keys, radixes)
                    seq, numbered, chars = seq + 1, 0, 0
                    keys.clear()
        if ids:
            yield align_waiting()
        yield from _run_rows(task << 32 | seq, keys, radixes)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, RECORDS)


# --- counting and the way back ---


def counted(runs: DataFrame) -> DataFrame:
    """(pair, n): counts of the runs that a task reads, merged, some MERGE_BYTES at a time; not yet added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        size = 0

        def merge() -> Iterator[pa.RecordBatch]:
            for r in sorted(waiting):
                for pairs, counts in merged(waiting[r]):
                    yield pa.record_batch([pa.array(pairs, pa.int64()), pa.array(counts, pa.int64())], names=["pair", "n"])
            waiting.clear()

        for batch in batches:
            for r, blocks in zip(batch.column(0).to_pylist(), batch.column(1)):
                blocks = blocks.as_py()
                waiting.setdefault(r, []).append(blocks)
                size += sum(map(len, blocks))
                if size >= MERGE_BYTES:
                    yield from merge()
                    size = 0
        yield from merge()

    return runs.select("radix", "run").mapInArrow(run, "pair bigint, n bigint")


def highest(totals: DataFrame, radixes: int = RADIXES) -> DataFrame:
    """(radix, pairs): all pairs of the B ids of a radix, in order, with counts and whether it is its B id's highest."""
    def run(table: pa.Table) -> pa.Table:
        pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        side = pair >> _A_BITS
        first = np.flatnonzero(np.diff(side, prepend=-1))
        best = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(side))))
        frame = pack(pair[:1], narrow(np.diff(pair)), n, (n == best).astype(np.uint8))
        return pa.table([pa.array([int(side[0] % radixes)], pa.int32()), pa.array([frame], pa.binary())], names=["radix", "pairs"])

    radix = F.shiftright("pair", _A_BITS) % radixes
    return totals.groupBy(radix.cast("int").alias("radix")).applyInArrow(run, "radix int, pairs binary")


def _contributions(key, runs: pa.Table, tables: pa.Table) -> pa.Table:
    """(chunk, doc, count_sum, n_best) that the pairs of a radix give to the documents of some chunks."""
    chunks, docs, sums, bests = [], [], [], []
    if runs.num_rows:
        first, steps, n, best = unpack(tables.column("pairs")[0].as_py())
        pairs = np.cumsum(np.concatenate([first, steps.astype(np.int64)]))
        best = best.astype(np.int64)
        for chunk, blocks in zip(runs.column("chunk").to_pylist(), runs.column("run")):
            total = np.zeros(0, dtype=np.int64)
            high = np.zeros(0, dtype=np.int64)
            for block in blocks:
                p, records, doc, links = read_block(block.as_py())
                at = np.repeat(np.searchsorted(pairs, p), records)
                if len(total) <= doc.max():
                    total, high = (np.concatenate([x, np.zeros(int(doc.max()) + 1 - len(x), dtype=np.int64)]) for x in (total, high))
                np.add.at(total, doc, links * n[at])
                np.add.at(high, doc, links * best[at])
            there = np.flatnonzero(total)
            chunks.append(np.full(len(there), chunk))
            docs.append(there)
            sums.append(total[there])
            bests.append(high[there])
    parts = [np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (chunks, docs, sums, bests)]
    return pa.table([pa.array(parts[0], pa.int64()), pa.array(parts[1].astype(np.int32)), pa.array(parts[2], pa.int64()),
                     pa.array(parts[3], pa.int64())], names=["chunk", "doc", "count_sum", "n_best"])


@dataclass
class Alignment:
    """``documents``: the counts and the digest of each row; ``pairs``: (b, a, n, best) of each linked pair of ids."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B, chunk_chars: int = CHUNK_CHARS,
          radixes: int = RADIXES) -> Alignment:
    """Align all rows of (doc_id, text) and count their linked pairs over the whole table."""
    with open(path_b, "rb") as f:
        model = f.read()
    rows = stage(spilled(docs, read(path_a), model, chunk_chars, radixes), "alignment")
    runs = rows.where("radix IS NOT NULL").select("chunk", "radix", "run")
    documents = rows.where("radix IS NULL")
    totals = counted(runs).groupBy("pair").agg(F.sum("n").alias("n"))
    tables = stage(highest(totals, radixes), "pairs")
    # a task for each radix and each CHUNKS_A_TASK chunks or so
    parts = runs.select("chunk").distinct().count() // CHUNKS_A_TASK + 1
    dealt = runs.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    spread = tables.select("radix", "pairs", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    given = (dealt.groupBy("radix", "part").cogroup(spread.groupBy("radix", "part"))
             .applyInArrow(_contributions, "chunk bigint, doc int, count_sum bigint, n_best bigint")
             .groupBy("chunk", "doc").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")))
    whole = (documents.join(given, ["chunk", "doc"], "left")
             .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                     F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
    return Alignment(whole, tables.mapInArrow(_pair_rows, "b int, a int, n bigint, best boolean"))


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for frame in batch.column(1):
            first, steps, n, best = unpack(frame.as_py())
            pair = np.cumsum(np.concatenate([first, steps.astype(np.int64)]))
            yield pa.record_batch([pa.array((pair >> _A_BITS).astype(np.int32)), pa.array((pair & ((1 << _A_BITS) - 1)).astype(np.int32)),
                                   pa.array(n), pa.array(best.astype(bool))], names=["b", "a", "n", "best"])
