"""Byte-level BPE encoding and decoding with a table of distinct words.

The texts are split into words once. A chunk of documents keeps its distinct words as a list and its texts as
positions in that list. The lists, cut by a hash of the word into buckets whose number grows with the corpus, meet in
the distinct-word table, where each distinct word of the corpus is encoded once; the ids go back to the chunks, and
positions become ids. Only lists of distinct words are moved, no texts. Decoding joins ids with the pieces of the
vocabulary.

Ids are those of the tokenizers library with add_special_tokens=False: strings of added tokens in a text become their
ids. A NULL or empty text has no ids and decodes to an empty text. Each row is encoded on its own: repeated ids
and texts, and rows without an id, all come back. A text of any length is a chunk of its own if it is longer than
one. Columns beside the two that are named are not read. A table without rows gives none.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from panelforge.llm.fertility import PIECES
from panelforge.llm.frames import narrow, pack, pack_words, unpack, unpack_words
from panelforge.session import shared_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Characters of a chunk of documents, and of the corpus for each bucket of the distinct-word table.
CHUNK_CHARS, BUCKET_CHARS = 8_000_000, 16_000_000
LEAST_BUCKETS = 8
#: Groups of chunks that are joined by one task each; Spark allows no more buckets of a table.
MOST_GROUPS = 100_000
#: Positions from here on are kept in a list of their own.
_RARE = 65_535
#: Bytes of ids that a task hands on at a time.
BATCH_BYTES = 4_000_000
DOCS = -1  # the "bucket" of a chunk's documents


# --- the vocabulary ---


def byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable Latin characters as themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library, read from its JSON."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are Spark's
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(source)
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("only byte-level vocabularies without normalizer and prefix space are split here")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must match as plain strings")
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.library_split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        to_byte, vocab = byte_of_character(), spec["model"]["vocab"]
        self.pieces = np.empty(max([*vocab.values(), *(t["id"] for t in added)]) + 1, dtype=object)
        self.pieces[:] = b""
        for piece, i in vocab.items():
            self.pieces[i] = bytes(map(to_byte.__getitem__, piece)) if all(c in to_byte for c in piece) else piece.encode()
        for t in added:
            self.pieces[t["id"]] = t["content"].encode()
        self.lengths = np.fromiter(map(len, self.pieces), dtype=np.int64, count=len(self.pieces))
        marks = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.find = regex.compile(PIECES).findall
        self.known: dict[str, bool] = {}

    def _is_known(self, text: str) -> bool:
        """Whether all characters are in Python's own Unicode table; of others the libraries may think differently."""
        if text.isascii():
            return True
        known = self.known
        for c in set(text):
            if c not in known:
                known[c] = unicodedata.category(c) != "Cn"
            if not known[c]:
                return False
        return True

    def words(self, text: str) -> list[str]:
        """The words of a text, added tokens included; joined they are the text."""
        if self.special is not None and (parts := self.special.split(text))[1:]:
            return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.words(part))]
        if self._is_known(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.library_split(text)]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words after one another, number of ids of each)."""
        found = [e.ids for i in range(0, len(words), 4096)
                 for e in self.tokenizer.encode_batch_fast(words[i:i + 4096], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter((i for ids in found for i in ids), dtype=np.uint32, count=int(lengths.sum())), lengths

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.pieces[ids].tolist()).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def vocabulary(source: str) -> Vocabulary:
    return Vocabulary(source)


def read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


# --- splitting ---


class _Positions(dict):
    """Numbers of words in the order met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _chunk_rows(chunk: int, ids: list, positions: list[np.ndarray], words: _Positions, buckets: int) -> Iterator[tuple]:
    """The documents of a chunk, and its distinct words, a list for each bucket that has some.

    A word's position is its rank by frequency in the chunk, which packs best; lists keep that order.
    """
    flat = np.concatenate(positions)
    order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), dtype=np.int64)
    rank[order] = np.arange(len(words))
    met = list(words)
    raw = [met[i].encode("utf-8", "surrogatepass") for i in order]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in raw), dtype=np.int64, count=len(raw))
    codes = rank[flat]
    lengths = np.fromiter(map(len, positions), dtype=np.int64, count=len(positions))
    yield chunk, DOCS, pack(np.array([i or 0 for i in ids], dtype=np.int64), np.array([i is not None for i in ids], dtype=np.uint8),
                            narrow(lengths), np.minimum(codes, _RARE).astype(np.uint16), narrow(codes[codes >= _RARE] - _RARE),
                            narrow(bucket))
    by_bucket = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets)).tolist()
    for b, (start, end) in enumerate(zip([0, *ends], ends)):
        if end > start:
            yield chunk, b, pack_words([raw[i] for i in by_bucket[start:end]])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    chunk, bucket, payload = zip(*rows)
    return pa.record_batch([pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())],
                           names=["chunk", "bucket", "payload"])


CHUNKS = "chunk bigint, bucket int, payload binary"


def split(docs: DataFrame, source: str, buckets: int, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(chunk, bucket, payload): documents as positions (bucket -1) and lists of distinct words, by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, task, seq = vocabulary(source), TaskContext.get().partitionId(), 0
        ids, positions, words, chars = [], [], _Positions(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = v.words(text.as_py() or "")
                positions.append(np.fromiter(map(words.__getitem__, found), dtype=np.uint32, count=len(found)))
                ids.append(doc_id)
                chars += sum(map(len, found)) + 16
                if chars >= chunk_chars:
                    yield _batch(list(_chunk_rows(task << 32 | seq, ids, positions, words, buckets)))
                    ids, positions, words, chars, seq = [], [], _Positions(), 0, seq + 1
        if ids:
            yield _batch(list(_chunk_rows(task << 32 | seq, ids, positions, words, buckets)))

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(run, CHUNKS)


# --- the distinct-word table and the way back ---


def encoded_words(lists: DataFrame, source: str) -> DataFrame:
    """(chunk, bucket, payload): for each list the ids of its words; a word is encoded once in its bucket."""
    def run(table: pa.Table) -> pa.Table:
        v, seen = vocabulary(source), _Positions()
        chunks, frames = table.column("chunk").to_pylist(), table.column("payload").to_pylist()
        at = []
        for frame in frames:
            words = unpack_words(frame)
            at.append(np.fromiter(map(seen.__getitem__, words), dtype=np.int64, count=len(words)))
        ids, lengths = v.encode([w.decode("utf-8", "surrogatepass") for w in seen])
        starts = np.cumsum(lengths) - lengths
        payload = [pack(narrow(lengths[w]), narrow(ids[ragged(starts[w], lengths[w])])) for w in at]
        return pa.table([pa.array(chunks, pa.int64()), table.column("bucket").cast(pa.int32()), pa.array(payload, pa.binary())],
                        names=["chunk", "bucket", "payload"])

    return lists.groupBy("bucket").applyInArrow(run, CHUNKS)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, after one another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _joined(documents: pa.Table, lists: pa.Table) -> pa.Table:
    """The ids of all documents of one chunk, from their positions and the ids of the chunk's words."""
    parts = [unpack(p.as_py()) for p in lists.sort_by("bucket").column("payload")]
    doc_ids, out = [], []
    for frame in documents.column("payload"):
        known, there, counts, common, rare, bucket = unpack(frame.as_py())
        order = np.argsort(bucket, kind="stable")  # where the words of the lists stand
        lengths = np.zeros(len(bucket), dtype=np.int64)
        starts = np.zeros(len(bucket), dtype=np.int64)
        ids = np.empty(0, dtype="<u4")
        if parts:
            lengths[order] = listed = np.concatenate([p[0] for p in parts]).astype(np.int64)
            starts[order] = np.cumsum(listed) - listed
            ids = np.concatenate([p[1] for p in parts]).astype("<u4")
        positions = common.astype(np.uint32)
        positions[common == _RARE] += rare.astype(np.uint32)
        ends = np.cumsum(counts, dtype=np.int64).tolist()
        for a, b in zip([0, *ends], ends):
            p = positions[a:b]
            out.append(ids[ragged(starts[p], lengths[p])].tobytes())
        doc_ids += [i if t else None for i, t in zip(known.tolist(), there.tolist())]
    return pa.table([pa.array(doc_ids, pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "ids"])


def _kept_by_chunk(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` written as a table bucketed by chunk, so that what is joined to a chunk comes to it, not the other way."""
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "bpe")
    name = f"panelforge_bpe_{uuid.uuid4().hex}"
    rows.write.bucketBy(groups, "chunk").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, path: str = VOCABULARY, chunk_chars: int = CHUNK_CHARS,
           bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, little-endian 32-bit numbers after one another."""
    source = read(path)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets, groups = (max(LEAST_BUCKETS, chars // n + 1) for n in (bucket_chars, chunk_chars))
    parts = _kept_by_chunk(split(docs, source, buckets, chunk_chars), min(groups, MOST_GROUPS))
    words = encoded_words(parts.where(F.col("bucket") != DOCS), source)
    return (parts.where(F.col("bucket") == DOCS).groupBy("chunk").cogroup(words.groupBy("chunk"))
            .applyInArrow(_joined, "doc_id bigint, ids binary"))


def decode(rows: DataFrame, path: str = VOCABULARY, column: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text of the ids in ``column``: the pieces of the ids, joined; invalid UTF-8 becomes U+FFFD.

    The pieces are one row for each id of the vocabulary, so they go to every task as an array that the ids index.
    A NULL in ``column`` is an empty text; an existing column ``to`` is replaced.
    """
    source = read(path)
    kept = rows.drop(to)
    names = [*kept.columns, to]
    at = names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(source)
        for batch in batches:
            sizes = np.array([len(x) if x is not None else 0 for x in batch.column(at).to_pylist()], dtype=np.int64)
            steps = np.cumsum(sizes) // BATCH_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(steps)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                texts = [v.decode(np.frombuffer(x or b"", dtype="<u4")) for x in part.column(at).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string())], names=names)

    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add(to, StringType()))
