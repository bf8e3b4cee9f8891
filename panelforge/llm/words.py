"""The words of several texts as one stream, so that numpy works on many short texts and lines at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

#: Bytes of text taken at once, or one text that is longer.
GROUP = 1 << 18


class Words:
    """Words of the texts one after another: A-Z lower-cased, split at ASCII white space, joined by single spaces.

    ``begins`` and ``ends`` are the places of each word in ``joined``; ``counts`` the words of each line,
    ``lines`` the lines of each text; ``first_word`` (of each line) and ``first_line`` (of each text) count from 0 on.
    """

    def __init__(self, texts: Sequence[bytes]):
        self.texts, self.words, counts, lines = texts, [], [], []
        for text in texts:
            of_text = [line.split() for line in text.lower().split(b"\n")]  # bytes: A-Z and ASCII spaces
            counts.extend(map(len, of_text))
            lines.append(len(of_text))
            for line in of_text:
                self.words += line
        self.joined = b" ".join(self.words)
        gaps = np.flatnonzero(np.frombuffer(self.joined, dtype=np.uint8) == 32)
        some = min(len(self.words), 1)
        self.begins = np.concatenate([np.zeros(some, dtype=np.int64), gaps + 1])
        self.ends = np.concatenate([gaps, np.full(some, len(self.joined), dtype=np.int64)])
        self.counts, self.lines = np.array(counts, dtype=np.int64), np.array(lines, dtype=np.int64)
        self.first_word, self.first_line = np.cumsum(self.counts) - self.counts, np.cumsum(self.lines) - self.lines

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), dtype=np.uint64, count=len(self.words))

    @cached_property
    def raw_lengths(self) -> np.ndarray:
        """Bytes of each line as it was."""
        return np.array([len(line) for text in self.texts for line in text.split(b"\n")], dtype=np.int64)

    def place(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text of each of these lines, and its number there."""
        text = np.searchsorted(self.first_line, line, side="right") - 1
        return text, line - self.first_line[text]


def groups(batch: pa.RecordBatch, size: int = GROUP) -> Iterator[tuple[pa.Array, Words]]:
    """The batch in parts of about ``size`` bytes of ``text``: ids and words. NULL is not allowed."""
    texts = batch.column("text").cast(pa.binary())
    start, bytes_ = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if bytes_ and bytes_ + n > size:
            yield batch.column("doc_id").slice(start, i - start), Words(texts.slice(start, i - start).to_pylist())
            start, bytes_ = i, 0
        bytes_ += n
    if start < batch.num_rows:
        yield batch.column("doc_id").slice(start), Words(texts.slice(start).to_pylist())


def by_words(docs: DataFrame, columns: dict[str, str], find: Callable[[pa.Array, Words], list[dict[str, pa.Array]]]) -> DataFrame:
    """``doc_id`` and ``columns`` (name to type) of what ``find`` gives, in parts, for the ids and words of each group of texts.

    Rows without text or doc_id are left out. Columns that a part hasn't are NULL there.
    """
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, words in groups(batch):
                for part in find(ids, words):
                    rows = len(part["doc_id"])
                    yield pa.RecordBatch.from_arrays(
                        [part["doc_id"], *(part[c] if c in part else pa.nulls(rows, _TYPES[t]) for c, t in columns.items())],
                        names=["doc_id", *columns])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.where("text is not null and doc_id is not null").select("doc_id", "text")
            .mapInArrow(parts, ", ".join([f"doc_id {kind}", *(f"{c} {t}" for c, t in columns.items())])))


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
