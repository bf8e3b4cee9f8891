"""Helpers that several operators of this folder share."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Texts longer than this are not drawn into a training sample; they are scored in full all the same.
SAMPLE_CHARS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def hashed(text: str, seed: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), seed)


def fetched(rows: DataFrame, ids: DataFrame) -> list:
    """On the driver, one row (the least) of each of the few ``ids``, in an order that only ids decide.

    Only rows of those ids leave the executors, one for each, however often an id is repeated and
    however many tasks there are.
    """
    others = [c for c in rows.columns if c != "doc_id"]
    one = (rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("r"))
           .select("doc_id", "r.*").collect())
    return sorted(one, key=lambda r: (hashed(str(r.doc_id)), r.doc_id))


def drawn(rows: DataFrame, n: int, each: str | None = None) -> list:
    """At most ``n`` documents drawn by a hash of doc_id, or ``n`` for each value of a column; ids are moved, not texts.

    Tasks keep their own first ``n`` of each value, so no value's ids meet in one task.
    """
    if each is None:
        ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    else:
        order = Window.partitionBy(each).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = (rows.select("doc_id", each).distinct().withColumn("k", F.row_number().over(order)).where(F.col("k") <= n)
               .select("doc_id").distinct())
    return fetched(rows, ids)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, n_folds: int, held_fold: int,
                    per_class: tuple[int, int]) -> list[tuple[str, int]]:
    """At most ``per_class`` texts of labels 0 and 1, outside the held-out fold, for fitting on the driver.

    Rows are drawn by a hash of doc_id, so the draw is the same at every partitioning. Only the ids
    are joined (at most sum(per_class), hence the hint); texts over SAMPLE_CHARS are left out, so the
    sample holds at most sum(per_class) * SAMPLE_CHARS characters. Rows without id or label don't count;
    a document labelled twice takes its smaller label.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("doc_id"), n_folds) != held_fold))
             .groupBy("doc_id").agg(F.min("y").alias("y")))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[y])
        ids = part if ids is None else ids.unionByName(part)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    label_of = {r.doc_id: r.y for r in ids.collect()}
    return [(r.text, label_of[r.doc_id]) for r in fetched(texts, ids.select("doc_id"))]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits (rows x classes) with the least log loss on (logits, y)."""
    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    grid = np.exp(np.linspace(np.log(0.2), np.log(5.0), 41))
    return float(grid[int(np.argmin([loss(t) for t in grid]))]) if len(y) else 1.0


class WordCache(dict):
    """Numbers of words in the order met; each new word is handed to ``learn``. Bounded: see ``trim``."""

    def __init__(self, learn, limit: int = 200_000):
        super().__init__()
        self.learn, self.limit = learn, limit

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.learn(word)
        return n

    def numbers(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def full(self) -> bool:
        return len(self) > self.limit
