"""Mixing sources to target weights by Poisson replication, in Spark's built-in functions alone.

Every document is repeated a Poisson number of times whose mean is its source's target rate: the
source's share of the mix over its share of the corpus. Counts come from inverting the distribution
at a uniform number that is a hash of seed and doc_id, so any task computes a document's count alone,
a lost task computes it again alike, and no hot source is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.session import stage

#: A mean above this is drawn as a sum of that many equal parts (sums of Poissons are Poisson).
PART = 16.0
#: The inverse is exact up to where the tail beyond is under 2^-53, the step of the uniform number.
STEPS = 96


def uniform(*parts: Column) -> Column:
    """52 bits of SHA-256 over the parts as a double in [0, 1)."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") / float(2 ** 52)


def cumulative(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson of this mean (at most PART), STEPS terms."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS - 1)),
        F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"), (acc["c"] + acc["p"] * mean / k).alias("c"),
            F.concat(acc["all"], F.array(acc["c"] + acc["p"] * mean / k)).alias("all")),
        lambda acc: acc["all"])
    return terms


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5,
                 size: Column | None = None) -> DataFrame:
    """``source, size, rate, parts, cdf`` of each source; NULL is a source of its own.

    ``size`` is what a document counts (default: characters of its text, at least 1). The mix has the
    corpus's total size. ``weights`` are target shares by source (normalised; a source that isn't
    listed gets none); without them a source's share goes as its size to the ``power``.
    """
    sized = docs.select("source", (F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1))
                                   if size is None else size).cast("double").alias("size"))
    per = sized.groupBy("source").agg(F.sum("size").alias("size"))
    if weights is None:
        per = per.withColumn("share", F.pow("size", F.lit(power)))
    else:
        listed = F.create_map(*(F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1])))) if weights else None
        share = F.coalesce(listed[F.coalesce("source", F.lit(""))], F.lit(0.0)) if weights else F.lit(0.0)
        per = per.withColumn("share", share)
    per = stage(per, "sources")
    all_ = per.agg(F.sum("size").alias("size"), F.sum("share").alias("share")).first()  # two numbers
    rate = (F.col("share") / F.lit(all_["share"]) * F.lit(all_["size"]) / F.col("size") if all_["share"] else F.lit(0.0))
    return (per.withColumn("rate", rate)
            .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int"))
            .withColumn("cdf", cumulative(F.col("rate") / F.col("parts")))
            .select("source", "size", "rate", "parts", "cdf"))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 7) -> DataFrame:
    """Each row of ``docs`` as often as drawn, with ``copy_no`` (from 1) and ``mix_key``, shuffled.

    ``mix_key`` is a hash of seed, doc_id and copy; rows are dealt to partitions by it and sorted by it
    in each, so the order of the whole is a random one that is the same on every run. Rows with the
    same doc_id are drawn alike. A NULL doc_id counts as an empty text; a NULL text as one character.
    Other columns pass through; columns named like the added ones are replaced. An empty table gives
    no rows. Memory: a row at a time; a document is copied after the draw and before one shuffle.
    """
    docs = docs.drop("copy_no", "mix_key")
    picked = rates.select(F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("cdf").alias("__cdf"))
    drawn = docs.join(picked, F.col("source").eqNullSafe(F.col("__source")))
    # one draw for each part of the mean, each with its own uniform number
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")), F.lit(0),
        lambda acc, part: acc + F.size(F.filter(
            F.col("__cdf"), lambda c: c <= uniform(F.lit(seed), F.col("doc_id"), part))))
    return (drawn.withColumn("__n", count).where("__n > 0")
            .withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .withColumn("mix_key", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("copy_no")))
            .drop("__source", "__parts", "__cdf", "__n"))


def shuffled(copies: DataFrame) -> DataFrame:
    """Dealt and sorted by ``mix_key``."""
    parts = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(parts, "mix_key").sortWithinPartitions("mix_key")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, seed: int = 7) -> DataFrame:
    """``docs`` mixed to the target weights: see ``source_rates`` and ``replicate``."""
    return shuffled(replicate(docs, source_rates(docs, weights, power), seed))


ORACLE = f"""
WITH RECURSIVE per AS (
  SELECT source, sum(greatest(coalesce(length(text), 0), 1))::DOUBLE AS size FROM documents GROUP BY source),
rated AS (
  SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM per) * (SELECT sum(size) FROM per) / size AS rate FROM per),
split AS (SELECT source, rate, greatest(1, ceil(rate / {PART}))::INT AS parts FROM rated),
steps AS (
  SELECT source, 0 AS k, exp(-rate / parts) AS p, exp(-rate / parts) AS c, rate / parts AS mean FROM split
  UNION ALL
  SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM steps WHERE k + 1 < {STEPS}),
cdf AS (SELECT source, list(c ORDER BY k) AS cdf FROM steps GROUP BY source),
drawn AS (
  SELECT doc_id, d.source, u.part, cdf,
         ('0x' || substr(sha256('7|' || coalesce(doc_id::VARCHAR, '') || '|' || u.part), 1, 13))::BIGINT::DOUBLE
           / {2 ** 52}.0 AS uni
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source
  JOIN cdf x ON d.source IS NOT DISTINCT FROM x.source, LATERAL (SELECT unnest(range(1, s.parts + 1)) AS part) u),
counted AS (
  SELECT doc_id, source, sum(len(list_filter(cdf, lambda c: c <= uni)))::BIGINT AS n FROM drawn GROUP BY doc_id, source)
SELECT doc_id, source, unnest(range(1, n + 1))::INT AS copy_no FROM counted WHERE n > 0
"""
