"""The registered queries of the operators in this folder, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import (alignment, bpe, decontamination, fertility, language, mixing, paragraphs, passages,
                            personal_data, quality, reading, simhash, toxicity, urls, whitening)
from panelforge.llm.common import fold, table
from panelforge.session import stage


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                        F.col("language.language").alias("lang_pred"), F.col("language.score").alias("score"),
                        F.col("language.accepted").alias("accepted"))


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # every line with a word is sketched and compared, however short
    places, runs = reading.read(docs, least_words=1)
    lines = stage(paragraphs.repeats(docs, least_words=1, found=places), "lines")
    return lines.select("*", F.lit(None).cast("int").alias("first_word"), F.lit(None).cast("int").alias("n_words")).unionByName(
        passages.passages(docs, lines, found=runs))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "filter.host", "filter.path", "filter.rule", "filter.verdict")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.mix(table(spark, sf_dir, "documents"))
    return copies.select("doc_id", "source", "copy_no")


def op5_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = fertility.decide(stage(fertility.measured(docs).drop("text"), "measures"))  # no text is staged
    return judged.select("doc_id", "rules.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.to_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = decontamination.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", *decontamination.digest(F.col("hits")))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs.select("doc_id", "text"), personal_data.train(docs))
    return found.select("doc_id", *personal_data.digest(F.col("personal")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "toxicity.*")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs.select("doc_id", "text"), quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "quality.*")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select("doc_id", F.expr("cast(octet_length(ids) / 4 AS bigint)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text")).documents


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_paragraph_dedup, op3_url_filter, op4_source_mixing, op5_tokeniser_fertility, op6_simhash,
    op7_decontamination, op8_personal_data, op9_toxicity, op10_quality,
    op11_embedding_whitening, op12_bpe_codec, op13_tokenizer_alignment)}

#: Statements for those that SQL can express; the others are tested against brute force and held-out labels.
ORACLES = {"op3_url_filter": urls.ORACLE, "op4_source_mixing": mixing.ORACLE,
           "op7_decontamination": decontamination.ORACLE}
