"""The corpus pipeline: documents to a decontaminated, redacted, shuffled mix, a written table per stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import decontamination, mixing, personal_data, quality, simhash
from panelforge.llm.common import table
from panelforge.session import stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labels of documents in ``docs``, accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs.withColumnRenamed("quality", "__own") if "quality" in docs.columns else docs,
                            model).where("quality.predicted = 1").drop("quality").withColumnRenamed("__own", "quality")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which under a twentieth of the words is from a benchmark window."""
    columns = docs.columns
    if "hits" in columns:
        docs = docs.withColumnRenamed("hits", "__own")
    clean = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("not hits.contaminated")
    return clean.drop("hits").withColumnRenamed("__own", "hits").select(columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the kind of it in brackets."""
    return personal_data.redact(docs, personal_data.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, with copy_no and mix_key, in random order."""
    return mixing.mix(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("personal_data", redact_personal_data), ("mixing", mix_sources)]

#: The classifier and the tagger are trained models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
