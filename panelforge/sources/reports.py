"""JSON sink of report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
