"""The supplier panel over the order tables: entity = supplier, year = year of shipping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.panel import add_lags, add_ratios, add_risk_label
from panelforge.session import stage

TRAIN_YEARS = [1995, 1996, 1997, 1998, 1999]
TEST_YEARS = [2000, 2001]
YEARS = [*TRAIN_YEARS, *TEST_YEARS]
RECENT = 1999
# Suppliers have far more units per staff member than universities have students.
MAX_LOAD = 1500.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conformed dimension; Spark broadcasts nation and region by their measured size."""
    return (table(spark, sf_dir, "supplier")
            .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("entity_name"),
                    F.col("r_name").alias("sector"),
                    F.when(F.col("s_acctbal") < 0, "overdrawn").otherwise("funded").alias("character"),
                    F.col("n_name").alias("department")))


def is_enrolled():
    return F.col("l_linestatus") == "F"


def is_admitted():
    return is_enrolled() | (F.col("l_returnflag") == "R")


def is_graduated():
    return is_enrolled() & (F.col("l_returnflag") == "A")


def is_staff():
    return (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.10)


def units(condition=None):
    quantity = F.col("l_quantity")
    total = F.sum(quantity if condition is None else F.when(condition, quantity))
    return F.coalesce(total, F.lit(0.0))


def supplier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six facts from one scan of lineitem, summed before the dimension is joined.

    A supplier with a third of the rows shrinks to its years and parts before anything moves.
    """
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("entity_id"), F.year("l_shipdate").alias("year"))
            .agg(F.count_if(is_enrolled()).alias("enrolled_rows"),
                 units(is_enrolled()).alias("enrolled"),
                 units().alias("applicants"),
                 units(is_admitted()).alias("admitted"),
                 units(is_graduated()).alias("graduated"),
                 units(is_enrolled() & (F.col("l_linenumber") == 1)).alias("first_year"),
                 F.count_distinct(F.when(is_staff(), F.col("l_partkey"))).cast("double").alias("staff"))
            .filter("enrolled_rows > 0").drop("enrolled_rows"))


def metrics_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (supplier_metrics(spark, sf_dir).join(suppliers(spark, sf_dir), "entity_id")
            .select("entity_id", "entity_name", "sector", "character", "department", "year",
                    "enrolled", "applicants", "admitted", "graduated", "first_year", "staff"))


def ratios_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_panel(spark, sf_dir).transform(add_ratios)


def staged_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read the panel twice: the facts are scanned once."""
    return stage(ratios_panel(spark, sf_dir), "ratios")


def lagged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratios_panel(spark, sf_dir).transform(add_lags)


def staged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lagged panel written once: thresholds and label read it instead of rescanning the facts."""
    return stage(lagged_panel(spark, sf_dir), "panel")


def labelled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_panel(spark, sf_dir).transform(add_risk_label)
