"""Null, duplicate and schema-drift profiles as report frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from panelforge.functions.text import literal_map
from panelforge.operators import schema as S
from panelforge.sources import grids, split_sheets


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def null_report(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct) for columns with NULLs, most first; one pass over ``df``."""
    counts = df.agg(
        F.count("*").alias("_n"),
        F.array(*[F.struct(F.lit(c).alias("column"),
                           F.count_if(F.col(f"`{c}`").isNull()).alias("null_count"))
                  for c in df.columns]).alias("_cols"))
    return (counts.select("_n", F.inline("_cols"))
            .filter("null_count > 0")
            .select("column", "null_count",
                    F.round(F.col("null_count") / F.col("_n") * 100, 2).alias("null_pct"))
            .orderBy(F.desc("null_count"), "column"))


def _short_key(df: DataFrame, column: str) -> Column:
    """A long text stands in by its SHA-256, which no shorter text can equal."""
    c = F.col(f"`{column}`")
    if not isinstance(df.schema[column].dataType, StringType):
        return c
    return F.when(F.octet_length(c) < 64, c).otherwise(F.sha2(F.encode(c, "UTF-8"), 256))


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows.

    Copies collapse before the shuffle, and long texts travel as digests, so whole texts are read
    but never moved.
    """
    return (df.groupBy(*[_short_key(df, c).alias(f"_{i}") for i, c in enumerate(df.columns)])
            .agg(F.count("*").alias("_copies"))
            .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
                 F.count("*").alias("distinct_rows"))
            .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows")))


def schema_drift(observed: DataFrame, category: str, year: str, column: str) -> DataFrame:
    """Which columns a category has in all of its years and which in some, with those years.

    ``observed`` holds a row per (category, year, column name), repeats allowed. Both aggregations
    hold at most one entry per year of the calendar.
    """
    seen = observed.select(category, year, column).distinct()
    per_column = seen.groupBy(category, column).agg(F.sort_array(F.collect_set(year)).alias("_years"))
    totals = (seen.groupBy(category)
              .agg(F.count_distinct(year).alias("n_years"), F.count_distinct(column).alias("n_columns")))
    return (per_column.join(totals, category)
            .select(category, column,
                    (F.size("_years") == F.col("n_years")).alias("in_all_years"),
                    F.array_join(F.transform("_years", lambda y: y.cast("string")), ",").alias("years"),
                    "n_years", "n_columns"))


def status_counts(results: DataFrame, group: Sequence[str] = ("status",), rows: str | None = None) -> DataFrame:
    """Files (and rows) per outcome."""
    extra = [F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("total_rows")] if rows else []
    return results.groupBy(*group).agg(F.count("*").alias("n_files"), *extra)


def profile_summary(results: DataFrame, status: str = "status") -> DataFrame:
    return results.agg(F.count("*").alias("files_total"),
                       F.count_if(F.col(status) == "ok").alias("files_ok"),
                       F.count_if(F.col(status) == "error").alias("files_error"))


def file_profiles(spark: SparkSession, root: str, separator: str = ",", encoding: str = "UTF-8",
                  suffix: str = "csv") -> DataFrame:
    """(path, status, n_rows, n_cols, columns, non_canonical) of every delimited file below ``root``.

    Each file is taken by its own header, its first line, in which quoted cells may hold line breaks. Large files
    are read by several tasks, and a count and that line are all that is gathered of a file. ``columns`` are
    canonical names, ``non_canonical`` headers that no schema knows. ``status`` is ``error`` where the header can't be
    decoded, ``empty`` where it is blank, else ``ok``; rows of both failures are counted too. Rows are records, so one
    whose cells hold line breaks counts once; blank lines are no rows.
    """
    lines = split_sheets.read_lines(spark, root, separator, encoding, suffix)
    first = F.min_by("line", F.struct(*split_sheets.PLACE))
    files = lines.groupBy(*split_sheets.KEY).agg(first.alias("head"), F.count_if(F.col("line").rlike(r"[^\s\ufdd1\ufdd2]")).alias("n"))
    blank, broken = ~F.col("head").rlike(r"\S"), F.col("head").contains("\ufffd")
    named = files.select(
        F.concat_ws("/", *split_sheets.KEY).alias("path"), F.when(blank, "empty").when(broken, "error").otherwise("ok").alias("status"),
        F.when(blank, F.col("n")).otherwise(F.col("n") - 1).alias("n_rows"),
        F.when(blank | broken, F.array().cast("array<string>")).otherwise(grids.cells_of(F.col("head"), separator)).alias("names"))
    known = literal_map(S.ALIASES)
    odd = F.filter("names", lambda c: F.try_element_at(known, S.header_key_col(c)).isNull())
    return named.select("path", "status", "n_rows", F.size("names").alias("n_cols"),
                        F.transform("names", lambda c: S.resolve_col(c)).alias("columns"), odd.alias("non_canonical"))
