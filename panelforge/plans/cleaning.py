"""Cleaning and profiling queries; dirt is derived from the tables' own values."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.numbers import one_of, to_double, to_int, to_metric, within
from panelforge.functions.text import clean_code, map_category, normalise_text, short_label
from panelforge.operators import cleaning as C
from panelforge.operators import profiling as P
from panelforge.operators import schema as S
from panelforge.plans import driver_tables as D
from panelforge.sources.delimited import rename_by_position, select_available
from panelforge.sources.grids import promote_header
from panelforge.session import shared_dir

PRIORITY_MAP = {"1-urgent": "Urgent", "2-high": "High", "3-medium": "Medium", "5-low": "Low"}


def text_normalise(spark, sf_dir):
    """Whole texts, and sources in six dirty spellings."""
    source, turn = F.col("source"), F.col("doc_id") % 6
    dirty = (F.when(turn == 0, F.lit(" NaN ")).when(turn == 1, F.lit("none"))
             .when(turn == 2, F.concat(F.lit("  "), source, F.lit("\t")))
             .when(turn == 3, F.concat(source, F.lit("\nb\rc "))).when(turn == 4, F.lit("nan\n")).otherwise(F.lit("\n")))
    return (D.table(spark, sf_dir, "documents")
            .select("doc_id", normalise_text(dirty).alias("source_text"),
                    F.md5(F.encode(normalise_text("text"), "UTF-8")).alias("text_md5")))


def _priority():
    p, turn = F.col("o_orderpriority"), F.col("o_orderkey") % 4
    return (F.when(turn == 0, F.concat(F.lit("  "), p)).when(turn == 1, F.lower(p))
            .when(turn == 2, F.concat(p, F.lit(" \t"))).otherwise(F.lit("None")))


def categorical_map(spark, sf_dir):
    return D.table(spark, sf_dir, "orders").select(
        "o_orderkey", map_category(_priority(), PRIORITY_MAP).alias("priority"))


def categorical_map_upper(spark, sf_dir):
    return D.table(spark, sf_dir, "orders").select(
        "o_orderkey", map_category(_priority(), PRIORITY_MAP, "upper").alias("priority"))


def cast_numeric(spark, sf_dir):
    """Years, semesters and metrics as texts with decimals, separators and rubbish."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("bigint")
    year = F.year("o_orderdate").cast("string")
    return D.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        to_int(F.when(key % 3 == 0, F.concat(year, F.lit(".0"))).when(key % 3 == 1, F.concat(F.lit(" "), year))
               .otherwise(F.lit("20x5"))).alias("year"),
        to_metric(F.when(key % 4 == 0, F.format_number(price, 0)).when(key % 4 == 1, F.concat(price, F.lit(".0")))
                  .when(key % 4 == 2, F.regexp_replace(F.format_number(price, 0), ",", ".")).otherwise(F.lit("n/a")))
        .alias("metric"),
        to_double(F.when(key % 5 == 0, F.lit("NaN")).when(key % 5 == 1, F.lit("abc"))
                  .otherwise(F.concat(price, F.lit(".5")))).alias("number"))


def code_cleanup(spark, sf_dir):
    code = F.concat(F.lit(" "), F.col("l_partkey"),
                    F.when(F.col("l_linenumber") % 2 == 0, ".0").otherwise(".05"), F.lit(" "))
    return (D.table(spark, sf_dir, "lineitem").select(clean_code(code).alias("code"))
            .groupBy("code").agg(F.count("*").alias("n")))


def domain_check(spark, sf_dir):
    return D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", one_of("l_linenumber", C.SEMESTERS).alias("semester"),
        within(F.year("l_shipdate") + 14, *C.YEAR_RANGE).alias("year"))


def _holes(spark, sf_dir):
    """Orders with NULLs: every 10th key, every 7th priority, every 4th price, half the clerks."""
    key = F.col("o_orderkey")
    return D.table(spark, sf_dir, "orders").select(
        F.when(key % 10 != 0, F.col("o_custkey")).alias("code"),
        F.when(key % 13 != 0, key).alias("programme"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(key % 4 != 0, F.col("o_totalprice").cast("bigint")).alias("metric"),
        F.when(key % 2 == 0, F.col("o_orderstatus")).alias("clerk"),
        F.year("o_orderdate").alias("year"))


def drop_sparse(spark, sf_dir):
    """The half-empty column goes, the others stay."""
    return C.drop_sparse_columns(_holes(spark, sf_dir))


def _clean_orders(spark, sf_dir):
    return C.apply_null_policy(_holes(spark, sf_dir), "metric", ["code", "programme"], ["priority"])


def analysis_ready(spark, sf_dir):
    """Final clean-up of a canonical table, summed by what it keeps."""
    key = F.col("o_orderkey")
    rows = D.table(spark, sf_dir, "orders").select(
        F.when(key % 6 != 0, F.col("o_orderpriority")).alias("SECTOR IES"),
        F.when(key % 3 == 0, F.lit("Oficial")).alias("IES PADRE"),
        F.when(key % 8 != 0, F.col("o_totalprice").cast("bigint")).alias("INSCRITOS"),
        F.when(key % 9 != 0, F.year("o_orderdate")).alias(S.YEAR),
        F.when(key % 5 != 0, (key % 2 + 1).cast("int")).alias(S.SEMESTER))
    ready = C.prepare_for_analysis(rows, "inscritos")
    return (ready.groupBy(F.col("SECTOR IES").alias("sector"), F.col(S.YEAR).alias("year"), F.col(S.SEMESTER).alias("semester"))
            .agg(F.count("*").alias("n"), F.sum("INSCRITOS").alias("total"))
            .withColumn("n_columns", F.lit(len(ready.columns)).cast("bigint")))


def canonical_align(spark, sf_dir):
    """Alignment: a nullable column is added, an unexpected one follows, metadata ends."""
    rows = D.table(spark, sf_dir, "orders").select(
        F.lit("m").alias("_origin"), "o_totalprice", F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("extra"))
    aligned = S.align(rows, ["code", "parent", "o_totalprice", "required"], {"parent"})
    order = ",".join(aligned.columns)
    return aligned.withColumn("column_order", F.lit(order))


def rename_positions(spark, sf_dir):
    rows = D.table(spark, sf_dir, "nation").join(
        D.table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"))
    named = rename_by_position(rows, {0: "code", 1: "name", -1: "metric", 40: "absent"})
    return select_available(named, ["code", "name", "s_suppkey", "metric", "absent"])


def label_truncate(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select(
        "doc_id", short_label("text", 40).alias("cut40"), short_label("text", 25, ellipsis=True).alias("cut25"))


def null_counts(spark, sf_dir):
    return P.null_counts(_holes(spark, sf_dir))


def null_report(spark, sf_dir):
    return P.null_report(_holes(spark, sf_dir))


def null_report_after(spark, sf_dir):
    return P.null_report(_clean_orders(spark, sf_dir))


def duplicate_profile(spark, sf_dir):
    """Copies among whole documents without their ids."""
    return P.duplicate_profile(D.table(spark, sf_dir, "documents").select("text", "lang"))


def _daily_columns(spark, sf_dir):
    """Event types as the columns that a group's daily table has; every second day lacks one."""
    day = F.dayofmonth("ts")
    return (D.table(spark, sf_dir, "events")
            .select(F.concat(F.lit("g"), F.col("user_id") % 3).alias("category"), day.alias("day"),
                    F.col("event_type").alias("column"))
            .filter(~((F.col("column") == "error") & (F.col("day") % 2 == 0))))


def schema_drift(spark, sf_dir):
    return P.schema_drift(_daily_columns(spark, sf_dir), "category", "day", "column")


def schema_validation(spark, sf_dir):
    return S.validation_report(_daily_columns(spark, sf_dir), ["category", "day"], "column",
                               ["view", "click", "error", "refund", "channel"], ["refund"])


def file_profile(spark, sf_dir):
    """Prepared files in ``<category>/<year>`` folders, whose headers differ: some short, some undecodable."""
    root = shared_dir(spark, "prepared")
    rows = D.table(spark, sf_dir, "orders").withColumns({"category": F.col("o_orderstatus"), "year": F.year("o_orderdate")})
    programme, metric = F.col("o_orderkey").alias("Código SNIES del  programa"), F.col("o_totalprice").alias("inscripciones 2017")
    layouts = {"long": (rows.filter("year % 3 = 0"), [programme, metric, F.col("o_custkey").alias("Cliente")], "UTF-8"),
               "short": (rows.filter("year % 3 = 1"), [F.col("o_orderpriority").alias("Nota, libre"), programme], "UTF-8"),
               "latin": (rows.filter("year % 3 = 2"), [programme, metric], "ISO-8859-1")}
    for name, (some, columns, encoding) in layouts.items():
        (some.select("category", "year", *columns).repartition("category", "year").write.partitionBy("category", "year")
         .option("header", True).option("encoding", encoding).csv(f"{root}/{name}"))
    found = P.file_profiles(spark, root)
    return found.groupBy(
        F.regexp_extract("path", "category=([^/]+)", 1).alias("category"),
        F.regexp_extract("path", r"year=(\d+)", 1).cast("int").alias("year"), "status", F.col("n_cols").cast("bigint").alias("n_cols"),
        F.array_join("columns", "|").alias("columns"), F.array_join("non_canonical", "|").alias("non_canonical"),
    ).agg(F.sum("n_rows").alias("n_rows"))


def status_summary(spark, sf_dir):
    """Outcomes of preparing every document as a sheet of words."""
    sheets = promote_header(D.table(spark, sf_dir, "documents"), " ", keywords=["the", "her", "tion"], whole=["a"], quote=None)
    return P.status_counts(sheets.withColumn("n_records", F.size("records")), ["lang", "status"], "n_records")


def profile_totals(spark, sf_dir):
    """Files in all, good ones and failed ones: a file is a source, failed if it has toxic documents."""
    files = (D.table(spark, sf_dir, "documents").join(D.table(spark, sf_dir, "labels"), "doc_id", "left")
             .groupBy("source").agg(F.coalesce(F.max("toxic"), F.lit(0)).alias("bad")))
    return P.profile_summary(files.withColumn("status", F.when(F.col("bad") > 0, "error").otherwise("ok")))


def queries() -> dict:
    return {
        "text_normalise": text_normalise,
        "categorical_map": categorical_map,
        "categorical_map_upper": categorical_map_upper,
        "cast_numeric": cast_numeric,
        "code_cleanup": code_cleanup,
        "domain_check": domain_check,
        "impute_unknown": lambda s, d: C.impute_unknown(_holes(s, d), ["priority"]),
        "impute_zero": lambda s, d: C.impute_zero(_holes(s, d), "metric"),
        "drop_null_keys": lambda s, d: C.drop_null_keys(_holes(s, d), ["code", "programme", "absent"]),
        "null_policy": _clean_orders,
        "drop_sparse_columns": drop_sparse,
        "analysis_ready": analysis_ready,
        "canonical_align": canonical_align,
        "rename_by_position": rename_positions,
        "label_truncate": label_truncate,
        "null_counts": null_counts,
        "null_report": null_report,
        "null_report_after": null_report_after,
        "duplicate_profile": duplicate_profile,
        "schema_drift": schema_drift,
        "schema_validation": schema_validation,
        "file_profile": file_profile,
        "status_summary": status_summary,
        "profile_totals": profile_totals,
    }
