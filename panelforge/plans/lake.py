"""Lake, CSV and JSON queries on the order tables; every call writes into a new shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.functions.numbers import to_int
from panelforge.operators import schema as S
from panelforge.operators.cleaning import prepare_for_analysis
from panelforge.operators.history import canonical_columns, clean_values, merge_all, merge_category, union_years, wanted_years
from panelforge.plans import driver_tables as D
from panelforge.session import shared_dir, stage
from panelforge.sources import delimited, lake, reports
from panelforge.sources.discovery import MULTI_YEAR

YEAR = "order_year"
STATUS_CATEGORY = {"F": "graduados", "O": "inscritos", "P": "matriculados"}


def orders_by_year(spark, sf_dir):
    return (D.table(spark, sf_dir, "orders")
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                    F.year("o_orderdate").alias(YEAR), F.lit("orders").alias("_category")))


def _categories(df):
    """The orders as one table per status."""
    return {c: df.filter(F.col("o_orderstatus") == s) for s, c in STATUS_CATEGORY.items()}


def lake_roundtrip(spark, sf_dir):
    root = shared_dir(spark, "lake")
    lake.write_category(orders_by_year(spark, sf_dir), root, "orders", year=YEAR)
    return lake.read_category(spark, root, "orders", year=YEAR)


def lake_year_filter(spark, sf_dir):
    root = shared_dir(spark, "lake")
    lake.write_category(orders_by_year(spark, sf_dir), root, "orders", year=YEAR)
    kept = lake.read_category(spark, root, "orders", [1996, 1999], year=YEAR)
    return kept.select("o_orderkey", "o_totalprice", YEAR)


def lake_write_report(spark, sf_dir):
    """What the writes observed, one row per category."""
    done = lake.write_all(_categories(orders_by_year(spark, sf_dir)), shared_dir(spark, "lake"), year=YEAR)
    return (spark.createDataFrame(done, "category string, status string, n_rows bigint, n_years int")
            .select("category", "status", "n_rows", "n_years"))


def lake_integrity(spark, sf_dir):
    root = shared_dir(spark, "lake")
    lake.write_all(_categories(orders_by_year(spark, sf_dir)), root, year=YEAR)
    return lake.integrity_report(spark, root, year=YEAR)


def lake_multi_read(spark, sf_dir):
    """All categories the lake holds, read for two years; a category without a folder is skipped."""
    root = shared_dir(spark, "lake")
    lake.write_all(_categories(orders_by_year(spark, sf_dir)), root, year=YEAR)
    wanted = [*lake.list_categories(spark, root), "docentes"]
    tables = lake.read_all(spark, root, wanted, [1997, 1998], year=YEAR)
    return (union_years(t.withColumn("category", F.lit(c)) for c, t in tables.items())
            .groupBy("category", YEAR).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top_price")))


def lake_append_idempotent(spark, sf_dir):
    """Load all but the last year, put it in twice by replacing: the lake holds it once."""
    root, orders = shared_dir(spark, "lake"), orders_by_year(spark, sf_dir)
    lake.write_category(orders.filter(F.col(YEAR) < 2001), root, "orders", year=YEAR)
    for _ in range(2):
        lake.write_category(orders, root, "orders", mode="replace_years", year=YEAR, years=[2001])
    return (lake.read_category(spark, root, "orders", year=YEAR).groupBy(YEAR)
            .agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_orders")))


def lake_append_adds(spark, sf_dir):
    """A year delivered in two parts, each appended: the lake holds both."""
    root, orders = shared_dir(spark, "lake"), orders_by_year(spark, sf_dir)
    for part in range(2):
        lake.write_category(orders.filter(F.col("o_orderkey") % 2 == part), root, "orders", mode="append", year=YEAR)
    return (lake.read_category(spark, root, "orders", year=YEAR).groupBy(YEAR)
            .agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_orders")))


def load_report(spark, sf_dir):
    """What became of three files of each category: one good, one pivoted or good, one unreadable."""
    orders, root = D.table(spark, sf_dir, "orders"), shared_dir(spark, "prepared")
    files = {}
    for status, category in STATUS_CATEGORY.items():
        mine, files[category] = orders.filter(F.col("o_orderstatus") == status), []
        for name in ("2013", "2018", "2020"):
            path = f"{root}/{category}/year={name}"
            if name == "2020":  # no table: text where Parquet is expected
                mine.select(F.col("o_orderkey").cast("string")).write.text(path)
            else:
                _dirty_year(mine, category, int(name), 17).write.parquet(path)
            files[category].append((name, path))
    tables, reports = merge_all(spark, files)
    told = spark.createDataFrame([(r["category"], r["year"], r["status"]) for r in reports],
                                 "category string, year string, status string")
    counts = [df.groupBy(F.lit(c).alias("category"), F.col("_source_year").alias("year")).agg(F.count("*").alias("n_rows"))
              for c, df in tables.items()]
    return told.join(union_years(counts), ["category", "year"], "left").select("category", "year", "status", "n_rows")


def csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "csv")
    delimited.write_csv(D.ratios_panel(spark, sf_dir), path)
    return delimited.read_typed(
        spark, path,
        "entity_id bigint, entity_name string, sector string, character string, department string, year int, "
        "enrolled double, applicants double, admitted double, graduated double, first_year double, staff double, "
        "grad_rate double, retention double, admission double, staff_load double, gap double")


def csv_latin1_positional(spark, sf_dir):
    """An export in Latin-1 with mangled headers, read by position with numbers coerced."""
    path = shared_dir(spark, "latin")
    raw = D.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 10 == 0, "s/d").otherwise(F.col("o_custkey").cast("string")).alias("CËDIGO"),
        F.lit("x").alias("PADRE"),
        F.concat(F.lit("Institución Nº "), F.col("o_custkey")).alias("INSTITUCIËN"),
        F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("METRICA"),
        F.year("o_orderdate").cast("string").alias("AÐO"))
    delimited.write_csv(raw, path, encoding=delimited.LATIN)
    rows = delimited.read_export(spark, path, "TOTAL", positions={0: "COD_IES", 2: "NOMBRE_IES", 99: "ABSENT"})
    return (rows.groupBy("NOMBRE_IES", S.YEAR)
            .agg(F.count("COD_IES").alias("n_codes"), F.count("*").alias("n"),
                 F.count("TOTAL").alias("n_totals"),
                 F.sum(F.col("TOTAL").cast("decimal(18,2)")).cast("double").alias("total"))
            .withColumnRenamed(S.YEAR, "year"))


def report_json(spark, sf_dir):
    path = shared_dir(spark, "json")
    report = orders_by_year(spark, sf_dir).groupBy("o_orderstatus", YEAR).agg(F.count("*").alias("n"))
    reports.write_json(report, path)
    return reports.read_json(spark, path, report.schema)


def union_schema_evolution(spark, sf_dir):
    """Years with different columns: early ones lack the priority, the last has a column of its own."""
    orders = orders_by_year(spark, sf_dir).drop("_category")
    early = orders.filter(F.col(YEAR) < 1998).drop("o_orderpriority")
    late = orders.filter(F.col(YEAR).between(1998, 2000))
    last = orders.filter(F.col(YEAR) > 2000).withColumn("channel", F.concat(F.lit("c"), F.col("o_custkey") % 3))
    return union_years([early, late, last])


def _dirty_year(orders, category, year, shift):
    """Orders as a category's table of one year, under that year's headers; calendar moved by ``shift``."""
    metric = {"graduados": "GRADUADOS", "inscritos": "Inscripciones 2017", "matriculados": "Matriculados 2016"}.get(category, S.metric_of(category))
    key = F.col("o_orderkey")
    columns = [
        F.concat(F.lit(" "), F.col("o_custkey"), F.lit(".0")).alias("Código de \nla Institución"),
        F.when(key % 11 == 0, F.lit("nan")).otherwise(key.cast("string")).alias("CODIGO SNIES DEL PROGRAMA "),
        F.when(key % 5 == 0, F.lit(" NULL ")).otherwise(F.concat(F.lit("Prog\t"), key % 13)).alias("Programa Académico"),
        F.element_at(F.array(*map(F.lit, [" PRIVADO ", "oficial", "Mixto"])), (key % 3 + 1).cast("int")).alias("Sector IES"),
        (key % 4).cast("string").alias("Semestre"),
        F.when(key % 9 == 0, F.lit("x"))
        .otherwise(F.concat(F.format_number(F.col("o_totalprice").cast("bigint"), 0), F.lit(".0"))).alias(metric),
        F.lit("junk").alias("Hombre 2009-2"),
    ]
    if year is None:
        columns.append((F.year("o_orderdate") + shift).cast("string").alias("AÑO*"))
    return orders.select(*columns)


def historical_merge(spark, sf_dir):
    """Dirty yearly tables of three categories through prepared files, cleaning and union by name.

    Each category's first half is one multi-year file, of which graduates keep 2013 to 2017; the
    year 2013 of the others is a pivoted file and left out.
    """
    orders, out = D.table(spark, sf_dir, "orders"), []
    root = shared_dir(spark, "prepared")
    for status, category in STATUS_CATEGORY.items():
        mine = orders.filter(F.col("o_orderstatus") == status)
        parts = {"2001_2017": (None, F.year("o_orderdate") <= 1998), "2018": (2018, F.year("o_orderdate") == 1999),
                 "2013": (2013, F.year("o_orderdate") == 2000), "2019": (2019, F.year("o_orderdate") == 2001)}
        tables = []
        for name, (year, condition) in parts.items():
            path = f"{root}/{category}/year={name}"
            _dirty_year(mine.filter(condition), category, year, 17).write.parquet(path)
            tables.append((name, path))
        merged, _ = merge_category(spark, category, tables)
        merged = merged.withColumnRenamed(S.metric_of(category), "METRIC")
        out.append(merged.select(
            F.col("_category").alias("category"), F.col(S.YEAR).alias("year"), F.col(S.SEMESTER).alias("semester"),
            F.col("SECTOR IES").alias("sector"), F.col("PROGRAMA ACADÉMICO").alias("programme"),
            F.col(S.INSTITUTION_CODE).alias("code"), "METRIC"))
    return (union_years(out).groupBy("category", "year", "semester", "sector", "programme")
            .agg(F.count("*").alias("n"), F.sum("METRIC").alias("total"), F.count_distinct("code").alias("n_codes")))


def multi_year_range(spark, sf_dir):
    """Of the graduates' multi-year file the rows of the years wanted, from a text year."""
    orders = D.table(spark, sf_dir, "orders").withColumns({
        S.YEAR: to_int((F.year("o_orderdate") + 15).cast("string")), "_source_year": F.lit(MULTI_YEAR)})
    return wanted_years(orders, "graduados").select("o_orderkey", F.col(S.YEAR).alias("year"), "o_totalprice")


def exported_cleaned(spark, sf_dir):
    """The six categories cleaned for analysis, exported as CSV with byte order marks and read again."""
    orders, root = D.table(spark, sf_dir, "orders"), shared_dir(spark, "cleaned")
    tables = {}
    for i, category in enumerate(sorted(S.METRICS)):
        raw = _dirty_year(orders.filter(F.col("o_orderkey") % len(S.METRICS) == i), category, None, 17)
        tables[category] = stage(canonical_columns(raw, category).transform(clean_values, category), "canonical").transform(
            prepare_for_analysis, category)
    delimited.export_tables(tables, root, bom=True)
    out = []
    for category in tables:
        read = spark.read.option("header", True).option("escape", '"').csv(f"{root}/{category}")
        out.append(read.agg(F.lit(category).alias("category"), F.lit("|".join(read.columns)).alias("columns"), F.count("*").alias("n"),
                            F.sum(F.col(S.metric_of(category)).cast("bigint")).alias("total"), F.count_distinct(S.YEAR).alias("n_years"),
                            F.count_if(F.col("SECTOR IES").isNull()).alias("n_without_sector")))
    return union_years(out)


def queries() -> dict:
    return {
        "lake_roundtrip": lake_roundtrip,
        "lake_year_filter": lake_year_filter,
        "lake_write_report": lake_write_report,
        "lake_integrity": lake_integrity,
        "lake_multi_read": lake_multi_read,
        "lake_append_idempotent": lake_append_idempotent,
        "lake_append_adds": lake_append_adds,
        "load_report": load_report,
        "csv_roundtrip": csv_roundtrip,
        "csv_latin1_positional": csv_latin1_positional,
        "report_json": report_json,
        "union_schema_evolution": union_schema_evolution,
        "historical_merge": historical_merge,
        "multi_year_range": multi_year_range,
        "exported_cleaned": exported_cleaned,
    }
