"""The Parquet lake: per category, batches partitioned by year and a log of versions that says which of them count.

    <root>/<category>/batch=<id>/<year>=<y>/part-*.parquet      written once, never changed
    <root>/_versions/category=<c>/version=<n>/part-*.json       one file: the parts that make the version
    <root>/_ranges/category=<c>/batch=<id>/part-*.parquet       least and greatest values per file, where asked for

A version is a single file that is renamed into place when it is complete. A reader takes the highest one, so it sees
a write wholly or not at all, and a write that breaks off leaves only files that no version names. The parts of a
version carry their schema and row counts; readers open the parts of the years they want and merge no footers.
Two writers of one category at a time are not arbitrated: the second to finish fails, as its version is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelforge.operators import schema as S

MODES = ("overwrite", "append", "replace_years")
VERSIONS, RANGES = "_versions", "_ranges"
BATCH = "batch"
_PART = "batch string, year string, n_rows bigint, schema string"
#: How Spark names the folder of rows without a year.
_NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


# --- the log ---


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """(category, version, parts) of all versions of the lake, None before the first."""
    try:
        return spark.read.schema(f"parts array<struct<{_PART}>>, category string, version int").json(f"{root}/{VERSIONS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, root: str, category: str) -> list[int]:
    """Numbers of a category's versions, oldest first."""
    log = _log(spark, root)
    return [] if log is None else sorted(r.version for r in log.where(F.col("category") == category).select("version").collect())


def parts_of(spark: SparkSession, root: str, category: str, version: int | None = None) -> tuple[int, list[dict]]:
    """(version, its parts): the newest version or the one asked for; (0, []) where there is none.

    A part is a year of a batch, so there are as many as years and writes, few enough for the driver.
    """
    log = _log(spark, root)
    if log is None:
        return 0, []
    mine = log.where(F.col("category") == category)
    if version is not None:
        mine = mine.where(F.col("version") == version)
    rows = mine.orderBy(F.desc("version")).limit(1).collect()
    return (rows[0].version, [p.asDict() for p in rows[0].parts or []]) if rows else (0, [])


def _commit(spark: SparkSession, root: str, category: str, version: int, parts: list[dict]) -> None:
    one = spark.createDataFrame([(parts,)], f"parts array<struct<{_PART}>>").coalesce(1)
    path = f"{root}/{VERSIONS}/category={category}/version={version}"
    try:
        one.write.mode("error").json(path)
    except AnalysisException:
        if version in versions(spark, root, category):
            raise
        one.write.mode("overwrite").json(path)  # what a commit that broke off has left


# --- writing ---


def _file_ranges(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str]) -> DataFrame:
    """(file, n_rows, and min_<c>, max_<c> of each column) of a batch."""
    rows = spark.read.schema(schema).parquet(path).select(F.input_file_name().alias("file"), *columns)
    return rows.groupBy("file").agg(F.count("*").alias("n_rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def write_category(df: DataFrame, root: str, category: str, mode: str = "overwrite",
                   year: str = S.YEAR, years: Sequence[int] | None = None, ranges: Sequence[str] = ()) -> dict:
    """Write one category as a new version and report rows and years of what was written.

    ``overwrite`` replaces the category; ``append`` adds rows to what the lake holds; ``replace_years``
    replaces only the years that ``df`` holds, so loading a year twice leaves it once. Rows are
    rebalanced by year before the write: a small year becomes one file, and a year with a third of all
    rows is split over several tasks. Counts are read back from the footers of the new files, so they are those
    of any year, and 0 for an empty table. ``ranges`` names columns whose least and greatest values are kept
    per file, for ``read_category``'s ``between``. Files of earlier versions stay, so those can still be read.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    spark, path = df.sparkSession, f"{root}/{category}"
    if year not in df.columns:
        return {"category": category, "path": path, "status": "error", "n_rows": None,
                "n_years": None, "error": f"no column {year}"}
    rows = S.drop_metadata(df)
    if years is not None:
        rows = rows.filter(F.col(year).isin(list(years)))
    last, held = parts_of(spark, root, category)
    batch = uuid.uuid4().hex
    where = f"{path}/{BATCH}={batch}"
    rows.hint("rebalance", F.col(year)).write.partitionBy(year).parquet(where)
    written = spark.read.schema(rows.schema).parquet(where)
    counts = written.groupBy(F.col(year).cast("string").alias("year")).agg(F.count("*").alias("n")).collect()
    if ranges:
        _file_ranges(spark, where, rows.schema, ranges).write.parquet(f"{root}/{RANGES}/category={category}/{BATCH}={batch}")
    new = [{"batch": batch, "year": r.year, "n_rows": r.n, "schema": rows.schema.json()} for r in counts]
    if not new:  # the schema of an empty table is kept all the same
        new = [{"batch": None, "year": None, "n_rows": 0, "schema": rows.schema.json()}]
    if mode == "overwrite":
        held = []
    elif mode == "replace_years":
        replaced = {r.year for r in counts}
        held = [p for p in held if p["year"] not in replaced or p["batch"] is None]
    _commit(spark, root, category, last + 1, held + new)
    return {"category": category, "path": path, "status": "success", "error": None,
            "n_rows": sum(r.n for r in counts), "n_years": sum(r.year is not None for r in counts)}


def write_all(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite", year: str = S.YEAR,
              years: Sequence[int] | None = None) -> list[dict]:
    return [write_category(df, root, category, mode, year, years) for category, df in tables.items()]


# --- reading ---


def _merged(spark: SparkSession, parts: list[dict]) -> StructType:
    """One schema for all parts, types widened as a union by name does."""
    schemas = [StructType.fromJson(json.loads(s)) for s in dict.fromkeys(p["schema"] for p in parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.createDataFrame([], s) for s in schemas]).schema


def _folder(value: str | None) -> str:
    return _NO_YEAR if value is None else value


def read_category(spark: SparkSession, root: str, category: str, years: Sequence[int] | None = None,
                  year: str = S.YEAR, version: int | None = None,
                  between: Mapping[str, tuple] | None = None) -> DataFrame:
    """One category with the columns of all its years, NULL where a year lacks one.

    Only the folders of the wanted years are opened, with the schema that the log holds. ``between`` gives
    (least, greatest) for columns: rows outside are left out, and so, unopened, is each file whose kept range
    lies outside; files of batches written without ranges are read. ``version`` reads an earlier state.
    """
    _, parts = parts_of(spark, root, category, version)
    if not parts:
        raise FileNotFoundError(f"the lake {root} holds no {category}" + (f" of version {version}" if version else ""))
    schema = _merged(spark, parts)
    wanted = [p for p in parts if p["batch"] is not None and (not years or p["year"] in {str(y) for y in years})]
    if not wanted:
        return spark.createDataFrame([], schema)
    base = f"{root}/{category}"
    paths = [f"{base}/{BATCH}={p['batch']}/{year}={_folder(p['year'])}" for p in wanted]
    outside = [_outside(c, bounds) for c, bounds in (between or {}).items()]
    if outside:
        paths = _opened(spark, root, category, paths, {p["batch"] for p in wanted}, outside)
        if not paths:
            return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    for c, (low, high) in (between or {}).items():
        rows = rows.where(F.col(c).between(low, high))
    # the filter names the years once more, so that partition pruning shows them in the plan
    rows = rows.filter(F.col(year).isin(list(years))) if years else rows
    return rows.select(*schema.names)


def _outside(column: str, bounds: tuple) -> Column:
    return (F.col(f"max_{column}") < bounds[0]) | (F.col(f"min_{column}") > bounds[1]) | F.col(f"min_{column}").isNull()


def _opened(spark: SparkSession, root: str, category: str, paths: list[str], batches: set[str], outside: list) -> list[str]:
    """The folders of batches without ranges, and of the others the files that can hold wanted rows."""
    kept = []
    for batch in sorted(batches):
        mine = [p for p in paths if f"/{BATCH}={batch}/" in p]
        try:
            ranges = spark.read.parquet(f"{root}/{RANGES}/category={category}/{BATCH}={batch}")
            skip = reduce(lambda a, b: a | b, outside)
            fit = ranges.where(~skip).select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"))
            kept += [r.file for r in fit.collect() if any(f"{p.split('//')[-1]}/" in r.file for p in mine)]
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN.WITH_SUGGESTION"):
                raise
            kept += mine
    return kept


def list_categories(spark: SparkSession, root: str) -> list[str]:
    """Categories that the log names."""
    log = _log(spark, root)
    return [] if log is None else sorted(r.category for r in log.select("category").distinct().collect())


def read_all(spark: SparkSession, root: str, categories: Iterable[str] | None = None,
             years: Sequence[int] | None = None, year: str = S.YEAR) -> dict[str, DataFrame]:
    """All (or the named) categories; one that the lake doesn't hold is left out."""
    there = list_categories(spark, root)
    return {c: read_category(spark, root, c, years, year) for c in (there if categories is None else categories) if c in there}


def integrity_report(spark: SparkSession, root: str, categories: Iterable[str] | None = None,
                     year: str = S.YEAR) -> DataFrame:
    """(category, status, n_years, years, total_rows) of what the files really hold, an aggregation per category.

    A category whose files can't be read, or hold other numbers of rows than the log says, has the status ``error``.
    """
    reports = []
    for category in list_categories(spark, root) if categories is None else categories:
        try:
            told = sum(p["n_rows"] for p in parts_of(spark, root, category)[1])
            found = read_category(spark, root, category, year=year).groupBy(year).agg(F.count("*").alias("n")).collect()
        except Exception:  # whatever keeps the files from being read belongs in the report
            told, found = -1, []
        years, total = sorted(r[0] for r in found if r[0] is not None), sum(r.n for r in found)
        reports.append((category, "ok" if total == told else "error", len(years), ",".join(map(str, years)), total))
    return spark.createDataFrame(reports, "category string, status string, n_years bigint, years string, total_rows bigint")
