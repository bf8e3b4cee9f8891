"""From prepared yearly tables to one historical table per category, and into the lake."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators import cleaning as C
from panelforge.operators import schema as S
from panelforge.sources.delimited import read_prepared, read_text_table, with_source
from panelforge.sources.discovery import MULTI_YEAR, MULTI_YEAR_RANGE
from panelforge.sources.lake import integrity_report, write_all


#: Whose multi-year file is cut to MULTI_YEAR_RANGE.
MULTI_YEAR_CATEGORY = "graduados"
#: Columns that merging itself adds; no report calls them unexpected.
METADATA = {"_category", "_source_year"}


def union_years(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column that a year lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def canonical_columns(df: DataFrame, category: str) -> DataFrame:
    """Leftover columns out, names resolved, dots removed, nullable columns added."""
    return (df.transform(S.drop_junk, category).transform(S.rename_to_canonical, category)
            .transform(S.strip_dots).transform(S.add_nullable, category))


def clean_values(df: DataFrame, category: str) -> DataFrame:
    """Values normalised, null policy applied, columns in canonical order."""
    return (df.transform(C.normalise_values, category)
            .transform(C.apply_null_policy, S.metric_of(category)).transform(S.align_to_category, category))


def wanted_years(df: DataFrame, category: str) -> DataFrame:
    """Of the graduates' multi-year file only its chosen years; other categories keep all rows."""
    if S.category_of(category) != MULTI_YEAR_CATEGORY:
        return df
    other = F.col("_source_year") != MULTI_YEAR
    return df.filter(other | F.col(S.YEAR).between(*MULTI_YEAR_RANGE))


def usable_files(category: str, files: Iterable[tuple], columns: Iterable[str]) -> tuple[list[tuple], list[dict]]:
    """The files, (year, ...) tuples that share a header, that give rows, and the report of each; pivoted ones don't."""
    named = {S.resolve(c, category).replace(".", "") for c in columns if not S.is_junk(c, category)}
    told = S.validate(named | {S.YEAR} | {c for c in S.columns_of(category) if c in S.NULLABLE}, category)
    good, reports = [], []
    for file in sorted(files, key=lambda f: str(f[0])):
        report = {"category": category, "year": file[0]}
        if S.is_pivoted(category, file[0]):
            reports.append({**report, "status": "skipped", "reason": "pivoted"})
        else:
            good.append(file)
            reports.append({**report, "status": "processed", **told})
    return good, reports


def named_table(df: DataFrame, category: str) -> DataFrame:
    """A scan of prepared tables with their ``_source_year``, under canonical names."""
    return canonical_columns(with_source(df, category, F.col("_source_year")), category)


def united(frames: Sequence[DataFrame], category: str) -> DataFrame:
    """Named tables cleaned and united by name.

    Tables with the same columns are united before their values are cleaned, so the plan holds the
    cleaning once per set of columns.
    """
    layouts: dict[frozenset, list[DataFrame]] = {}
    for df in frames:
        layouts.setdefault(frozenset(df.columns), []).append(df)
    return union_years([clean_values(union_years(same), category).transform(wanted_years, category) for same in layouts.values()])


def merge_tables(tables: Sequence[tuple[str, DataFrame]], category: str) -> tuple[DataFrame | None, list[dict]]:
    """Historical table from (year, prepared table) pairs, with a report for each. A pivoted file gives no rows."""
    frames, reports = [], []
    for year, df in tables:
        good, told = usable_files(category, [(year,)], [c for c in df.columns if c not in METADATA])
        reports += told
        if good:
            frames.append(canonical_columns(df, category))
    return (united(frames, category) if frames else None), reports


def _layouts(spark: SparkSession, files: Sequence[tuple[str, str]], file_format: str) -> tuple[dict, list[tuple[str, str]]]:
    """({schema: [(year, path, files)]}, [(year, why it can't be read)]).

    Each file's schema is asked for once, several at a time; only footers or header lines are read.
    """
    def opened(file: tuple[str, str]):
        try:
            df = read_text_table(spark, file[1]) if file_format == "csv" else spark.read.format(file_format).load(file[1])
            return file, df.schema, df.inputFiles(), None
        except Exception as e:  # whatever keeps a file from being read belongs in its report
            return file, None, [], str(e)

    layouts: dict[str, tuple] = {}
    failed = []
    with ThreadPoolExecutor(16) as pool:
        for (year, path), schema, inside, error in pool.map(opened, sorted(files)):
            if error is not None:
                failed.append((year, error))
            else:
                layouts.setdefault(schema.json(), (schema, []))[1].append((year, path, inside))
    return layouts, failed


def merge_category(spark: SparkSession, category: str, files: Sequence[tuple[str, str]],
                   file_format: str = "parquet") -> tuple[DataFrame | None, list[dict]]:
    """Historical table from (year, path) pairs, with a report for each; one that cannot be read is reported, not fatal.

    Files are grouped by their schema, and each group is one scan over all its paths, with the year joined by file.
    """
    layouts, failed = _layouts(spark, files, file_format)
    reports = [{"category": category, "year": year, "status": "error", "reason": why} for year, why in failed]
    frames = []
    for schema, same in layouts.values():
        good, told = usable_files(category, same, schema.names)
        reports += told
        if good:
            year_of = {f: str(year) for year, _, inside in good for f in inside}
            years = set(year_of.values())
            rows = read_prepared(spark, [path for _, path, _ in good], category, year_of if len(years) > 1 else good[0][0], file_format, schema)
            frames.append(canonical_columns(rows, category))
    return (united(frames, category) if frames else None), sorted(reports, key=lambda r: str(r["year"]))


def merge_all(spark: SparkSession, files: Mapping[str, Sequence[tuple[str, str]]]) -> tuple[dict[str, DataFrame], list[dict]]:
    """The table of each category that has one, and the report of every file."""
    tables, reports = {}, []
    for category, fs in files.items():
        df, told = merge_category(spark, category, fs)
        reports += told
        if df is not None:
            tables[category] = df
    return tables, reports


def load_lake(spark: SparkSession, files: Mapping[str, Sequence[tuple[str, str]]], root: str,
              mode: str = "overwrite", years: Sequence[int] | None = None
              ) -> tuple[list[dict], DataFrame, list[dict]]:
    """Prepared files to a verified lake: clean, merge and write.

    Returns what was written, what the lake then holds, and for every file whether it was processed,
    skipped or failed, with the reason; a file that cannot be read is never passed over in silence.
    """
    tables, reports = merge_all(spark, files)
    written = write_all(tables, root, mode, years=years)
    return written, integrity_report(spark, root), reports
