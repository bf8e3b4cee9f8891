"""CSV sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelforge.functions.numbers import to_double
from panelforge.operators import schema as S

# Positions of the shared columns in the cleaned exports.
EXPORT_POSITIONS = {
    0: "COD_IES", 2: "NOMBRE_IES", 3: "TIPO_IES", 4: "ID_SECTOR_IES", 5: "SECTOR_IES",
    6: "ID_CARACTER_IES", 7: "CARACTER_IES", 8: "PRINCIPAL_SECCIONAL", 9: "COD_DEPTO_IES",
    10: "DEPTO_IES", 11: "COD_MUNICIPIO_IES", 12: "MUNICIPIO_IES",
}
AREA_POSITION = {22: "AREA_CONOCIMIENTO"}
LATIN = "ISO-8859-1"


def read_text_table(spark: SparkSession, path: str, header: bool = True, encoding: str = "UTF-8",
                    separator: str = ",") -> DataFrame:
    """A CSV with all columns as text: no inference pass over the data."""
    return _text_options(spark.read, header, encoding, separator).csv(path)


def _text_options(reader: DataFrameReader, header: bool = True, encoding: str = "UTF-8", separator: str = ",") -> DataFrameReader:
    return (reader.option("header", header).option("encoding", encoding).option("sep", separator)
            .option("quote", '"').option("escape", '"').option("multiLine", "false"))


def read_typed(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return (spark.read.schema(schema).option("header", header).option("escape", '"')
            .option("enforceSchema", "true").csv(path))


def rename_by_position(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Rename by index; negative indices count from the end, missing ones are skipped."""
    n = len(df.columns)
    at = {(i if i >= 0 else n + i): name for i, name in names.items() if -n <= i < n}
    return df.toDF(*[at.get(i, c) for i, c in enumerate(df.columns)])


def select_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def read_export(spark: SparkSession, path: str, metric: str, metric_at: int = -2, year: str = S.YEAR,
                positions: Mapping[int, str] = EXPORT_POSITIONS, entity: str = "COD_IES",
                encoding: str = LATIN) -> DataFrame:
    """A cleaned export whose headers may be mangled: names by position, numbers coerced."""
    raw = read_text_table(spark, path, encoding=encoding)
    named = rename_by_position(raw, {**positions, -1: year, metric_at: metric})
    return named.withColumns({c: to_double(c) for c in (metric, year, entity)})


def with_source(df: DataFrame, category: str, year: Column) -> DataFrame:
    """The category and the file's year as metadata; the year becomes a column if no header resolves to it."""
    if S.YEAR not in {S.resolve(c, category) for c in df.columns}:
        df = df.withColumn(S.YEAR, year)
    return df.withColumns({"_category": F.lit(category), "_source_year": year})


def read_prepared(spark: SparkSession, path: str | Sequence[str], category: str, year: str | int | Mapping[str, str],
                  file_format: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """Prepared tables of texts that share a layout, in one scan.

    Parquet by default, as it keeps headers with line breaks and stays splittable. ``year`` is that of all files, or
    a mapping from each file (as Spark lists it) to its own, joined by the file that a row comes from.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = _text_options(spark.read) if file_format == "csv" else spark.read
    df = (reader.schema(schema) if schema is not None else reader).format(file_format).load(paths)
    if not isinstance(year, Mapping):
        return with_source(df, category, F.lit(str(year)))
    years = spark.createDataFrame([(unquote(f), y) for f, y in year.items()], "_file string, _year string")
    here = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    rows = df.withColumn("_file", here).join(years, "_file", "left").withColumn(
        "_year", F.coalesce("_year", F.raise_error(F.concat(F.lit("a file without a year: "), "_file")).cast("string")))
    return with_source(rows, category, F.col("_year")).drop("_file", "_year")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8", bom: bool = False) -> None:
    """A folder of CSV parts, written by the executors; with ``bom`` each begins with a byte order mark."""
    if bom and df.columns:
        df = df.toDF("\ufeff" + df.columns[0], *df.columns[1:])
    df.write.mode(mode).option("header", True).option("escape", '"').option("encoding", encoding).csv(path)


def export_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite", bom: bool = False) -> list[str]:
    """A CSV folder for each table, such as the six cleaned ones or the outputs of the models; the paths written."""
    paths = {name: f"{root}/{name}" for name in tables}
    for name, df in tables.items():
        write_csv(df, paths[name], mode, bom=bom)
    return list(paths.values())
