"""Canonical names, alignment and the whole clean-up of a table."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelforge.operators import cleaning as C
from panelforge.operators import history as H
from panelforge.operators import profiling as P
from panelforge.operators import schema as S


def test_schema_sizes():
    assert [len(S.columns_of(c)) for c in S.METRICS] == [42] * 5 + [26]
    assert len(S.NULLABLE) == 29
    assert S.columns_of("matriculados_primer_curso") == S.columns_of("matriculados_primer_anho")
    with pytest.raises(KeyError):
        S.columns_of("otros")


@pytest.mark.parametrize("header, expected", [
    ("Código de \nla Institución", "CÓDIGO DE LA INSTITUCIÓN"),
    ("NO. DE DOCENTES", "NUM DE DOCENTES"),
    ("codigo del\ndepartamento", "CÓDIGO DEL DEPARTAMENTO (IES)"),
    ("id cine campo amplio\tdesc", "ID CINE CAMPO AMPLIO"),
    ("Tiempo de dedicación\ndel docente.2", "TIEMPO DE DEDICACIÓN DEL DOCENTE 3"),
    ("Tiempo de dedicación del docente.1", "TIEMPO DE DEDICACIÓN DEL DOCENTE 1"),
    ("A±O*", "AÑO"), ("año", "AÑO"), ("Admisiones 2018", "ADMITIDOS"),
    ("capital o\nmunicipio", "CAPITAL O MUNICIPIO"),
    ("  Columna rara ", "Columna rara"),
])
def test_resolve(header, expected):
    assert S.resolve(header) == expected


def test_resolve_is_scoped_where_headers_were_swapped():
    assert S.resolve("INSCRITOS 2015") == "MATRICULADOS PRIMER CURSO"
    assert S.resolve("INSCRITOS 2015", "inscritos") == "INSCRITOS"
    assert S.resolve("primer_curso 2015") == "INSCRITOS"
    assert S.resolve("primer_curso 2015", "matriculados_primer_anho") == "MATRICULADOS PRIMER CURSO"


def test_resolve_column_matches_function(spark):
    headers = ["Código de \nla Institución", " x ", "AÑO*", "ID_AREA"]
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    assert [r[0] for r in df.select(S.resolve_col("h")).collect()] == [S.resolve(h) for h in headers]


def test_junk_keeps_own_metric(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Admisiones 2017` int, `Hombre 2009-2` int, `Total 2013-1*` int")
    assert S.drop_junk(df, "admitidos").columns == ["Admisiones 2017"]
    assert S.drop_junk(df).columns == []


def test_duplicate_names_are_coalesced(spark):
    df = spark.createDataFrame([(None, 2, 3), (1, 5, 3)], "sexo int, `género` int, `a.b` int")
    out = S.strip_dots(S.rename_to_canonical(df))
    assert out.columns == ["SEXO", "ab"] and rows(out, "SEXO") == [(1, 3), (2, 3)]


def test_align_and_validate(spark):
    df = spark.createDataFrame([("i", 1, "m", "x")], f"`{S.INSTITUTION_CODE}` string, INSCRITOS int, _category string, extra string")
    out = S.align_to_category(df, "inscritos")
    assert out.columns[:2] == [S.INSTITUTION_CODE, "IES PADRE"] and out.columns[-2:] == ["extra", "_category"]
    assert "SEXO" not in out.columns  # required and absent: reported, not invented
    report = S.validate(["SEXO", "extra"], "docentes")
    assert not report["valid"] and report["unexpected"] == ["extra"] and "ID SEXO" in report["missing_nullable"]
    assert S.validate(S.columns_of("docentes"), "docentes")["valid"]


def test_never_imputed_columns_are_not_imputed():
    assert not set(C.UNKNOWN_COLUMNS) & {S.INSTITUTION_CODE, S.PROGRAMME_CODE, S.YEAR, S.SEMESTER}
    assert {S.YEAR, "ID SEXO"} <= C.NEVER_IMPUTE


def test_sparse_column_limit(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 35, 1).alias("kept"), F.when(F.col("id") >= 36, 1).alias("gone"))
    assert C.columns_to_keep(df) == ["kept"]
    assert C.columns_to_keep(df.limit(0)) == ["kept", "gone"]


def raw_year(spark, data, extra=""):
    return spark.createDataFrame(data, "`Código de la Institución` string, `Código SNIES del programa` string, "
                                       f"Sexo string, Semestre string, Inscritos string{extra}")


def prepared(df, year):
    if "AÑO" not in df.columns:
        df = df.withColumn("AÑO", F.lit(str(year)))
    return df.withColumns({"_category": F.lit("inscritos"), "_source_year": F.lit(str(year))})


def test_merge_tables(spark):
    a = prepared(raw_year(spark, [(" 1.0", "10", "MUJER", "1", "1,200"), ("nan", "11", "f", "1", "5"), ("2", "12", " ", "3", "x")]), 2018)
    b = prepared(raw_year(spark, [("3", "13", "m", "2", "12.0", "Oficial ")], ", `Sector IES` string"), 2019)
    pivoted = prepared(raw_year(spark, [("9", "9", "f", "1", "9")]), 2013)
    multi = prepared(raw_year(spark, [("4", "14", "f", "1", "1", "2012"), ("5", "15", "f", "1", "1", "2014")], ", `AÑO` string"), "2001_2017")
    merged, reports = H.merge_tables([("2018", a), ("2019", b), ("2013", pivoted), ("2001_2017", multi)], "inscritos")
    got = rows(merged.select(F.col(S.INSTITUTION_CODE).alias("c"), "SEXO", S.SEMESTER, S.YEAR, "SECTOR IES", "INSCRITOS"), "c")
    assert got == [
        ("1", "Femenino", 1, 2018, None, 1200),
        ("2", "DESCONOCIDO", None, 2018, None, 0),
        ("3", "Masculino", 2, 2019, "Oficial", 12),
        ("4", "Femenino", 1, None, None, 1), ("5", "Femenino", 1, 2014, None, 1),
    ]
    assert [r["status"] for r in reports] == ["processed", "processed", "skipped", "processed"]


def test_reports(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, None, "b")], "x int, y int, z string")
    assert rows(P.null_report(df)) == [("y", 3, 100.0), ("x", 1, 33.33)]
    assert rows(P.duplicate_profile(df)) == [(3, 2, 1)]
    assert rows(P.duplicate_profile(df.limit(0))) == [(0, 0, 0)]
