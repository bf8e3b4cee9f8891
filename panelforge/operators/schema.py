"""Canonical schemas per fact category and the operators that bring a frame to them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.text import ACCENTED, PLAIN, col_of, literal_map

YEAR = "AÑO"
SEMESTER = "SEMESTRE"
INSTITUTION_CODE = "CÓDIGO DE LA INSTITUCIÓN"
PROGRAMME_CODE = "CÓDIGO SNIES DEL PROGRAMA"

# Canonical column names, in their order.
INSTITUTION = [
    "CÓDIGO DE LA INSTITUCIÓN", "IES PADRE", "INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES)",
    "TIPO IES", "ID SECTOR IES", "SECTOR IES", "ID CARÁCTER IES", "CARÁCTER IES",
    "IES ACREDITADA", "PRINCIPAL O SECCIONAL", "CÓDIGO DEL DEPARTAMENTO (IES)",
    "DEPARTAMENTO DE DOMICILIO DE LA IES", "CÓDIGO DEL MUNICIPIO IES",
    "MUNICIPIO DE DOMICILIO DE LA IES",
]
PROGRAMME = [
    "CÓDIGO SNIES DEL PROGRAMA", "PROGRAMA ACADÉMICO", "PROGRAMA ACREDITADO",
    "ID NIVEL ACADÉMICO", "NIVEL ACADÉMICO", "ID NIVEL DE FORMACIÓN", "NIVEL DE FORMACIÓN",
    "ID MODALIDAD", "MODALIDAD", "ID ÁREA", "ÁREA DE CONOCIMIENTO", "ID NÚCLEO",
    "NÚCLEO BÁSICO DEL CONOCIMIENTO (NBC)", "ID CINE CAMPO AMPLIO", "DESC CINE CAMPO AMPLIO",
    "ID CINE CAMPO ESPECÍFICO", "DESC CINE CAMPO ESPECÍFICO", "ID CINE CAMPO DETALLADO",
    "DESC CINE CAMPO DETALLADO", "CÓDIGO DEL DEPARTAMENTO (PROGRAMA)",
    "DEPARTAMENTO DE OFERTA DEL PROGRAMA", "CÓDIGO DEL MUNICIPIO (PROGRAMA)",
    "MUNICIPIO DE OFERTA DEL PROGRAMA",
]
SEX = ["ID SEXO", "SEXO"]
STAFF = [
    "TIPO DE DOCUMENTO", "ID MÁXIMO NIVEL DE FORMACIÓN DEL DOCENTE",
    "MÁXIMO NIVEL DE FORMACIÓN DEL DOCENTE", "ID TIEMPO DE DEDICACIÓN",
    "TIEMPO DE DEDICACIÓN DEL DOCENTE", "ID TIPO DE CONTRATO", "TIPO DE CONTRATO DEL DOCENTE",
]
TIME = [YEAR, SEMESTER]

# Category and metric column.
METRICS = {
    "admitidos": "ADMITIDOS",
    "inscritos": "INSCRITOS",
    "matriculados": "MATRICULADOS",
    "matriculados_primer_anho": "MATRICULADOS PRIMER CURSO",
    "graduados": "GRADUADOS",
    "docentes": "NUM DE DOCENTES",
}
# The cleaned exports use another name for one category.
CATEGORY_SYNONYMS = {"matriculados_primer_curso": "matriculados_primer_anho"}

# Columns that years may lack.
NULLABLE = frozenset([
    "TIPO IES", "IES ACREDITADA", "PROGRAMA ACREDITADO", "ID SECTOR IES", "ID CARÁCTER IES",
    "ID NIVEL ACADÉMICO", "ID NIVEL DE FORMACIÓN", "ID MODALIDAD", "ID ÁREA", "ID NÚCLEO",
    "ID SEXO", "PRINCIPAL O SECCIONAL", "IES PADRE", "CÓDIGO DEL DEPARTAMENTO (IES)",
    "CÓDIGO DEL MUNICIPIO IES", "CÓDIGO DEL DEPARTAMENTO (PROGRAMA)",
    "CÓDIGO DEL MUNICIPIO (PROGRAMA)", "ID CINE CAMPO AMPLIO", "DESC CINE CAMPO AMPLIO",
    "ID CINE CAMPO ESPECÍFICO", "DESC CINE CAMPO ESPECÍFICO", "ID CINE CAMPO DETALLADO",
    "DESC CINE CAMPO DETALLADO", "ID MÁXIMO NIVEL DE FORMACIÓN DEL DOCENTE",
    "ID TIEMPO DE DEDICACIÓN", "ID TIPO DE CONTRATO", "TIPO DE DOCUMENTO",
    "CAPITAL O MUNICIPIO", "NIVEL CINE",
])

# Files laid out as pivots, which the load leaves out.
PIVOTED = frozenset([
    ("admitidos", "2013"), ("inscritos", "2013"), ("matriculados", "2013"),
    ("matriculados_primer_anho", "2013"), ("docentes", "2013"),
])

# Headers of leftover pivot columns.
JUNK_HEADERS = (r"^Hombre \d{4}", r"^Mujer \d{4}", r"^Total \d{4}", r"^Admisiones \d{4}")

# Historical headers, by the canonical column they stand for. A canonical name also
# answers to its own folded form, so those are not listed.
VARIANTS = {
    "IES PADRE": ["ies_padre"],
    "SECTOR IES": ["ies sector ies"],
    "ID SECTOR IES": ["id_sector", "id sector"],
    "ID CARÁCTER IES": ["id_caracter", "id caracter"],
    "CÓDIGO DEL DEPARTAMENTO (IES)": ["codigo del departamento"],
    "CÓDIGO DEL MUNICIPIO IES": ["codigo del municipio (ies)", "codigo del municipio"],
    "ID NIVEL ACADÉMICO": ["id_nivel"],
    "ID NIVEL DE FORMACIÓN": ["id_nivel_formacion"],
    "ID MODALIDAD": ["id_metodologia", "id metodologia"],
    "MODALIDAD": ["metodologia del programa", "metodologia"],
    "ID ÁREA": ["id_area", "id area de conocimiento"],
    "ID NÚCLEO": ["id_nucleo"],
    "NÚCLEO BÁSICO DEL CONOCIMIENTO (NBC)": ["nucleo basico del conocimiento"],
    "ID CINE CAMPO AMPLIO": ["id cine campo amplio desc"],
    "DESC CINE CAMPO AMPLIO": ["cine campo amplio"],
    "ID CINE CAMPO DETALLADO": ["id cine codigo detallado"],
    "DESC CINE CAMPO DETALLADO": ["desc cine codigo detallado"],
    "CÓDIGO DEL MUNICIPIO (PROGRAMA)": ["cdigo del municipio (programa)"],
    "ID SEXO": ["id_genero", "id genero"],
    "SEXO": ["genero", "genero del docente", "sexo del docente"],
    "AÑO": ["año*", "a±o*"],
    "ADMITIDOS": ["admitidos 2014", "admitdos 2015", "admitdos 2016", "admisiones 2017", "admisiones 2018"],
    "INSCRITOS": ["inscritos 2014", "primer_curso 2015", "inscritos 2016",
                  "inscripciones 2017", "inscripciones 2018"],
    "MATRICULADOS": ["matriculados 2014", "matriculados 2015", "matriculados 2016",
                     "matriculados 2017", "matriculados 2018"],
    "MATRICULADOS PRIMER CURSO": ["primer curso 2014", "inscritos 2015", "primer curso 2016",
                                  "primer curso 2017", "primer curso 2018", "primer curso 2019",
                                  "primer curso"],
    "NUM DE DOCENTES": ["no. de docentes", "docentes"],
    "ID MÁXIMO NIVEL DE FORMACIÓN DEL DOCENTE": ["id maximo_nivel"],
    "TIEMPO DE DEDICACIÓN DEL DOCENTE": ["tiempo de dedicacion del docente1",
                                         "tiempo de dedicacion del docente 1"],
    "TIEMPO DE DEDICACIÓN DEL DOCENTE 1": ["tiempo de dedicacion del docente.1"],
    "TIEMPO DE DEDICACIÓN DEL DOCENTE 3": ["tiempo de dedicacion del docente.2"],
    "TIEMPO DE DEDICACIÓN DEL DOCENTE 4": ["tiempo de dedicacion del docente.3"],
    "ID TIEMPO DE DEDICACIÓN": ["id dedicacion"],
    "TIPO DE CONTRATO DEL DOCENTE": ["tipo de contrato"],
    "ID TIPO DE CONTRATO": ["id tipo_contrato"],
}

# Two headers of 2015 were swapped between files, so they mean the file's own metric there.
SCOPED_VARIANTS = {
    ("inscritos", "inscritos 2015"): "INSCRITOS",
    ("matriculados_primer_anho", "primer_curso 2015"): "MATRICULADOS PRIMER CURSO",
}


def header_key(name: str) -> str:
    """Comparison key of a header: lower case, single spaces, without the six accents."""
    text = re.sub(r"\s+", " ", str(name or "").strip().lower())
    return text.translate(str.maketrans(ACCENTED, PLAIN))


def header_key_col(c: str | Column) -> Column:
    """``header_key`` over a column of headers."""
    text = F.regexp_replace(F.regexp_replace(col_of(c), r"^\s+|\s+$", ""), r"\s+", " ")
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def _alias_map() -> dict[str, str]:
    own = [*INSTITUTION, *PROGRAMME, *SEX, *TIME, *STAFF, "CAPITAL O MUNICIPIO", "NIVEL CINE",
           *(m for m in METRICS.values() if m != "NUM DE DOCENTES")]
    aliases = {header_key(name): name for name in own}
    for canonical, headers in VARIANTS.items():
        aliases.update({header_key(h): canonical for h in headers})
    return aliases


ALIASES = _alias_map()


def category_of(name: str) -> str:
    category = CATEGORY_SYNONYMS.get(name, name)
    if category not in METRICS:
        raise KeyError(f"unknown category: {name!r}")
    return category


def metric_of(category: str) -> str:
    return METRICS[category_of(category)]


def columns_of(category: str) -> list[str]:
    category = category_of(category)
    middle = [*SEX, *STAFF] if category == "docentes" else [*PROGRAMME, *SEX]
    return [*INSTITUTION, *middle, *TIME, METRICS[category]]


def is_pivoted(category: str, year: str | int) -> bool:
    return (CATEGORY_SYNONYMS.get(category, category), str(year)) in PIVOTED


def resolve(header: str, category: str | None = None) -> str:
    """Canonical name of a header; an unknown header is kept, stripped."""
    key = header_key(header)
    scoped = SCOPED_VARIANTS.get((CATEGORY_SYNONYMS.get(category, category), key))
    return scoped or ALIASES.get(key) or str(header).strip()


def resolve_col(c: str | Column) -> Column:
    """``resolve`` over a column of headers: one literal map, no join."""
    stripped = F.regexp_replace(col_of(c), r"^\s+|\s+$", "")
    return F.coalesce(F.try_element_at(literal_map(ALIASES), header_key_col(c)), stripped)


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def rename_to_canonical(df: DataFrame, category: str | None = None) -> DataFrame:
    """Rename every column in one projection; headers that share a name are coalesced in order."""
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(resolve(c, category), []).append(c)
    return df.select(*[
        (F.coalesce(*map(_quoted, cs)) if len(cs) > 1 else _quoted(cs[0])).alias(name)
        for name, cs in sources.items()
    ])


def is_junk(header: str, category: str | None = None) -> bool:
    """A leftover pivot column, unless it resolves to the category's own metric."""
    if category and resolve(header, category) == metric_of(category):
        return False
    return any(re.match(p, header.strip()) for p in JUNK_HEADERS)


def drop_junk(df: DataFrame, category: str | None = None) -> DataFrame:
    return df.select(*[_quoted(c) for c in df.columns if not is_junk(c, category)])


def strip_dots(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "") for c in df.columns])


def drop_metadata(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def add_nullable(df: DataFrame, category: str) -> DataFrame:
    missing = [c for c in columns_of(category) if c in NULLABLE and c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def align(df: DataFrame, expected: Sequence[str], nullable: Iterable[str] = NULLABLE) -> DataFrame:
    """Expected order first (absent nullable columns as NULL), then unexpected ones, then metadata."""
    nullable, present = set(nullable), set(df.columns)
    head = [_quoted(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in expected if c in present or c in nullable]
    extra = [c for c in df.columns if c not in set(expected)]
    tail = sorted(extra, key=lambda c: c.startswith("_"))
    return df.select(*head, *map(_quoted, tail))


def align_to_category(df: DataFrame, category: str) -> DataFrame:
    return align(df, columns_of(category))


def validate(columns: Iterable[str], category: str) -> dict:
    """Differences from the canonical schema; the caller decides what to do with them."""
    present, expected = set(columns), set(columns_of(category))
    missing = expected - present
    required = sorted(missing - NULLABLE)
    return {
        "category": category,
        "valid": not required,
        "missing_required": required,
        "missing_nullable": sorted(missing & NULLABLE),
        "unexpected": sorted(present - expected),
    }


def validation_report(observed: DataFrame, table_cols: Sequence[str], column: str,
                      expected: Sequence[str], nullable: Iterable[str]) -> DataFrame:
    """``validate`` for many tables at once, from one row per (table, column name).

    Names repeat per file and are collapsed before the shuffle; a table's set of names is as wide
    as a table, never as long.
    """
    required = [c for c in expected if c not in set(nullable)]
    optional = [c for c in expected if c in set(nullable)]
    names = F.collect_set(column)

    def lits(values):
        return F.array(*map(F.lit, values)).cast("array<string>")

    def joined(a):
        return F.array_join(F.array_sort(a), ",")

    seen = observed.groupBy(*table_cols).agg(names.alias("_names"))
    return seen.select(
        *table_cols,
        (F.size(F.array_except(lits(required), "_names")) == 0).alias("valid"),
        joined(F.array_except(lits(required), "_names")).alias("missing_required"),
        joined(F.array_except(lits(optional), "_names")).alias("missing_nullable"),
        joined(F.array_except("_names", lits(expected))).alias("unexpected"),
    )
