"""Value cleaning and the null policy, each step one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.numbers import one_of, to_int, to_metric, within
from panelforge.functions.text import clean_code, map_category, normalise_text, null_if_token
from panelforge.operators import schema as S

UNKNOWN = "DESCONOCIDO"
YEAR_RANGE = (2013, 2030)
SEMESTERS = (1, 2)
MAX_NULL_SHARE = 0.35

# Category spellings and what they stand for.
SEX_MAP = {
    "f": "Femenino", "m": "Masculino", "femenino": "Femenino", "masculino": "Masculino",
    "mujer": "Femenino", "hombre": "Masculino", "female": "Femenino", "male": "Masculino",
}
SECTOR_MAP = {"oficial": "Oficial", "privado": "Privado", "public": "Oficial", "private": "Privado"}
MODALITY_MAP = {
    "presencial": "Presencial", "distancia": "Distancia", "distancia (tradicional)": "Distancia",
    "virtual": "Virtual", "distancia virtual": "Virtual",
}
LEVEL_MAP = {
    "universitaria": "Universitaria",
    "tecnologica": "Tecnológica", "tecnológica": "Tecnológica",
    "tecnica profesional": "Técnica Profesional", "técnica profesional": "Técnica Profesional",
    "especializacion": "Especialización", "especialización": "Especialización",
    "maestria": "Maestría", "maestría": "Maestría",
    "doctorado": "Doctorado",
    "especializacion tecnica": "Especialización Técnica",
    "especialización técnica": "Especialización Técnica",
}
CATEGORY_MAPS = {"SEXO": SEX_MAP, "SECTOR IES": SECTOR_MAP, "MODALIDAD": MODALITY_MAP,
                 "NIVEL DE FORMACIÓN": LEVEL_MAP}

# Free-text columns that are normalised.
TEXT_COLUMNS = [
    "INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES)", "PROGRAMA ACADÉMICO",
    "DEPARTAMENTO DE DOMICILIO DE LA IES", "MUNICIPIO DE DOMICILIO DE LA IES",
    "DEPARTAMENTO DE OFERTA DEL PROGRAMA", "MUNICIPIO DE OFERTA DEL PROGRAMA",
    "ÁREA DE CONOCIMIENTO", "NÚCLEO BÁSICO DEL CONOCIMIENTO (NBC)", "DESC CINE CAMPO AMPLIO",
    "DESC CINE CAMPO ESPECÍFICO", "DESC CINE CAMPO DETALLADO", "IES PADRE", "TIPO IES",
    "CARÁCTER IES", "NIVEL ACADÉMICO", "NIVEL DE FORMACIÓN",
]
# Dimension texts whose NULL becomes the unknown word.
UNKNOWN_COLUMNS = [
    "INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES)", "SECTOR IES", "CARÁCTER IES",
    "DEPARTAMENTO DE DOMICILIO DE LA IES", "MUNICIPIO DE DOMICILIO DE LA IES",
    "DEPARTAMENTO DE OFERTA DEL PROGRAMA", "MUNICIPIO DE OFERTA DEL PROGRAMA",
    "PROGRAMA ACADÉMICO", "NIVEL ACADÉMICO", "NIVEL DE FORMACIÓN", "MODALIDAD",
    "ÁREA DE CONOCIMIENTO", "NÚCLEO BÁSICO DEL CONOCIMIENTO (NBC)", "SEXO", "TIPO IES",
    "PRINCIPAL O SECCIONAL",
]
KEY_COLUMNS = [S.INSTITUTION_CODE, S.PROGRAMME_CODE]
# Never imputed: a NULL there is information.
NEVER_IMPUTE = S.NULLABLE | {S.INSTITUTION_CODE, S.PROGRAMME_CODE, S.YEAR, S.SEMESTER}


def _present(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: e for c, e in exprs.items() if c in df.columns})


def normalise_texts(df: DataFrame, columns: Iterable[str] = TEXT_COLUMNS) -> DataFrame:
    return _present(df, {c: normalise_text(c) for c in columns})


def standardise_categories(df: DataFrame, maps: Mapping[str, Mapping[str, str]] = CATEGORY_MAPS,
                           unmatched: str = "keep") -> DataFrame:
    return _present(df, {c: map_category(c, m, unmatched) for c, m in maps.items()})


def clean_codes(df: DataFrame, columns: Iterable[str] = KEY_COLUMNS) -> DataFrame:
    """Trim, drop a float tail and read null words as NULL, so that the key filter sees them."""
    return _present(df, {c: null_if_token(clean_code(c)) for c in columns})


def cast_numbers(df: DataFrame, metric: str, ints: Iterable[str] = (S.YEAR, S.SEMESTER)) -> DataFrame:
    return _present(df, {**{c: to_int(c) for c in ints}, metric: to_metric(metric)})


def check_domains(df: DataFrame, year: str = S.YEAR, semester: str = S.SEMESTER,
                  years: tuple[int, int] = YEAR_RANGE) -> DataFrame:
    return _present(df, {semester: one_of(semester, SEMESTERS), year: within(year, *years)})


def normalise_values(df: DataFrame, category: str) -> DataFrame:
    """Texts, category maps, codes, casts and domains of a canonical table, in this order."""
    return (df.transform(normalise_texts).transform(standardise_categories).transform(clean_codes)
            .transform(cast_numbers, S.metric_of(category)).transform(check_domains))


def drop_null_keys(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    keys = [k for k in keys if k in df.columns]
    return df.dropna(how="any", subset=keys) if keys else df


def impute_unknown(df: DataFrame, columns: Iterable[str] = UNKNOWN_COLUMNS, word: str = UNKNOWN) -> DataFrame:
    columns = [c for c in columns if c in df.columns]
    return df.fillna(word, subset=columns) if columns else df


def impute_zero(df: DataFrame, metric: str) -> DataFrame:
    return df.fillna(0, subset=[metric]) if metric in df.columns else df


def apply_null_policy(df: DataFrame, metric: str, keys: Sequence[str] = KEY_COLUMNS,
                      texts: Iterable[str] = UNKNOWN_COLUMNS) -> DataFrame:
    """Drop rows without keys, name unknown texts, zero the missing metric."""
    return (df.transform(drop_null_keys, keys).transform(impute_unknown, texts)
            .transform(impute_zero, metric))


def columns_to_keep(df: DataFrame, limit: float = MAX_NULL_SHARE) -> list[str]:
    """Columns whose share of NULLs is at most ``limit``, from one aggregation over all of them."""
    row = df.agg(F.count("*").alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    n = row["_n"]
    return [c for i, c in enumerate(df.columns) if n == 0 or row[str(i)] / n <= limit]


def drop_sparse_columns(df: DataFrame, limit: float = MAX_NULL_SHARE) -> DataFrame:
    return df.select(*[f"`{c}`" for c in columns_to_keep(df, limit)])


def prepare_for_analysis(df: DataFrame, category: str, limit: float = MAX_NULL_SHARE) -> DataFrame:
    """Sparse columns out, metric zeroed, rows need year and semester, unknown sector named."""
    named = ["SECTOR IES", *(["SEXO"] if S.category_of(category) == "matriculados_primer_anho" else [])]
    clean = df.transform(drop_sparse_columns, limit).transform(impute_zero, S.metric_of(category))
    time = [c for c in (S.YEAR, S.SEMESTER) if c in clean.columns]
    return clean.dropna(how="any", subset=time).transform(impute_unknown, named)
