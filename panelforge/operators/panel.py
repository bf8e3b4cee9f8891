"""The entity-year panel: facts joined on conformed keys, guarded ratios, lags and a risk label."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.numbers import guarded_ratio
from panelforge.functions.quantiles import Quantile, exact_quantiles
from panelforge.session import shared_dir


@dataclass(frozen=True)
class PanelSpec:
    """Column names of a panel."""

    entity: str = "entity_id"
    name: str = "entity_name"
    sector: str = "sector"
    character: str = "character"
    department: str = "department"
    year: str = "year"
    enrolled: str = "enrolled"
    applicants: str = "applicants"
    admitted: str = "admitted"
    graduated: str = "graduated"
    first_year: str = "first_year"
    staff: str = "staff"
    grad_rate: str = "grad_rate"
    retention: str = "retention"
    admission: str = "admission"
    load: str = "staff_load"
    gap: str = "gap"
    growth: str = "growth"
    prev_grad_rate: str = "prev_grad_rate"
    label: str = "at_risk"

    @property
    def attributes(self) -> list[str]:
        return [self.entity, self.name, self.sector, self.character, self.department]

    @property
    def keys(self) -> list[str]:
        return [*self.attributes, self.year]

    @property
    def metrics(self) -> list[str]:
        return [self.enrolled, self.applicants, self.admitted, self.graduated, self.first_year, self.staff]

    @property
    def cluster_features(self) -> list[str]:
        return [self.grad_rate, self.load, self.growth, self.retention, self.gap, self.enrolled]

    @property
    def model_features(self) -> list[str]:
        return [self.grad_rate, self.prev_grad_rate, self.load, self.growth,
                self.retention, self.enrolled, self.gap]

    @property
    def model_categories(self) -> list[str]:
        return [self.sector, self.character]


DEFAULT = PanelSpec()

# The column names of the education panel.
EDUCATION = PanelSpec(
    entity="COD_IES", name="NOMBRE_IES", sector="SECTOR_IES", character="CARACTER_IES",
    department="DEPTO_IES", year="AÑO",
    enrolled="MATRICULADOS", applicants="INSCRITOS", admitted="ADMITIDOS", graduated="GRADUADOS",
    first_year="MATRICULADOS_PRIMER_CURSO", staff="NUM_DOCENTES",
    grad_rate="tasa_graduacion", retention="tasa_permanencia", admission="tasa_admision",
    load="ratio_docente_estudiante", gap="brecha_ingreso_egreso",
    growth="tasa_crecimiento_matricula", prev_grad_rate="tasa_grad_anho_anterior",
    label="riesgo_academico",
)


def sum_by_entity_year(fact: DataFrame, metric: str, spec: PanelSpec = DEFAULT,
                       extra: Sequence[str] = ()) -> DataFrame:
    """One fact summed per entity and year, optionally by further columns."""
    keys = list(dict.fromkeys([*spec.keys, *extra]))
    return fact.groupBy(*keys).agg(F.sum(metric).cast("double").alias(metric))


def join_facts(facts: Mapping[str, DataFrame], driving: str, keys: Sequence[str]) -> DataFrame:
    """Left-join chain of facts on ``keys``, each summed by them; missing metrics are 0.

    ``facts`` maps a metric column to the rows that hold it. The chain is one union and one
    aggregation instead of one shuffle per fact and a join each: every row is summed before the
    shuffle, and a key is kept if the driving fact has it. A NULL key never equals another one in
    a join, so rows of the other facts with a NULL key are left out.
    """
    def wide(metric: str, rows: DataFrame) -> DataFrame:
        if metric != driving:
            rows = rows.dropna(how="any", subset=list(keys))
        return rows.select(
            *keys,
            *[(F.col(m) if m == metric else F.lit(None)).cast("double").alias(m) for m in facts],
            F.lit(metric == driving).alias("_driving"),
        )

    rows = reduce(DataFrame.unionByName, [wide(m, df) for m, df in facts.items()])
    return (rows.groupBy(*keys)
            .agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in facts],
                 F.bool_or("_driving").alias("_driving"))
            .filter("_driving").drop("_driving"))


def store_facts(facts: Mapping[str, DataFrame], keys: Sequence[str], buckets: int | None = None) -> dict[str, DataFrame]:
    """Each fact summed by ``keys`` and kept as a table that is bucketed and sorted by them, a file per bucket.

    For facts that are joined again and again: tables laid out alike meet without moving a row. The number of
    buckets is the session's shuffle partitions unless given; facts to be joined need the same.
    """
    tables = {}
    for metric, rows in facts.items():
        spark = rows.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"panelforge_{uuid.uuid4().hex}"
        (rows.groupBy(*keys).agg(F.sum(metric).cast("double").alias(metric)).repartition(n, *keys)
         .write.bucketBy(n, *keys).sortBy(*keys).option("path", shared_dir(spark, "fact")).format("parquet").saveAsTable(name))
        tables[metric] = spark.table(name)
    return tables


def join_stored(tables: Mapping[str, DataFrame], driving: str, keys: Sequence[str]) -> DataFrame:
    """``join_facts`` over tables of ``store_facts``: a chain of left joins, none of which moves a row; Spark still sorts each bucket."""
    joined = tables[driving]
    for metric, table in tables.items():
        if metric != driving:
            joined = joined.join(table.hint("merge"), list(keys), "left")
    return joined.select(*keys, *[F.coalesce(m, F.lit(0.0)).alias(m) for m in tables])


def add_ratios(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    return panel.withColumns({
        s.grad_rate: guarded_ratio(s.graduated, s.enrolled),
        s.retention: guarded_ratio(s.enrolled, s.applicants),
        s.admission: guarded_ratio(s.admitted, s.applicants),
        s.load: guarded_ratio(s.enrolled, s.staff),
        s.gap: F.col(s.applicants) - F.col(s.graduated),
    })


def add_lags(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Growth against the entity's previous row and that row's graduation rate.

    A window holds one entity's years (and attribute variants of a year, ordered by their text),
    so it is as small as the calendar even where one entity owns most of the facts.
    """
    s = spec
    by_year = Window.partitionBy(s.entity).orderBy(s.year, s.name, s.sector, s.character, s.department)
    previous = F.lag(s.enrolled, 1).over(by_year)
    return panel.withColumns({
        s.growth: guarded_ratio(F.col(s.enrolled) - previous, previous),
        s.prev_grad_rate: F.lag(s.grad_rate, 1).over(by_year),
    })


def risk_thresholds(panel: DataFrame, spec: PanelSpec = DEFAULT,
                    fit_years: Sequence[int] | None = None, approximate: int | None = None) -> DataFrame:
    """One row of discrete percentiles, each over its own non-null rows.

    Exact by default, so that labels do not change between runs; ``approximate`` takes the accuracy
    of a single sketch pass instead. ``fit_years`` limits the rows to the training years.
    """
    rows = panel if fit_years is None else panel.filter(F.col(spec.year).isin(list(fit_years)))
    wanted = {
        "p25_grad": Quantile(spec.grad_rate, 0.25),
        "p33_grad": Quantile(spec.grad_rate, 0.33),
        "p33_retention": Quantile(spec.retention, 0.33),
        "p75_load": Quantile(spec.load, 0.75),
    }
    if approximate:
        return rows.agg(*[F.percentile_approx(q.column, q.p, approximate).alias(a)
                          for a, q in wanted.items()])
    return exact_quantiles(rows, wanted)


def risk_criteria(spec: PanelSpec, low_grad: Column, low_retention: Column, high_load: Column) -> Column:
    """1 if any criterion holds, else 0; a criterion with a NULL side does not hold."""
    hit = ((F.col(spec.grad_rate) < low_grad)
           | (F.col(spec.retention) < low_retention)
           | (F.col(spec.load) > high_load))
    return F.when(hit, 1).otherwise(0).cast("int")


def add_risk_label(panel: DataFrame, spec: PanelSpec = DEFAULT,
                   fit_years: Sequence[int] | None = None) -> DataFrame:
    """Label by the percentile criteria.

    The thresholds are one row, fetched first and put in as literals: filters on the label would
    copy a subquery to every place they are pushed to. Pass a staged panel.
    """
    cut = risk_thresholds(panel, spec, fit_years).first()
    low_grad, low_retention, high_load = (
        F.lit(cut[c]).cast("double") for c in ("p33_grad", "p33_retention", "p75_load"))
    return panel.withColumn(spec.label, risk_criteria(spec, low_grad, low_retention, high_load))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column holds a value; NaN counts as missing."""
    return df.dropna(how="any", subset=list(columns))


def build_panel(facts: Mapping[str, DataFrame], spec: PanelSpec = DEFAULT) -> DataFrame:
    """Six facts to a panel with ratios and lags; stage the result before labelling it."""
    joined = join_facts(facts, spec.enrolled, spec.keys)
    return joined.transform(add_ratios, spec).transform(add_lags, spec)
