"""Panel and report queries on the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import analytics as A
from panelforge.operators.panel import (
    DEFAULT, complete_cases, join_facts, join_stored, risk_thresholds, store_facts, sum_by_entity_year,
)
from panelforge.plans import driver_tables as D
from panelforge.session import stage

MAX_LOAD = D.MAX_LOAD


def facts_by_category(spark, sf_dir, keep=lambda rows: rows):
    """Six separate facts at row level, as a lake would hold them, from rows that ``keep`` may write first."""
    rows = D.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity_id"), F.year("l_shipdate").alias("year"), "l_quantity", "l_partkey",
        "l_linenumber", "l_linestatus", "l_returnflag", "l_discount")
    rows = keep(rows)

    def fact(metric, condition=F.lit(True)):
        return rows.filter(condition).select("entity_id", "year", F.col("l_quantity").alias(metric))

    staff = rows.filter(D.is_staff()).select("entity_id", "year", "l_partkey").distinct()
    return {
        "enrolled": fact("enrolled", D.is_enrolled()),
        "applicants": fact("applicants"),
        "admitted": fact("admitted", D.is_admitted()),
        "graduated": fact("graduated", D.is_graduated()),
        "first_year": fact("first_year", D.is_enrolled() & (F.col("l_linenumber") == 1)),
        "staff": staff.select("entity_id", "year", F.lit(1.0).alias("staff")),
    }


def panel_from_facts(spark, sf_dir):
    """The panel from separate facts; attributes join the sums, not the rows."""
    joined = join_facts(facts_by_category(spark, sf_dir), DEFAULT.enrolled, ["entity_id", "year"])
    return joined.join(D.suppliers(spark, sf_dir), "entity_id")


def panel_from_stored(spark, sf_dir):
    """The same panel from facts that are kept bucketed alike and joined where they lie; the rows are read once."""
    keys = ["entity_id", "year"]
    tables = store_facts(facts_by_category(spark, sf_dir, stage), keys)
    return join_stored(tables, DEFAULT.enrolled, keys).join(D.suppliers(spark, sf_dir), "entity_id")


def fact_sums(spark, sf_dir):
    """One fact by entity, year and a further column."""
    rows = (D.table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_suppkey").alias("entity_id"), F.year("l_shipdate").alias("year"), "l_returnflag")
            .agg(F.sum("l_quantity").alias("units"))
            .join(D.suppliers(spark, sf_dir), "entity_id"))
    return sum_by_entity_year(rows, "units", extra=["l_returnflag"])


def panel_growth(spark, sf_dir):
    return D.lagged_panel(spark, sf_dir).select("entity_id", "year", "enrolled", "growth")


def panel_prev_rate(spark, sf_dir):
    return D.lagged_panel(spark, sf_dir).select("entity_id", "year", "grad_rate", "prev_grad_rate")


def panel_thresholds(spark, sf_dir):
    return risk_thresholds(D.staged_panel(spark, sf_dir))


def panel_train_thresholds(spark, sf_dir):
    return risk_thresholds(D.staged_panel(spark, sf_dir), fit_years=D.TRAIN_YEARS)


def panel_complete_cases(spark, sf_dir):
    return complete_cases(D.lagged_panel(spark, sf_dir), DEFAULT.model_features)


def distinct_values(spark, sf_dir):
    """Years and sectors that the panel holds."""
    return D.metrics_panel(spark, sf_dir).select("year", "sector").distinct()


def national_extrema(spark, sf_dir):
    return A.national_extrema(A.national_evolution(D.ratios_panel(spark, sf_dir)))


def top_department_rows(spark, sf_dir):
    rows = A.rows_of_largest(D.metrics_panel(spark, sf_dir), "department", 5)
    return rows.select("entity_id", "department", "year", "enrolled")


def _profile(spark, sf_dir):
    return A.load_profile(D.ratios_panel(spark, sf_dir), MAX_LOAD)


def load_efficiency_fit(spark, sf_dir):
    fit = A.load_fit(_profile(spark, sf_dir))
    return fit.select("n", *[A.rounded(F.col(c)).alias(c) for c in ("slope", "intercept", "r", "x_min", "x_max")])


def load_trend_line(spark, sf_dir):
    line = A.fit_line(A.load_fit(_profile(spark, sf_dir)))
    return line.select("point", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def marker_clip(spark, sf_dir):
    return A.mark_sizes(stage(_profile(spark, sf_dir), "profile")).withColumn("mark", A.rounded(F.col("mark")))


def _change(spark, sf_dir):
    return A.regional_change(D.ratios_panel(spark, sf_dir), (1995, 1997), (1999, 2001))


def density_grid(spark, sf_dir):
    rows = A.plausible(D.staged_ratios(spark, sf_dir), MAX_LOAD)
    return A.density_grid(rows.withColumn("rate_pct", F.col("grad_rate") * 100), "staff_load", "rate_pct")


def hex_density(spark, sf_dir):
    rows = A.plausible(D.staged_ratios(spark, sf_dir), MAX_LOAD)
    return A.hex_density(rows.withColumn("rate_pct", F.col("grad_rate") * 100), "staff_load", "rate_pct")


def area_loss(spark, sf_dir):
    """Areas are part types; units are summed per part before the parts are joined."""
    per_part = (D.table(spark, sf_dir, "lineitem")
                .groupBy("l_partkey", F.year("l_shipdate").alias("year"))
                .agg(F.count_if(D.is_enrolled()).alias("n"), D.units().alias("applicants"),
                     D.units(D.is_enrolled()).alias("enrolled"), D.units(D.is_graduated()).alias("graduated")))
    per_area = (per_part.join(D.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
                .groupBy(F.col("p_type").alias("area"), "year")
                .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in ("applicants", "enrolled", "graduated")])
                .filter("n > 0"))
    return A.area_loss(per_area)


def queries() -> dict:
    return {
        "panel_metrics": D.metrics_panel,
        "panel_from_facts": panel_from_facts,
        "panel_from_stored": panel_from_stored,
        "fact_sums": fact_sums,
        "panel_ratios": D.ratios_panel,
        "panel_growth": panel_growth,
        "panel_prev_rate": panel_prev_rate,
        "panel_thresholds": panel_thresholds,
        "panel_train_thresholds": panel_train_thresholds,
        "panel_risk_label": D.labelled_panel,
        "complete_cases": panel_complete_cases,
        "distinct_values": distinct_values,
        "national_evolution": lambda s, d: A.national_evolution(D.ratios_panel(s, d)),
        "national_extrema": national_extrema,
        "top10_entities": lambda s, d: A.top_entities(D.ratios_panel(s, d)),
        "dept_year_pivot": lambda s, d: A.department_years(D.staged_ratios(s, d)),
        "top_department_rows": top_department_rows,
        "load_efficiency_fit": load_efficiency_fit,
        "load_trend_line": load_trend_line,
        "marker_clip": marker_clip,
        "sector_trend": lambda s, d: A.sector_trend(D.ratios_panel(s, d)),
        "funnel_by_year": lambda s, d: A.funnel(D.metrics_panel(s, d), [1995, 1998, 2001]),
        "unsustainable_growth": lambda s, d: A.unsustainable_growth(D.lagged_panel(s, d), D.RECENT),
        "regional_change": _change,
        "regional_deterioration": lambda s, d: A.deteriorating(_change(s, d)),
        "regional_bands": lambda s, d: A.regional_bands(_change(s, d)),
        "yearly_correlation": lambda s, d: A.yearly_correlation(D.staged_ratios(s, d), MAX_LOAD),
        "density_grid": density_grid,
        "hex_density": hex_density,
        "area_loss": area_loss,
        "exec_summary": lambda s, d: A.executive_summary(D.labelled_panel(s, d)),
    }
