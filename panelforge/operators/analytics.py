"""Descriptive and decision queries over any panel.

Where a query says so, it reads its input twice (for a range, a maximum or an overall figure); give
it a staged frame then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.numbers import (
    band_above, clip, guarded_ratio, least_squares, pearson,
)
from panelforge.functions.quantiles import Quantile, exact_quantiles
from panelforge.functions.text import short_label
from panelforge.operators.panel import DEFAULT, PanelSpec
from panelforge.session import stage

DIGITS = 6

# Limits of plausible ratios and rates, and of the bands and marks of the reports.
MAX_LOAD = 200.0
MAX_RATE = 2.0
LOSS_BANDS = [(85.0, "critical"), (70.0, "high")]
MARK_RANGE = (20.0, 500.0)


def rounded(c: Column) -> Column:
    return F.round(c, DIGITS)


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose group keys are all known: a NULL key is no group in these reports."""
    return df.dropna(how="any", subset=list(keys))


def national_evolution(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    totals = known(panel, s.year).groupBy(s.year).agg(*[
        F.sum(m).alias(m) for m in (s.applicants, s.admitted, s.enrolled, s.graduated)])
    return (totals.withColumn("grad_pct", guarded_ratio(F.col(s.graduated) * 100, s.enrolled))
            .orderBy(s.year))


def national_extrema(evolution: DataFrame, value: str = "grad_pct", spec: PanelSpec = DEFAULT) -> DataFrame:
    """Best and worst year; the earlier one on ties."""
    year = F.col(spec.year)
    best, worst = F.max(F.struct(value, -year)), F.min(F.struct(value, year))
    return evolution.filter(F.col(value).isNotNull()).agg(
        best[value].alias("max_value"), (-best["col2"]).alias("max_year"),
        worst[value].alias("min_value"), worst[spec.year].alias("min_year"))


def entity_means(panel: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    return known(panel, *keys).groupBy(*keys).agg(*[F.avg(c).alias(a) for a, c in columns.items()])


def top_entities(panel: DataFrame, n: int = 10, spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    means = entity_means(panel, [s.entity, s.name, s.sector],
                         {"mean_enrolled": s.enrolled, "mean_grad_rate": s.grad_rate})
    return (means.orderBy(F.desc("mean_enrolled"), s.entity).limit(n)
            .withColumns({"short_name": short_label(s.name, 40),
                          "mean_enrolled": rounded(F.col("mean_enrolled")),
                          "mean_grad_rate": rounded(F.col("mean_grad_rate"))}))


def years_of(panel: DataFrame, spec: PanelSpec = DEFAULT) -> list[int]:
    """The calendar of a panel: as many values as there are years."""
    return [r[0] for r in known(panel, spec.year).select(spec.year).distinct().orderBy(spec.year).collect()]


def department_years(panel: DataFrame, years: Sequence[int] | None = None, top: int = 20,
                     spec: PanelSpec = DEFAULT) -> DataFrame:
    """Departments by years of mean rate in percent, best mean first, for the ``top`` with most rows.

    Pivot, row mean and row count come from one aggregation.
    """
    s = spec
    years = years or years_of(panel, spec)
    rate = F.col(s.grad_rate) * 100
    wide = known(panel, s.department).groupBy(s.department).agg(
        F.count(s.entity).alias("n_rows"),
        *[F.avg(F.when(F.col(s.year) == y, rate)).alias(f"y{y}") for y in years])
    filled = F.filter(F.array(*[f"y{y}" for y in years]), lambda v: v.isNotNull())
    total = F.aggregate(filled, F.lit(0.0), lambda acc, v: acc + v)
    ranked = wide.withColumn("row_mean", F.when(F.size(filled) > 0, total / F.size(filled)))
    return (ranked.orderBy(F.desc("n_rows"), s.department).limit(top)
            .orderBy(F.desc_nulls_last("row_mean"), s.department)
            .select(s.department, "n_rows", *[rounded(F.col(c)).alias(c)
                                              for c in [*(f"y{y}" for y in years), "row_mean"]]))


def rows_of_largest(df: DataFrame, group: str, n: int = 20) -> DataFrame:
    """Rows of the ``n`` groups with most rows: a semi join with ``n`` keys."""
    largest = known(df, group).groupBy(group).count().orderBy(F.desc("count"), group).limit(n)
    return df.join(largest.select(group), group, "left_semi")


def load_profile(panel: DataFrame, max_load: float = MAX_LOAD, max_rate: float = MAX_RATE,
                 spec: PanelSpec = DEFAULT) -> DataFrame:
    """Mean load, rate and size per entity, without implausible values."""
    s = spec
    means = entity_means(panel, [s.entity, s.name, s.sector],
                         {"mean_load": s.load, "mean_rate": s.grad_rate, "mean_enrolled": s.enrolled})
    return means.filter((F.col("mean_load") < max_load) & (F.col("mean_rate") < max_rate))


def load_fit(profile: DataFrame, x: str = "mean_load", y: str = "mean_rate") -> DataFrame:
    """Trend of the rate in percent on the load, with Pearson's r; one row."""
    slope, intercept = least_squares(x, F.col(y) * 100)
    return profile.agg(F.count("*").alias("n"), slope.alias("slope"), intercept.alias("intercept"),
                       pearson(x, y).alias("r"), F.min(x).alias("x_min"), F.max(x).alias("x_max"))


def fit_line(fit: DataFrame, points: int = 100) -> DataFrame:
    """Evenly spaced points of the fitted line."""
    at = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    x = F.col("x_min") + (F.col("x_max") - F.col("x_min")) * F.col("point") / (points - 1)
    return (at.withColumn("x", x)
            .select("point", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))


def mark_sizes(profile: DataFrame, size: str = "mean_enrolled", spec: PanelSpec = DEFAULT) -> DataFrame:
    """Mark area in proportion to the largest entity, clipped. Reads ``profile`` twice."""
    largest = profile.agg(F.max(size)).scalar()
    return profile.withColumn("_largest", largest).select(
        spec.entity, clip(F.try_divide(F.col(size), F.col("_largest")) * MARK_RANGE[1], *MARK_RANGE).alias("mark"))


def sector_trend(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    return (known(panel, s.sector, s.year).groupBy(s.sector, s.year)
            .agg(F.sum(s.enrolled).alias(s.enrolled), F.sum(s.graduated).alias(s.graduated),
                 F.sum(s.applicants).alias(s.applicants), rounded(F.avg(s.grad_rate)).alias("mean_rate"))
            .orderBy(s.year, s.sector))


def funnel(panel: DataFrame, years: Sequence[int], spec: PanelSpec = DEFAULT) -> DataFrame:
    """Stage totals per chosen year, as share of the first stage and of the largest."""
    s = spec
    stages = [s.applicants, s.admitted, s.enrolled, s.graduated]
    totals = (panel.filter(F.col(s.year).isin(list(years))).groupBy(s.year)
              .agg(*[F.sum(m).alias(m) for m in stages]))
    entries = F.array(*[F.struct(F.lit(i + 1).alias("stage_no"), F.lit(m).alias("stage"), F.col(m).alias("value"))
                        for i, m in enumerate(stages)])
    first, largest = F.col(stages[0]), F.greatest(*stages)
    return (totals.select(s.year, first.alias("_first"), largest.alias("_largest"), F.inline(entries))
            .select(s.year, "stage_no", "stage", "value",
                    F.coalesce(guarded_ratio(F.col("value") * 100, "_first"), F.lit(0.0)).alias("pct_of_first"),
                    guarded_ratio("value", "_largest").alias("width"))
            .orderBy(s.year, "stage_no"))


def unsustainable_growth(panel: DataFrame, since: int, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Entities whose recent mean load is above the upper quartile and whose rate is below the lower."""
    s = spec
    recent = entity_means(panel.filter(F.col(s.year) >= since), [s.entity, s.name, s.sector, s.department],
                          {"mean_load": s.load, "mean_rate": s.grad_rate,
                           "mean_growth": s.growth, "mean_enrolled": s.enrolled})
    means = stage(recent.dropna(subset=["mean_load", "mean_rate"]), "entity-means")
    cut = exact_quantiles(means, {"p75_load": Quantile("mean_load", 0.75, "cont"),
                                  "p25_rate": Quantile("mean_rate", 0.25, "cont")}).first()
    hits = means.filter((F.col("mean_load") > F.lit(cut["p75_load"])) & (F.col("mean_rate") < F.lit(cut["p25_rate"])))
    return (hits.orderBy(F.desc("mean_load"), s.entity)
            .select(s.entity, s.name, s.sector, s.department,
                    *[rounded(F.col(c)).alias(c) for c in ("mean_load", "mean_rate", "mean_growth", "mean_enrolled")]))


def regional_change(panel: DataFrame, first: tuple[int, int], second: tuple[int, int],
                    spec: PanelSpec = DEFAULT) -> DataFrame:
    """Mean rate per department in two periods and the change in percentage points, one pass."""
    s = spec
    rate, year = F.col(s.grad_rate), F.col(s.year)
    means = known(panel, s.department).groupBy(s.department).agg(
        F.avg(F.when(year.between(*first), rate)).alias("rate_before"),
        F.avg(F.when(year.between(*second), rate)).alias("rate_after"))
    change = (F.col("rate_after") - F.col("rate_before")) * 100  # compared as it is, rounded at the end
    return (means.dropna(subset=["rate_before", "rate_after"])
            .withColumn("change_pp", change)
            .withColumn("trend", F.when(F.col("change_pp") < 0, "down").otherwise("up"))
            .withColumns({c: rounded(F.col(c)) for c in ("rate_before", "rate_after", "change_pp")})
            .orderBy("change_pp", s.department))


def deteriorating(change: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    return (change.filter(F.col("trend") == "down")
            .select(spec.department, *[F.round(F.col(c) * 100, 2).alias(f"{c}_pct")
                                       for c in ("rate_before", "rate_after")],
                    F.round("change_pp", 2).alias("change_pp"))
            .orderBy("change_pp", spec.department))


def regional_bands(change: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    """Departments in three bands by the 0.3 and 0.6 quantiles of the later rate."""
    rates = stage(change.select(spec.department, "rate_after"), "regional-rates")
    cut = exact_quantiles(rates, {"low": Quantile("rate_after", 0.3, "cont"),
                                  "mid": Quantile("rate_after", 0.6, "cont")}).first()
    rate = F.col("rate_after")
    band = F.when(rate < F.lit(cut["low"]), "critical").when(rate < F.lit(cut["mid"]), "medium").otherwise("high")
    return rates.withColumn("band", band).orderBy("rate_after", spec.department)


def plausible(panel: DataFrame, max_load: float = MAX_LOAD, max_rate: float = MAX_RATE,
              spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    return (panel.dropna(subset=[s.load, s.grad_rate, s.staff, s.enrolled])
            .filter((F.col(s.load) < max_load) & (F.col(s.grad_rate) < max_rate)))


def yearly_correlation(panel: DataFrame, max_load: float = MAX_LOAD, max_rate: float = MAX_RATE,
                       spec: PanelSpec = DEFAULT) -> DataFrame:
    """Pearson per year over all known pairs, next to the global one over plausible pairs.

    Reads ``panel`` twice.
    """
    s = spec
    pairs = known(panel, s.year).dropna(subset=[s.load, s.grad_rate])
    overall = plausible(panel, max_load, max_rate, spec).agg(pearson(s.load, s.grad_rate)).scalar()
    return (pairs.groupBy(s.year).agg(rounded(pearson(s.load, s.grad_rate)).alias("correlation"))
            .withColumn("overall", rounded(overall)).orderBy(s.year))


def density_grid(df: DataFrame, x: str, y: str, cells: int = 25) -> DataFrame:
    """Counts on a ``cells`` by ``cells`` grid over the range of the data; empty cells are absent.

    Reads ``df`` twice.
    """
    rows = df.dropna(subset=[x, y])
    span = rows.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"),
                             F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()

    def cell(c: str, low: str, high: str) -> Column:
        width = (F.col(high) - F.col(low)) / cells
        at = F.when(width > 0, F.floor((F.col(c) - F.col(low)) / width)).otherwise(0)
        return F.least(at, F.lit(cells - 1)).cast("int")

    return (rows.select(x, y, span.alias("_s"))
            .select(cell(x, "_s.x0", "_s.x1").alias("bin_x"), cell(y, "_s.y0", "_s.y1").alias("bin_y"))
            .groupBy("bin_x", "bin_y").agg(F.count("*").alias("n")).orderBy("bin_x", "bin_y"))


def hex_density(df: DataFrame, x: str, y: str, cells: int = 25) -> DataFrame:
    """Counts per hexagon, ``cells`` of them over the range of ``x`` and as many rows as keep them regular; empty
    ones are absent. Reads ``df`` twice.

    Hexagons stand on a corner and are named by axial coordinates: ``r`` is the row, ``q`` moves half a hexagon
    to the right with each row. A point is in the hexagon that its coordinates round to, all three of which sum to zero.
    """
    rows = df.dropna(subset=[x, y])
    span = rows.agg(F.struct(F.min(x).alias("x0"), F.max(x).alias("x1"),
                             F.min(y).alias("y0"), F.max(y).alias("y1"))).scalar()

    def along(c: str, low: str, high: str, n: int) -> Column:
        width = F.col(high) - F.col(low)
        return F.when(width > 0, (F.col(c) - F.col(low)) / width * n).otherwise(0.0)

    placed = rows.select(x, y, span.alias("_s")).select(
        along(x, "_s.x0", "_s.x1", cells).alias("_u"), along(y, "_s.y0", "_s.y1", int(cells / 3 ** 0.5)).alias("_r"))
    exact = placed.select((F.col("_u") - F.col("_r") / 2).alias("_q"), "_r").withColumn("_t", -F.col("_q") - F.col("_r"))
    near = exact.select("*", *[F.floor(F.col(c) + 0.5).alias(f"{c}n") for c in ("_q", "_r", "_t")])
    off = {c: F.abs(F.col(f"{c}n") - F.col(c)) for c in ("_q", "_r", "_t")}
    turn_q = (off["_q"] > off["_r"]) & (off["_q"] > off["_t"])
    turn_r = ~turn_q & (off["_r"] > off["_t"])
    cell = near.select(F.when(turn_q, -F.col("_rn") - F.col("_tn")).otherwise(F.col("_qn")).cast("int").alias("q"),
                       F.when(turn_r, -F.col("_qn") - F.col("_tn")).otherwise(F.col("_rn")).cast("int").alias("r"))
    return cell.groupBy("q", "r").agg(F.count("*").alias("n")).orderBy("r", "q")


def area_loss(area_years: DataFrame, area: str = "area", spec: PanelSpec = DEFAULT, top: int = 15) -> DataFrame:
    """Demand against permanence per area, from sums per (area, year): mean flows, rates and loss."""
    s = spec
    means = known(area_years, area).groupBy(area).agg(
        F.avg(s.applicants).alias("mean_applicants"), F.avg(s.enrolled).alias("mean_enrolled"),
        F.avg(s.graduated).alias("mean_graduated"))
    rates = means.withColumns({
        "permanence": guarded_ratio("mean_enrolled", "mean_applicants"),
        "graduation": guarded_ratio("mean_graduated", "mean_enrolled"),
        "loss_pct": (1 - guarded_ratio("mean_graduated", "mean_applicants")) * 100,
    }).dropna()
    numbers = [c for c in rates.columns if c != area]
    return (rates.orderBy(F.desc("loss_pct"), area).limit(top)
            .withColumns({"short_area": short_label(area, 35), "band": band_above("loss_pct", LOSS_BANDS, "moderate")})
            .withColumns({c: rounded(F.col(c)) for c in numbers}))


def executive_summary(panel: DataFrame, spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    return panel.agg(
        F.count("*").alias("n_rows"), F.count_distinct(s.entity).alias("n_entities"),
        F.count_distinct(s.year).alias("n_years"), F.min(s.year).alias("first_year_seen"),
        F.max(s.year).alias("last_year_seen"), F.count_if(F.col(s.label) == 1).alias("n_at_risk"),
        F.round(F.count_if(F.col(s.label) == 1) * 100 / F.count("*"), 1).alias("pct_at_risk"))


def risk_years(predictions: DataFrame, prediction: str = "prediction", spec: PanelSpec = DEFAULT) -> DataFrame:
    """Years at risk and the last of them, per entity with any."""
    return (predictions.filter(F.col(prediction) == 1).groupBy(spec.entity)
            .agg(F.sum(prediction).cast("bigint").alias("years_at_risk"), F.max(spec.year).alias("last_year")))


def intervention_priority(clusters: DataFrame, predictions: DataFrame, prediction: str = "prediction",
                          spec: PanelSpec = DEFAULT) -> DataFrame:
    """Clustered entities that the classifier also marks, most years at risk first."""
    return (clusters.join(risk_years(predictions, prediction, spec), spec.entity, "inner")
            .withColumn("mark", clip(F.col("years_at_risk") * 40, 60, 400).cast("int"))
            .orderBy(F.desc("years_at_risk"), spec.entity))


def labelled_clusters(clusters: DataFrame, word: str = "Riesgo", label: str = "cluster_label") -> DataFrame:
    """Without predictions: entities of the clusters whose label mentions the word."""
    return clusters.filter(F.col(label).contains(word))


def risk_by_department(predictions: DataFrame, prediction: str = "prediction", top: int = 15,
                       spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    return (known(predictions, s.department).filter(F.col(prediction) == 1)
            .groupBy(s.department).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), s.department).limit(top))


def risk_ranking(predictions: DataFrame, prediction: str = "prediction", top: int = 20,
                 spec: PanelSpec = DEFAULT) -> DataFrame:
    s = spec
    keys = [s.entity, s.name, s.sector, s.department]
    return (known(predictions, *keys).filter(F.col(prediction) == 1)
            .groupBy(*keys).agg(F.count("*").alias("years_at_risk"))
            .orderBy(F.desc("years_at_risk"), s.entity).limit(top))
