"""Panel semantics on hand-made rows: join misses, gaps, ties, NULL criteria."""

import itertools

import pytest

from conftest import rows
from panelforge.operators import analytics as A
from panelforge.operators.panel import (
    DEFAULT, EDUCATION, add_lags, add_ratios, add_risk_label, build_panel, complete_cases, join_facts, risk_thresholds,
)

KEYS = "entity_id bigint, entity_name string, sector string, character string, department string, year int"


def fact(spark, metric, data):
    return spark.createDataFrame([(e, n, "s", "c", "d", y, v) for e, n, y, v in data], f"{KEYS}, {metric} double")


@pytest.fixture(scope="module")
def facts(spark):
    return {
        "enrolled": fact(spark, "enrolled", [(1, "a", 2013, 10.0), (1, "a", 2013, 5.0), (1, "a", 2015, 30.0), (2, "b", 2013, 8.0), (3, None, 2013, 4.0)]),
        "applicants": fact(spark, "applicants", [(1, "a", 2013, 30.0), (1, "renamed", 2015, 9.0), (9, "z", 2013, 1.0), (3, None, 2013, 7.0)]),
        "admitted": fact(spark, "admitted", [(1, "a", 2013, 20.0)]),
        "graduated": fact(spark, "graduated", [(1, "a", 2013, 3.0), (1, "a", 2015, 15.0)]),
        "first_year": fact(spark, "first_year", [(2, "b", 2013, None)]),
        "staff": fact(spark, "staff", [(2, "b", 2013, 0.0), (1, "a", 2015, 3.0)]),
    }


def test_union_equals_left_join_chain(spark, facts):
    """The one aggregation gives what the chain of left joins gives, also for NULL keys and misses."""
    chain = None
    for metric, df in facts.items():
        part = df.groupBy(*DEFAULT.keys).sum(metric).withColumnRenamed(f"sum({metric})", metric)
        chain = part if chain is None else chain.join(part, DEFAULT.keys, "left")
    chain = chain.fillna(0, subset=list(facts))
    order = ["entity_id", "year"]
    assert rows(join_facts(facts, "enrolled", DEFAULT.keys), *order) == rows(chain, *order)


def test_panel_ratios_and_lags(spark, facts):
    panel = build_panel(facts)
    got = {(r["entity_id"], r["year"]): r for r in panel.collect()}
    assert set(got) == {(1, 2013), (1, 2015), (2, 2013), (3, 2013)}
    first, later = got[1, 2013], got[1, 2015]
    assert first["grad_rate"] == 0.2 and first["retention"] == 0.5 and first["staff_load"] is None
    assert first["gap"] == 27.0 and first["growth"] is None and first["prev_grad_rate"] is None
    # applicants under another name are missed; the previous row is the previous year on record
    assert later["applicants"] == 0.0 and later["retention"] is None and later["staff_load"] == 10.0
    assert later["growth"] == 1.0 and later["prev_grad_rate"] == 0.2
    assert got[2, 2013]["staff_load"] is None
    assert len(complete_cases(panel, DEFAULT.model_features).collect()) == 0


def test_growth_after_zero_is_null(spark):
    data = [(1, "a", 2013, 0.0), (1, "a", 2014, 5.0)]
    none = fact(spark, "x", []).drop("x")
    panel = build_panel({m: fact(spark, m, data) if m == "enrolled" else none.selectExpr("*", f"0D AS {m}") for m in DEFAULT.metrics})
    assert [r["growth"] for r in panel.orderBy("year").collect()] == [None, None]


def test_label_under_null_criteria(spark):
    data = [(i, g, r, l) for i, (g, r, l) in enumerate(itertools.product([None, 0.1, 0.5, 0.9], repeat=3))]
    df = spark.createDataFrame([(i, i, g, r, l) for i, g, r, l in data],
                               "entity_id int, year int, grad_rate double, retention double, staff_load double")
    cut = risk_thresholds(df).first()
    assert (cut["p33_grad"], cut["p33_retention"], cut["p75_load"]) == (0.1, 0.1, 0.9)
    assert tuple(risk_thresholds(df, approximate=10_000).first()) == tuple(cut)
    cut = risk_thresholds(df, fit_years=list(range(1000)))
    assert cut.count() == 1
    got = {r["entity_id"]: r["at_risk"] for r in add_risk_label(df).collect()}
    assert got == {i: 0 for i, *_ in data}
    shifted = df.selectExpr("entity_id", "year", "grad_rate + entity_id * 1e-6 AS grad_rate", "retention", "staff_load")
    low = risk_thresholds(shifted).first()["p33_grad"]
    want = {r["entity_id"]: int(r["grad_rate"] is not None and r["grad_rate"] < low) for r in shifted.collect()}
    assert {r["entity_id"]: r["at_risk"] for r in add_risk_label(shifted).collect()} == want


def test_education_names(spark):
    s = EDUCATION
    df = spark.createDataFrame([(1.0, "n", "s", "c", "d", 2013, 10.0, 20.0, 15.0, 2.0, 3.0, 4.0)],
                               schema=[*s.keys, *s.metrics])
    out = df.transform(add_ratios, s).transform(add_lags, s)
    assert len(out.columns) == 19 and out.first()["tasa_graduacion"] == 0.2
    assert add_risk_label(out, s).columns[-1] == "riesgo_academico"


def test_extrema_ties_take_the_earlier_year(spark):
    evolution = spark.createDataFrame([(2015, 9.0), (2013, 9.0), (2014, 1.0), (2016, 1.0), (2017, None)], "year int, grad_pct double")
    assert rows(A.national_extrema(evolution)) == [(9.0, 2013, 1.0, 2014)]


def test_density_grid_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    assert rows(A.density_grid(df, "x", "y", 2)) == [(0, 0, 1), (0, 1, 1)]


def test_null_groups_are_left_out(spark):
    df = spark.createDataFrame([(None, 2013, 1.0, 1.0, 1.0, 0.5), ("s", 2013, 1.0, 1.0, 1.0, None)],
                               "sector string, year int, enrolled double, graduated double, applicants double, grad_rate double")
    assert rows(A.sector_trend(df)) == [("s", 2013, 1.0, 1.0, 1.0, None)]


def test_year_discovery_matches_given_years(spark):
    df = spark.createDataFrame([(1, "d", 2013, 0.5), (2, "d", 2014, 0.25), (3, "e", 2014, None)],
                               "entity_id int, department string, year int, grad_rate double")
    assert A.years_of(df) == [2013, 2014]
    assert rows(A.department_years(df), "department") == [("d", 2, 50.0, 25.0, 37.5), ("e", 1, None, None, None)]


def test_stored_facts_join_without_moving_a_row(spark):
    from panelforge.operators.panel import join_facts, join_stored, store_facts

    facts = {"a": [(1, 2020, 5.0), (1, 2020, 1.0), (2, 2021, 2.0), (None, 2020, 7.0)], "b": [(1, 2020, 3.0), (None, 2020, 4.0), (3, 2020, 1.0)],
             "c": []}
    frames = {m: spark.createDataFrame(r, f"k int, y int, {m} double") for m, r in facts.items()}
    stored = join_stored(store_facts(frames, ["k", "y"], 3), "a", ["k", "y"])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    order = lambda df: sorted(df.collect(), key=str)
    assert order(stored) == order(join_facts(frames, "a", ["k", "y"])) == [
        (1, 2020, 6.0, 3.0, 0.0), (2, 2021, 2.0, 0.0, 0.0), (None, 2020, 7.0, 0.0, 0.0)]
