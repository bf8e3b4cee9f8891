"""Cleaning rules and numbers on their edge values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelforge.functions import numbers as N
from panelforge.functions import text as T
from panelforge.functions.quantiles import Quantile, brackets, exact_quantiles


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_null_tokens_and_whitespace(spark):
    got = apply(spark, [" NaN ", "none", "null", "", "   ", None, "a\nb\tc", "\n", "nan\n", " x ", "nano"], T.normalise_text)
    assert got == [None, None, None, None, None, None, "a b c", "", "nan", "x", "nano"]


def test_category_map(spark):
    mapping = {"mujer": "Femenino", "f": "Femenino", "distancia virtual": "Virtual"}
    got = apply(spark, [" MUJER ", "F", "Distancia Virtual", "otro ", "null", None], lambda c: T.map_category(c, mapping))
    assert got == ["Femenino", "Femenino", "Virtual", "otro", None, None]
    got = apply(spark, [" mujer", "otro ", "null"], lambda c: T.map_category(c, mapping, "upper"))
    assert got == ["Femenino", "OTRO", "NULL"]
    with pytest.raises(ValueError):
        T.map_category("v", mapping, "drop")


def test_codes(spark):
    assert apply(spark, [" 1234.0 ", "12.05", "7", None, "1.0.0"], T.clean_code) == ["1234", "12.05", "7", None, "1.0"]


def test_metric_text(spark):
    got = apply(spark, ["1,234", "1.234", "12.0", "12.00", "1.000", " 5 ", "x", "", None, "-3"], N.to_metric)
    assert got == [1234, 1234, 12, 12, 1000, 5, None, None, None, -3]


def test_int_text(spark):
    got = apply(spark, ["2013", "2013.0", "12.7", " 2 ", "1e3", "x", "", None, "99999999999", "-4."], N.to_int)
    assert got == [2013, 2013, 12, 2, None, None, None, None, None, -4]


def test_double_drops_nan(spark):
    assert apply(spark, ["1.5", "NaN", "abc", None], N.to_double) == [1.5, None, None, None]


def test_domains(spark):
    assert apply(spark, [1, 2, 3, None], lambda c: N.one_of(c, (1, 2)), "int") == [1, 2, None, None]
    assert apply(spark, [2012, 2013, 2030, 2031], lambda c: N.within(c, 2013, 2030), "int") == [None, 2013, 2030, None]


def test_guarded_ratio_never_divides_by_zero(spark):
    assert apply(spark, [0.0, 2.0, None, -1.0], lambda c: N.guarded_ratio(F.lit(1.0), c), "double") == [None, 0.5, None, None]


def test_bands_clip_and_labels(spark):
    bands = [(85.0, "critical"), (70.0, "high")]
    assert apply(spark, [90.0, 85.0, 70.0, 1.0], lambda c: N.band_above(c, bands, "moderate"), "double") == [
        "critical", "high", "moderate", "moderate"]
    assert apply(spark, [1.0, 50.0, 900.0], lambda c: N.clip(c, 20.0, 500.0), "double") == [20.0, 50.0, 500.0]
    assert apply(spark, ["abcdef", "ab"], lambda c: T.short_label(c, 3, ellipsis=True)) == ["abc...", "ab"]


def test_pearson_and_fit_without_variance(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 1.0, 3.0), ("c", 1.0, 1.0), ("c", 2.0, 2.0),
                                ("c", 3.0, None)], "g string, x double, y double")
    slope, intercept = N.least_squares("x", "y")
    got = {r["g"]: (r["r"], r["s"]) for r in df.groupBy("g").agg(N.pearson("x", "y").alias("r"), slope.alias("s")).collect()}
    assert got["a"] == (None, None) and got["b"] == (None, None)
    assert math.isclose(got["c"][0], 1.0) and math.isclose(got["c"][1], 1.0)


def test_folding_and_keywords(spark):
    assert apply(spark, [" ÁrEa Ñandú "], T.fold) == ["area nandu"]
    got = apply(spark, ["Código IES", "ano", "anotado", None], lambda c: T.mentions_any(c, ["código"], ["año"]))
    assert got == [True, True, False, False]


def brute_quantile(values, p, kind):
    v = sorted(values)
    if kind == "disc":
        return v[max(1, math.ceil(round(p * len(v), 9))) - 1]
    pos = p * (len(v) - 1)
    low = math.floor(pos)
    return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (pos - low)


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles_on_skewed_values(spark, accuracy):
    """A third of the rows share one value; a coarse sketch must still give exact ranks."""
    rng = random.Random(7)
    values = [5.0] * 700 + [rng.uniform(0, 10) for _ in range(1400)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(5)
    wanted = {f"{k}_{int(p * 100)}": Quantile("x", p, k) for k in ("disc", "cont") for p in (0.0, 0.25, 0.33, 0.5, 0.75, 1.0)}
    got = exact_quantiles(df, wanted, accuracy).first()
    for alias, q in wanted.items():
        assert math.isclose(got[alias], brute_quantile(values, q.p, q.kind), rel_tol=1e-12), alias


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    row = exact_quantiles(df, {"a": Quantile("x", 0.5), "b": Quantile("y", 0.5)}).first()
    assert (row["a"], row["b"]) == (None, 1.0)


@pytest.mark.parametrize("kind", ["even", "lumps", "powers"])
def test_brackets_hold_few_values_of_ten_million(spark, kind):
    """However coarse the sketch, the window that ranks the last values has at most ``few`` of them."""
    n, few = 10_000_000, 500
    value = {"even": F.col("id").cast("double"), "lumps": F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 7.0),
             "powers": F.pow(F.lit(1.0001), F.col("id") % 700_000)}[kind]
    df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 10 != 9, value).alias("x"))
    wanted = {"a": Quantile("x", 0.25, "disc"), "b": Quantile("x", 0.6, "cont"), "c": Quantile("x", 1.0, "cont")}
    found = brackets(df, wanted, 100, few)
    inside = df.agg(*[F.count_distinct(F.when(F.col("x").between(*found[a]), F.col("x"))).alias(a) for a in wanted]).first()
    assert all(1 <= inside[a] <= few for a in wanted), inside
    if kind == "even":
        k = 2_250_000 - 1  # of nine million values, each ten's first nine
        assert exact_quantiles(df, {"a": wanted["a"]}, 100, few).first()["a"] == k // 9 * 10 + k % 9
