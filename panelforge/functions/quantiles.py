"""Exact quantiles without bringing all values to one task.

Spark's ``percentile`` keeps every distinct value of a group in one hash map. Here a small sketch
first brackets each wanted rank; one aggregation then counts what lies below and above the bracket
(collapsed before the shuffle) and keeps single values only inside it. With the default accuracy a
bracket holds about four values in 10,000, whatever the data. Where that can be more than FEW values, the
bracket is counted and sketched again, inside only, until it holds no more, so the window that ranks
the last values is as small for a trillion values as for a million.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most different values that are left for the window that ranks them.
FEW = 100_000


@dataclass(frozen=True)
class Quantile:
    """``kind`` is ``"disc"`` (a value of the data) or ``"cont"`` (linear interpolation)."""

    column: str
    p: float
    kind: str = "disc"

    def __post_init__(self):
        if self.kind not in ("disc", "cont") or not 0 <= self.p <= 1:
            raise ValueError(f"bad quantile {self}")


def _ranks(q: Quantile, n: Column) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank (from 1) and the weight of the upper value."""
    p = F.lit(Decimal(str(q.p)))
    if q.kind == "disc":
        k = F.greatest(F.ceil(p * n), F.lit(1)).cast("bigint")
        return k, k, F.lit(0.0)
    pos = p * (n - 1)
    low = F.floor(pos).cast("bigint")
    return low + 1, F.ceil(pos).cast("bigint") + 1, (pos - low).cast("double")


def _values(wanted: dict[str, Quantile]) -> dict[str, Column]:
    return {a: F.when(~F.isnan(F.col(q.column).cast("double")), F.col(q.column).cast("double")) for a, q in wanted.items()}


def _rank_numbers(q: Quantile, n: int) -> tuple[int, int]:
    """Lower and upper rank, from 1."""
    p = Decimal(str(q.p))
    if q.kind == "disc":
        k = max(math.ceil(p * n), 1)
        return k, k
    return math.floor(p * (n - 1)) + 1, math.ceil(p * (n - 1)) + 1


def brackets(df: DataFrame, wanted: dict[str, Quantile], accuracy: int = 10_000, few: int = FEW) -> dict[str, tuple]:
    """(least, greatest) value around each wanted rank, with at most ``few`` different values in between.

    One pass over ``df``, and two more for each round that narrows a bracket; a round leaves about six
    values in ``accuracy``, so even a trillion values take two.
    """
    slack, values = 2.0 / accuracy, _values(wanted)

    def bounds(within: dict[str, Column], p: dict[str, tuple[float, float]]):
        return df.agg(*[F.struct(
            F.percentile_approx(within[a], max(lo - slack, 0.0), accuracy).alias("lo"),
            F.percentile_approx(within[a], min(hi + slack, 1.0), accuracy).alias("hi"),
            F.count(within[a]).alias("n")).alias(a) for a, (lo, hi) in p.items()]).first()

    first = bounds(values, {a: (q.p, q.p) for a, q in wanted.items()})
    found = {a: (first[a]["lo"], first[a]["hi"]) for a in wanted}
    n = {a: first[a]["n"] for a in wanted}
    wide = [a for a in wanted if n[a] * 6 > few * accuracy]
    while wide:
        inside = {a: F.when(values[a].between(*found[a]), values[a]) for a in wide}
        counts = df.agg(*[F.struct(F.count_if(values[a] < found[a][0]).alias("below"), F.count(inside[a]).alias("inside"))
                          .alias(a) for a in wide]).first()
        wide = [a for a in wide if counts[a]["inside"] > few and found[a][0] < found[a][1]]
        if wide:
            share = {a: tuple((k - counts[a]["below"]) / counts[a]["inside"] for k in _rank_numbers(wanted[a], n[a])) for a in wide}
            narrower = bounds(inside, share)
            for a in list(wide):
                new = narrower[a]["lo"], narrower[a]["hi"]
                if new == found[a]:  # a few values that fill the bracket
                    wide.remove(a)
                found[a] = new
    return found


def exact_quantiles(df: DataFrame, wanted: dict[str, Quantile], accuracy: int = 10_000, few: int = FEW) -> DataFrame:
    """One row with one column per entry of ``wanted``; NULLs and NaNs of a column are left out.

    ``df`` is read twice (sketch, then counts) or more, so pass a staged or cheap frame.
    """
    values = _values(wanted)
    found = brackets(df, wanted, accuracy, few)

    # one row per (value, quantile); the zone is -1 below, 0 inside and 1 above the bracket
    columns = list(dict.fromkeys(q.column for q in wanted.values()))
    tagged = df.select(*columns).select(F.explode(F.array(*[
        F.struct(
            F.lit(a).alias("alias"), values[a].alias("v"),
            F.lit(found[a][0]).cast("double").alias("lo"), F.lit(found[a][1]).cast("double").alias("hi"),
        ) for a in wanted
    ])).alias("t")).select("t.*").filter(F.col("v").isNotNull())
    zone = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    hist = (tagged.withColumn("zone", zone)
            .groupBy("alias", "zone", F.when(F.col("zone") == 0, F.col("v")).alias("inside"))
            .agg(F.count("*").alias("cnt"), F.min("v").alias("least"), F.max("v").alias("most")))

    order = Window.partitionBy("alias").orderBy("zone", "inside")
    ranked = (hist
              .withColumn("upto", F.sum("cnt").over(order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("n", F.sum("cnt").over(Window.partitionBy("alias"))))

    # A rank may sit one place outside the bracket, where it is that zone's extreme value.
    def value_at(k: Column) -> Column:
        first = F.col("upto") - F.col("cnt") + 1
        hit = (F.col("zone") == 0) & k.between(first, F.col("upto"))
        return (F.when(hit, F.col("inside"))
                .when((F.col("zone") == -1) & (k == F.col("upto")), F.col("most"))
                .when((F.col("zone") == 1) & (k == first), F.col("least")))

    out = []
    for a, q in wanted.items():
        mine = F.col("alias") == a
        low, high, weight = _ranks(q, F.col("n"))
        lo_v, hi_v = F.max(F.when(mine, value_at(low))), F.max(F.when(mine, value_at(high)))
        w = F.max(F.when(mine, weight))
        found = lo_v.isNotNull() & hi_v.isNotNull() | (F.count(F.when(mine, 1)) == 0)
        out.append(F.when(found, lo_v + (hi_v - lo_v) * w)
                   .otherwise(F.raise_error(F.lit(f"rank outside the bracket for {a}")).cast("double"))
                   .alias(a))
    return ranked.agg(*out)
