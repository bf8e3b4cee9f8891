"""Number parsing, guarded arithmetic and banding as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.text import col_of

_WHOLE_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def to_int(c: str | Column) -> Column:
    """Text to int, dropping decimals; anything else is NULL (never an ANSI error)."""
    digits = F.regexp_extract(col_of(c).cast("string"), _WHOLE_PART, 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def to_metric(c: str | Column) -> Column:
    """Text to bigint: a decimal tail of zeros goes first, then the separators.

    Three zeros after a dot are a thousands group ('1.000' is one thousand).
    """
    text = F.trim(col_of(c))
    text = F.regexp_replace(text, r"\.(0|00|0{4,})$", "")
    return F.nullif(F.regexp_replace(text, r"[,.]", ""), F.lit("")).try_cast("bigint")


def to_double(c: str | Column) -> Column:
    """Numeric coercion: unparsable text and NaN are NULL."""
    value = col_of(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def within(c: str | Column, low: int, high: int) -> Column:
    return F.when(col_of(c).between(low, high), col_of(c))


def one_of(c: str | Column, allowed: Sequence) -> Column:
    return F.when(col_of(c).isin(*allowed), col_of(c))


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den where den > 0, else NULL."""
    num, den = col_of(num), col_of(den)
    return F.when(den > 0, num / den)


def clip(c: str | Column, low: float, high: float) -> Column:
    """Into [low, high]; NULL stays NULL."""
    c = col_of(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(high)), F.lit(low)))


def min_max(c: str | Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; 0 when the column is constant."""
    return F.when(high > low, (col_of(c) - low) / (high - low)).otherwise(F.lit(0.0))


def band_above(c: str | Column, bands: Sequence[tuple[float, str]], rest: str) -> Column:
    """First label whose bound the value exceeds; bounds in descending order."""
    expr = None
    for bound, label in bands:
        test = col_of(c) > bound
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(rest))


def pearson(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation as an aggregate; NULL where a side does not vary."""
    x, y = col_of(x), col_of(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def least_squares(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """Slope and intercept of the degree-1 fit as aggregates; NULL where x does not vary."""
    x, y = col_of(x), col_of(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    return slope, F.avg(y) - slope * F.avg(x)
