"""Statistics of counts, ordinals, vectors."""

from __future__ import annotations

import math
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z95 = 1.959963984540054


def _olog(o: Column, e: Column) -> Column:
    return F.when(o > 0, o * F.ln(o / e)).otherwise(F.lit(0.0))


def g2(a: Column, b: Column, ta: Column, tb: Column) -> Column:
    """Signed log-likelihood ratio of the 2x2 table: positive only if a's rate is the higher. Totals must be positive and hold their counts."""
    a, b, ta, tb = (x.cast("double") for x in (a, b, ta, tb))
    n, w = ta + tb, a + b
    v = n - w
    ratio = 2 * (_olog(a, ta * w / n) + _olog(ta - a, ta * v / n) + _olog(b, tb * w / n) + _olog(tb - b, tb * v / n))
    return F.when(a / ta > b / tb, ratio).otherwise(-ratio)


def log_ratio(a: Column, b: Column, ta: Column, tb: Column) -> Column:
    """log2 of the ratio of rates, half a count added to each."""
    return F.log2(((a + 0.5) / ta) / ((b + 0.5) / tb))


def log_ratio_error(a: Column, b: Column) -> Column:
    return F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) / F.lit(math.log(2))


def log_ratio_interval(a: Column, b: Column, ta: Column, tb: Column, z: float = Z95) -> Column:
    r, e = log_ratio(a, b, ta, tb), log_ratio_error(a, b)
    return F.struct((r - z * e).alias("low"), (r + z * e).alias("high"))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, by Abramowitz and Stegun 7.1.26 (error at most 1.5e-7)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def chi2_p(x: Column) -> Column:
    """Upper tail of chi squared with one degree of freedom."""
    return erfc(F.sqrt(F.greatest(x, F.lit(0.0)) / 2))


@F.pandas_udf(T.DoubleType())
def chi2_p_exact(x: pd.Series) -> pd.Series:
    """As chi2_p, to double precision."""
    return x.map(lambda v: math.erfc(math.sqrt(max(v, 0.0) / 2)) if v == v else None)


def pmi(pair: Column, a: Column, b: Column, total: Column) -> Column:
    """Pointwise mutual information in bits; null if any count is zero."""
    return F.when((pair > 0) & (a > 0) & (b > 0) & (total > 0), F.log2((pair / total) / ((a / total) * (b / total))))


def ordinal(c: Column, order: list[str], first: int = 1) -> Column:
    """Rank of a label in its order; null for labels that are not in it."""
    table = F.create_map(*chain.from_iterable((F.lit(x), F.lit(i)) for i, x in enumerate(order, first)))
    return F.try_element_at(table, c)


def score_or_label(c: Column, order: list[str]) -> Column:
    """A whole number of 1..len(order), or a label's rank."""
    n = c.try_cast("double")
    return F.coalesce(F.when(n.between(1, len(order)) & (n == F.floor(n)), n.cast("int")), ordinal(c, order))


def whole(c: Column) -> Column:
    """A number text as a long, by way of double, so that '12.0' is 12; null if it is no whole number."""
    n = c.try_cast("double")
    return F.when(n == F.floor(n), n.cast("long"))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(v: Column) -> Column:
    """v over its length; null for zero vectors."""
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def vector(c: Column) -> Column:
    """A vector from JSON text; null if it is malformed or holds null or non-finite parts."""
    v = F.from_json(c, "array<double>")
    return F.when(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), v)


def valid_vector(v: Column, size: int | None = None) -> Column:
    """Not null, of the given size, finite, not zero."""
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == size) if size else ok, F.lit(False))
