"""Arithmetic that the SQL dialect would refuse or null."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def ieee_div(a: Column, b: Column) -> Column:
    """a / b of doubles with the results of IEEE 754 for b = 0: infinities and NaN; null if either is."""
    zero = F.when(F.isnan(a) | (a == 0), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
    return F.when(b == 0, zero).otherwise(F.try_divide(a, b))


def ieee_ln(x: Column) -> Column:
    """Natural logarithm of a double with the results of IEEE 754: -infinity of 0, NaN of less; null of null."""
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan")))


def round_binary(x: Column, digits: int) -> Column:
    """x rounded as DuckDB does: the double x * 10**digits, halves away from zero, over 10**digits.

    ``F.round`` takes the decimal digits that print x instead, so 65.6240625,
    whose product is 65624062.49999999, would go up.
    """
    scale = float(10**digits)
    whole = F.round(x * scale)
    whole = F.when(whole == 0, x * 0.0).otherwise(whole)  # keeps the sign of x, as IEEE has it
    return F.when(F.abs(whole) < float("inf"), whole / scale).otherwise(x)


def sum_over(x: Column, w: WindowSpec) -> Column:
    """Sum of doubles over a window, rounded once instead of at every addition; null without a value.

    Multiples of 2**-20 add without rounding up to 2**33, and what is left of
    each value is so small that rounding in its sum does not reach the result.
    """
    coarse = F.rint(x * float(2**20)) / float(2**20)
    rest = F.when(F.abs(coarse) < float("inf"), x - coarse).otherwise(0.0)
    return F.sum(coarse).over(w) + F.sum(rest).over(w)


def total(*terms: Column) -> Column:
    """Sum in which nulls count as 0."""
    out = F.lit(0.0)
    for term in terms:
        out = out + F.coalesce(term, F.lit(0.0))
    return out
