"""Exact half-up ratios with two decimals.

Dividing first and rounding after would round twice, or inherit the error of a
double, so the quotient is taken on whole numbers. Inputs are non-negative; the
result is null where the denominator is zero.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``round(factor * numerator / denominator, 2)``; ``numerator`` has at most two decimals."""
    hundredths = (numerator.cast("decimal(28,2)") * F.lit(200 * factor).cast("decimal(7,0)")).cast("decimal(38,0)")
    bottom = F.nullif(denominator.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.call_function("div", hundredths + bottom, bottom + bottom) / F.lit(100.0)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``."""
    return ratio(part, whole, factor=100)
