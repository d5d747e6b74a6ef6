"""Numeric expressions whose results do not depend on row order or engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(18,6)"


def round2(value: Column) -> Column:
    """Two decimals, half up, decided on the decimal value instead of its binary neighbour.

    Values no such decimal can hold (very large, NaN) are rounded as doubles.
    """
    return F.coalesce(F.round(value.try_cast(EXACT), 2).cast("double"), F.round(value, 2))


def exact_mean(value: Column) -> Column:
    """Mean of the non-null values, summed as decimals so that partial sums merge in any order.

    A group with a value no such decimal can hold falls back to the mean of doubles.
    """
    exact = value.try_cast(EXACT)
    mean = F.try_divide(F.sum(exact).cast("double"), F.count(value))
    return F.when(F.count(exact) == F.count(value), mean).otherwise(F.avg(value))


def lenient_double(value: Column) -> Column:
    """Numeric parse that gives null for text that is no number."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def clamp_percent(value: Column) -> Column:
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(100.0), value))
    return F.when(value.isNotNull(), round2(bounded))


def far_apart(left: Column, right: Column, tolerance: float = 0.01) -> Column:
    return F.abs(left - right) > tolerance
