"""Rounding, rates and moments shared by all queries.

A double is first snapped to 12 decimals, so that 40.675 held as 40.67499999999999716 rounds like
the number that was meant.  Sums that feed a mean are taken over decimals: their result does not
depend on the order in which partitions are merged.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(28,12)"


def snap(x: Column) -> Column:
    return x.cast(SNAP)


def half_up(x: Column, digits: int) -> Column:
    """Rounding of the first stage (SQL ``ROUND``): half away from zero."""
    return F.round(snap(x), digits).cast("double")


def half_even(x: Column, digits: int) -> Column:
    """Rounding of the second stage (means of rates): half to even."""
    return F.bround(snap(x), digits).cast("double")


def ratio(total: Column, count: Column) -> Column:
    """``total / count`` as double, NULL when the count is 0."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def share(part: Column, whole: Column) -> Column:
    """Unrounded percentage, NULL when the whole is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, NULL when the whole is 0."""
    return half_up(share(part, whole), 1)


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    return half_up(ratio(total, count), digits)


def sum_exact(x: Column) -> Column:
    """Order-independent sum of doubles, exact at 12 decimals."""
    return F.sum(snap(x))


def mean_of_rates(rate: Column, digits: int = 1) -> Column:
    """Unweighted mean of one-decimal rates, half to even; NULL over no rows."""
    return half_even(ratio(F.sum(rate.cast("decimal(12,1)")), F.count(rate)), digits)


def stddev_from_moments(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares; NULL for a single value.

    The numerator ``n*sum(x^2) - sum(x)^2`` is a decimal, so equal values give exactly 0 and the
    three moments can be added up across any number of stages.
    """
    spread = n.cast("decimal(18,0)") * squares - total * total
    return F.sqrt(F.try_divide(spread.cast("double"), n.cast("double") * (n.cast("double") - 1.0)))
