"""Exact money sums, rounding and shares.

Sums of doubles depend on the order in which tasks finish, so money is summed
in whole cents: exact, repeatable and as cheap as a double sum. ANSI mode
raises on overflow (9.2e16 currency units in one group) instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    factor = float(10**digits)
    return F.floor(as_col(c) * factor + 0.5) / F.lit(factor)


def fixed(c: Column | str, digits: int) -> Column:
    """The value as a whole number of 10**-digits steps."""
    return F.floor(as_col(c) * 10**digits + 0.5)


def fixed_avg(c: Column | str, digits: int) -> Column:
    """Average of a column that carries at most ``digits`` decimals."""
    return F.try_divide(F.sum(fixed(c, digits)) / F.lit(float(10**digits)), F.count(as_col(c)))


def cents(c: Column | str) -> Column:
    return fixed(c, 2)


def money_sum(c: Column | str) -> Column:
    return F.sum(cents(c)) / F.lit(100.0)


def money_avg(c: Column | str) -> Column:
    return F.try_divide(money_sum(c), F.count(as_col(c)))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def pct_change(current: Column, previous: Column) -> Column:
    return F.try_divide(current.cast("double") - previous, previous.cast("double")) * 100


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))
