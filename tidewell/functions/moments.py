"""Exact mean and deviation of whole numbers.

A sum of squares of doubles depends on the order in which tasks finish. Here a
square is cut into limbs of 24 bits, each summed as a long inside generated
code, and the sums are put together once, in one decimal per column. Numbers
may be as large as 2**52; limb sums have room for 2**38 rows, beyond which ANSI
mode raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 24
_MASK = (1 << _BITS) - 1


def _limbs(x: Column) -> tuple[Column, Column, Column]:
    """x * x as three whole numbers, in steps of 1, 2**24 and 2**48."""
    high, low = F.shiftright(x, _BITS), x.bitwiseAND(F.lit(_MASK).cast("bigint"))
    square, cross = low * low, high * low * 2
    mask = F.lit(_MASK).cast("bigint")
    return (
        square.bitwiseAND(mask),
        F.shiftright(square, _BITS) + cross.bitwiseAND(mask),
        high * high + F.shiftright(cross, _BITS),
    )


def moments(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row with ``<name>_n, <name>_sum, <name>_squares`` of each whole-numbered expression, NULLs left out.

    Sums are exact: a long for the numbers, a decimal for their squares.
    """
    rows = df.select(*[c.cast("bigint").alias(name) for name, c in columns.items()])
    sums = []
    for name in columns:
        sums += [F.count(name).alias(f"{name}_n"), F.sum(name).alias(f"{name}_sum")]
        sums += [F.sum(limb).alias(f"_{name}_{k}") for k, limb in enumerate(_limbs(F.col(name)))]
    whole = rows.agg(*sums)

    def step(name: str, k: int) -> Column:
        return F.col(f"_{name}_{k}").cast("decimal(20,0)") * F.lit(1 << (_BITS * k)).cast("decimal(15,0)")

    return whole.select(*[c for name in columns for c in (
        F.col(f"{name}_n"), F.col(f"{name}_sum"), (step(name, 0) + step(name, 1) + step(name, 2)).cast("decimal(38,0)").alias(f"{name}_squares"),
    )])


def mean_and_deviation(name: str) -> tuple[Column, Column]:
    """Mean and population deviation from the sums of ``moments``, as doubles."""
    n = F.col(f"{name}_n").cast("double")
    mean = F.try_divide(F.col(f"{name}_sum").cast("double"), n)
    square = F.try_divide(F.col(f"{name}_squares").cast("double"), n)
    return mean, F.sqrt(F.greatest(square - mean * mean, F.lit(0.0)))


def threshold(df: DataFrame, value: Column, sigmas: float) -> Column:
    """Mean plus ``sigmas`` deviations of a whole-numbered expression, as a single value of a plan."""
    mean, deviation = mean_and_deviation("x")
    return moments(df, {"x": value}).select(mean + sigmas * deviation).scalar()
