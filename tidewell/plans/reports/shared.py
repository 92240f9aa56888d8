"""Steps several reports share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.numbers import cents, percent


def n_rows() -> Column:
    return F.count(F.lit(1))


def share_of(value: str, *within: str) -> Column:
    """Percent of the group's total, over already grouped rows.

    The window sees one row per category of a report, never table rows.
    """
    return percent(F.col(value), F.sum(value).over(W.partitionBy(*within)))


def money_share_of(value: str, *within: str) -> Column:
    whole = F.sum(cents(value)).over(W.partitionBy(*within)) / F.lit(100.0)
    return percent(F.col(value), whole)


def histogram(df: DataFrame, column: str, bins: int, *by: str) -> DataFrame:
    """Equal-width bins between the overall minimum and maximum.

    Distinct values are counted first; only those counts are binned.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(n_rows().alias("_n"))
    # One aggregate row, so the broadcast has a fixed size.
    edges = counted.agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    slot = F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)), F.lit(0))
    return (
        counted.crossJoin(F.broadcast(edges))
        .groupBy(*by, F.least(slot, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("_n").alias("n"))
    )
