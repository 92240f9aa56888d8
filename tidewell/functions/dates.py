"""Calendar keys used by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.numbers import as_col


def month_key(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def day_key(c: Column | str) -> Column:
    return F.to_date(as_col(c))


def quarter_name(c: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_col(c)).cast("string"))


def year_quarter(c: Column | str) -> Column:
    return F.concat_ws("-", F.year(as_col(c)).cast("string"), quarter_name(c))


def in_months(c: Column | str, months: list[tuple[int, int]]) -> Column:
    """True where the date falls in one of the (year, month) pairs."""
    stamp = F.year(as_col(c)) * 100 + F.month(as_col(c))
    return stamp.isin([year * 100 + month for year, month in months])
