"""Exclusion rules EX-001..EX-008 as filters, semi and anti joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_nonpositive(df: DataFrame, column: str) -> DataFrame:
    """EX-001 zero and EX-002 negative values."""
    return df.filter(F.col(column) > 0)


def exclude_above(df: DataFrame, column: str, cap: float) -> DataFrame:
    return df.filter(F.col(column) < cap)


def exclude_future(df: DataFrame, column: str, cutoff: dt.date) -> DataFrame:
    """EX-005..EX-007 dates beyond the cutoff."""
    return df.filter(F.col(column) <= F.lit(cutoff))


def exclude_orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """EX-003, EX-004 rows whose key has no parent.

    A hot key sits on the left only (the parent key is unique), which is the
    side AQE can split.
    """
    return df.join(parent.select(key), key, "left_semi")


def mark_known(df: DataFrame, known: DataFrame, key: str, mark: str, known_key: str | None = None) -> DataFrame:
    """All rows, with ``mark``: whether the key is among the known ones.

    The existence join behind counts of what a rule keeps: kept and excluded
    rows are told apart in one pass. Known keys are made distinct, so no row
    multiplies, and a hot key sits on the left only.
    """
    keys = known.select(F.col(known_key or key).alias("_met")).distinct()
    marked = df.join(keys, F.col(key) == F.col("_met"), "left")
    return marked.withColumn(mark, F.col("_met").isNotNull()).drop("_met")


def exclude_listed(df: DataFrame, listed: DataFrame, key: str, listed_key: str) -> DataFrame:
    """EX-008 rows whose id is in a tracking table; its key is never NULL."""
    return df.join(listed.select(F.col(listed_key).alias(key)), key, "left_anti")


def exclude_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def govern(
    df: DataFrame, rules: dict[str, Callable[[DataFrame], DataFrame]], lift: list[str] | tuple[str, ...] = ()
) -> DataFrame:
    """Apply the named exclusions except lifted ones and label the result."""
    for name, rule in rules.items():
        if name not in lift:
            df = rule(df)
    label = "including excluded records" if lift else "governed"
    return df.withColumn("data_scope", F.lit(label))
