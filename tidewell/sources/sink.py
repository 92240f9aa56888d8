"""Write tables and governed views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.catalog import build_schema, coerce_dates


def materialize(
    tables: Mapping[str, DataFrame],
    out: str,
    date_columns: Mapping[str, list[str]] | None = None,
    partition_by: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Overwrite ``{out}/{name}`` per table and report the rows written.

    Each plan runs once, and its rows are counted as they pass to the writer. A
    table without rows replaces an earlier one too, by its columns alone, and is
    reported as empty; a leading underscore is dropped from the name. With
    ``date_columns`` the columns named there are read as dates and all columns
    get warehouse types. ``partition_by`` lists partition columns.
    """
    spark = SparkSession.active()
    report = []
    for name, df in tables.items():
        if date_columns is not None:
            days = date_columns.get(name, [])
            df = build_schema(coerce_dates(df, days), days)
        target = name.lstrip("_")
        seen = Observation(f"rows of {target}")
        writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        if partition_by and partition_by.get(name):
            writer = writer.partitionBy(*partition_by[name])
        writer.parquet(f"{out}/{target}")
        rows = seen.get["n"]
        report.append((target, rows, "written" if rows else "empty"))
    return spark.createDataFrame(report, "table_name string, n_rows bigint, outcome string").orderBy(F.col("table_name"))


def _versions(spark: SparkSession, name: str) -> list[str]:
    """Stored versions of a table, oldest first: their names carry a running number."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name.lower()}__v") and not t.isTemporary)


def refresh(name: str, df: DataFrame, keep: int = 1) -> DataFrame:
    """Drop and recreate a stored table without a moment in which it is missing or half there.

    The rows go to a new stored version, and only when all are written does the
    name, a catalogue view over one version, move to it in one step. A write
    that fails leaves the name where it was and its own version is dropped.
    ``keep`` earlier versions stay, for readers that are still at work; older
    ones are dropped. ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    known = _versions(spark, name)
    number = int(known[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if known else 0
    fresh = f"{name.lower()}__v{number:012d}_{uuid.uuid4().hex[:8]}"
    try:
        df.write.format("parquet").saveAsTable(fresh)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fresh}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    for old in known[:len(known) - keep]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def refresh_view(name: str, df: DataFrame) -> DataFrame:
    """Drop and recreate a view of this session."""
    df.createOrReplaceTempView(name)
    return df
