"""Normalisation NRM-001..NRM-004 and display texts IMP-001..IMP-010."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import as_col, cents
from tidewell.functions.ranking import quantiles
from tidewell.sources.schemas import schema

# Accepted spellings of each canonical region, compared after
# trimming and upper-casing.
REGION_VARIANTS: dict[str, tuple[str, ...]] = {
    "North America": ("NORTH AMERICA", "N. AMERICA", "NA", "NORTH_AMERICA", "NORTHAMERICA"),
    "Europe": ("EUROPE", "EU", "EMEA"),
    "APAC": ("APAC", "ASIA PACIFIC", "ASIA-PACIFIC", "AP"),
    "LATAM": ("LATAM", "LATIN AMERICA", "SOUTH AMERICA"),
}
UNKNOWN_REGION = "Unknown"

# Text shown for a NULL.
DISPLAY_TEXT: dict[str, str] = {
    "ship_date": "Pending",
    "reason": "Not recorded",
    "resolved_date": "Open",
    "resolution_hours": "N/A",
    "notes": "No notes recorded",
    "last_contact_date": "Not on file",
    "next_renewal_date": "TBD",
    "session_id": "No session",
    "duration_seconds": "N/A",
    "last_used_date": "Unknown",
}


def norm_name(c: Column | str) -> Column:
    return F.upper(F.trim(as_col(c)))


def trim_text(c: Column | str) -> Column:
    return F.trim(as_col(c))


def coalesce0(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def region_mapping(spark: SparkSession) -> DataFrame:
    rows = [(v, canonical) for canonical, variants in REGION_VARIANTS.items() for v in variants]
    return spark.createDataFrame(rows, schema("region_mapping"))


def standardize(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace ``column`` by its canonical value, ``Unknown`` where none is known.

    ``mapping`` is the short (variant, canonical) lookup. It is left to the
    optimizer to broadcast it, which it does up to the size threshold.
    """
    variant = F.upper(F.trim(F.col(column)))
    canonical = F.coalesce(F.col("_canonical"), F.lit(UNKNOWN_REGION))
    lookup = mapping.select(F.col("variant").alias("_variant"), F.col("canonical").alias("_canonical"))
    return (
        df.join(lookup, variant == F.col("_variant"), "left")
        .withColumn(column, canonical)
        .drop("_variant", "_canonical")
    )


def region_case(c: Column | str) -> Column:
    """The same mapping as one CASE expression for ad-hoc use."""
    spelled = F.upper(F.trim(as_col(c)))
    case = F
    for canonical, variants in REGION_VARIANTS.items():
        case = case.when(spelled.isin(*variants), canonical)
    return case.otherwise(UNKNOWN_REGION)


def cap_percentile(df: DataFrame, column: str, p: float, name: str) -> DataFrame:
    """NRM-003: add ``name`` = ``column`` capped at its exact p-quantile (in cents)."""
    cap = quantiles(df.select(cents(column).alias("_cents")), [], "_cents", {"_cap": p}).scalar()
    return df.withColumn(name, F.least(F.col(column), cap / 100.0))


def display(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Add ``<column>_display``; the stored value keeps its NULL."""
    return df.withColumns(
        {f"{c}_display": F.coalesce(F.col(c).cast("string"), F.lit(text)) for c, text in texts.items()}
    )


def null_semantics(df: DataFrame, column: str) -> DataFrame:
    """All rows, rows with a value, and the average that ignores NULLs."""
    return df.agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.count(column).alias("rows_with_value"),
        F.avg(column).alias("avg_of_values"),
    )
