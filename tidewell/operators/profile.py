"""Data-quality profiling. One aggregate pass per table, then an unpivot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.moments import mean_and_deviation, moments
from tidewell.functions.numbers import count_if, fixed, percent, round_half_up
from tidewell.operators.flags import MOJIBAKE
from tidewell.operators.normalize import REGION_VARIANTS
from tidewell.sources.warehouse import Warehouse


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def unpivot(row: DataFrame, entries: list[tuple[str, dict[str, Column]]], key: str) -> DataFrame:
    """One output row per entry of a one-row aggregate."""
    structs = [
        F.struct(F.lit(name).alias(key), *[c.alias(n) for n, c in columns.items()]) for name, columns in entries
    ]
    return row.select(F.inline(F.array(*structs)))


def with_excluded_share(counts: DataFrame) -> DataFrame:
    """Counts of raw and clean rows with the excluded ones in percent; 0 where there are none at all."""
    excluded = F.col("raw_rows") - F.col("clean_rows")
    pct = F.coalesce(round_half_up(percent(excluded, F.col("raw_rows")), 2), F.lit(0.0))
    return counts.withColumns({"excluded": excluded, "excluded_pct": pct})


def raw_vs_clean(raw: DataFrame, clean: DataFrame) -> DataFrame:
    counts = _rows(raw).withColumnRenamed("n", "raw_rows").crossJoin(_rows(clean).withColumnRenamed("n", "clean_rows"))
    return with_excluded_share(counts)


def null_rates(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """NULL share in percent of every column that has NULLs, over all rows."""
    names = columns or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.col(c).isNull()).alias(c) for c in names])
    rates = [(c, {"null_pct": round_half_up(percent(F.col(c), F.col("_n")), 2)}) for c in names]
    found = unpivot(row, rates, "column_name").filter(F.col("null_pct") > 0)
    return found.select(F.lit(table).alias("table_name"), "column_name", "null_pct")


def completeness_alert(df: DataFrame, table: str, limit: float = 5.0) -> DataFrame:
    return null_rates(df, table).withColumn("alert", F.col("null_pct") > limit)


def orphan_rate(df: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """Rows without a parent. Keys are counted first, so each joins once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(key).alias("_parent"))
    joined = per_key.join(known, F.col(key) == F.col("_parent"), "left")
    counts = joined.agg(
        F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("_n"))), F.lit(0)).alias("orphans"),
        F.sum("_n").alias("n_rows"),
    )
    return counts.select(
        F.lit(relation).alias("relation"), "orphans", "n_rows",
        round_half_up(percent(F.col("orphans"), F.col("n_rows")), 4).alias("orphan_pct"),
    )


def outlier_counts(df: DataFrame, columns: list[str], sigmas: float = 3.0, digits: int = 2) -> DataFrame:
    """Values further than ``sigmas`` standard deviations from the mean, in whole steps of 10**-``digits``."""
    whole = {c: fixed(c, digits) for c in columns}
    # One row of sums, so the broadcast has a fixed size.
    bounds = moments(df, whole).select(*[x.alias(f"_{kind}_{c}") for c in columns for kind, x in zip("ms", mean_and_deviation(c))])
    row = df.crossJoin(F.broadcast(bounds)).agg(
        *[count_if(F.abs(whole[c] - F.col(f"_m_{c}")) > sigmas * F.col(f"_s_{c}")).alias(c) for c in columns]
    )
    return unpivot(row, [(c, {"outliers": F.col(c)}) for c in columns], "column_name")


def encoding_counts(df: DataFrame, column: str) -> DataFrame:
    names = list(MOJIBAKE.values())
    row = df.agg(*[count_if(F.contains(F.col(column), F.lit(p))).alias(f"p{i}") for i, p in enumerate(names)])
    return unpivot(row, [(p, {"n_rows": F.col(f"p{i}")}) for i, p in enumerate(names)], "pattern")


def future_counts(tables: dict[str, DataFrame], columns: list[tuple[str, str]], cutoff: dt.date) -> DataFrame:
    report = None
    for table, column in columns:
        row = tables[table].agg(count_if(F.col(column) > F.lit(cutoff)).alias("n_future")).select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "n_future"
        )
        report = row if report is None else report.unionByName(row)
    return report


def duplicate_count(tracking: DataFrame, customers: DataFrame) -> DataFrame:
    """Tracked duplicates; clusters of equal name and region and the rows in them."""
    sizes = customers.groupBy(F.upper(F.trim("company_name")).alias("_norm"), "region").agg(F.count(F.lit(1)).alias("_size"))
    # no filter: it would be pushed into the names' making; see ``flags._emit``
    shared = F.when(F.col("_norm").isNotNull() & (F.col("_size") > 1), F.col("_size"))
    found = sizes.agg(F.count(shared).alias("clusters"), F.coalesce(F.sum(shared), F.lit(0)).alias("clustered_rows"))
    return tracking.agg(F.count(F.lit(1)).alias("tracked")).crossJoin(found)


def value_variants(raw: DataFrame, clean: DataFrame, column: str = "region") -> DataFrame:
    """Distinct values before and after governance, marked canonical or variant."""
    mark = F.when(F.col(column).isin(*REGION_VARIANTS), "canonical").otherwise("variant")

    def counted(df: DataFrame, phase: str) -> DataFrame:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(phase).alias("phase"), F.col(column).alias("value"), "n", mark.alias("mark")
        )

    return counted(raw, "raw").unionByName(counted(clean, "governed"))


def page_callouts(w: Warehouse) -> DataFrame:
    """Numbers behind the quality note of each report page."""
    future = F.col("payment_date") > F.lit(w.rules.cutoff)
    notes = [
        ("e-commerce", "zero_price_lines", w["order_items"], F.col("unit_price") == 0),
        ("e-commerce", "returns_without_reason", w["returns"], F.col("reason").isNull()),
        ("subscriptions", "open_tickets", w["support_tickets"], F.col("resolved_date").isNull()),
        ("product", "events_without_session", w["usage_events"], F.col("session_id").isNull()),
        ("product", "adoption_without_last_use", w["feature_adoption"], F.col("last_used_date").isNull()),
        ("payments", "future_payments", w["payments"], future),
    ]
    report = None
    for page, name, df, condition in notes:
        row = df.agg(count_if(condition).alias("n")).select(
            F.lit(page).alias("page"), F.lit(name).alias("callout"), "n"
        )
        report = row if report is None else report.unionByName(row)
    return report
