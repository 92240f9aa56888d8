"""Payments and accounts receivable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.dates import in_months, month_key, year_quarter
from tidewell.functions.numbers import money_sum, percent, ratio, round_half_up
from tidewell.plans.reports.shared import n_rows
from tidewell.plans.rollups import PAYMENT_TERMS
from tidewell.sources.warehouse import Warehouse


def _avg_days() -> Column:
    return ratio(F.sum("days_to_pay"), F.count("days_to_pay"))


def _late_pct() -> Column:
    return round_half_up(ratio(F.sum("is_late"), F.count("is_late")) * 100, 1)


def payments_kpis(w: Warehouse) -> DataFrame:
    paid = w["v_payments_clean"].agg(
        n_rows().alias("payments"), money_sum("amount").alias("collected"), _avg_days().alias("avg_days"),
        percent(F.sum("is_late"), F.count("is_late")).alias("late_pct"),
    )
    return paid.crossJoin(w["v_invoices_clean"].agg(n_rows().alias("invoices")))


def dtp_monthly(w: Warehouse) -> DataFrame:
    return w["v_payments_clean"].groupBy(month_key("payment_date").alias("month")).agg(
        _avg_days().alias("avg_days"), _late_pct().alias("late_pct"), n_rows().alias("payments"),
        money_sum("amount").alias("total_collected"),
    )


def dtp_hist(w: Warehouse, limit: int = 120, bins: int = 100) -> DataFrame:
    """Payments by days in (0, limit), with the payment term in its bin."""
    width = limit / bins

    def bin_of(days: Column) -> Column:
        return F.floor(days / width)

    counted = w["v_payments_clean"].filter((F.col("days_to_pay") > 0) & (F.col("days_to_pay") < limit)).groupBy(
        bin_of(F.col("days_to_pay")).alias("bin")
    ).agg(n_rows().alias("n"))
    marker = F
    for days in sorted(PAYMENT_TERMS.values()):
        marker = marker.when(F.col("bin") == bin_of(F.lit(days)), f"Net {days}")
    return counted.withColumn("term_marker", marker)


def _with_customer(w: Warehouse, *columns: str) -> DataFrame:
    """Clean payments with columns of the invoiced clean customer.

    The invoice join keeps only payments with an invoice, so the cutoff is all
    that is left of the view's rules.
    """
    paid = w["payments"].filter(F.col("payment_date") <= F.lit(w.rules.cutoff))
    return paid.join(w["invoices"].select("invoice_id", "customer_id"), "invoice_id").join(
        w["v_customers_clean"].select("customer_id", *columns), "customer_id"
    )


def period_region_compare(w: Warehouse, name: str, months: list[tuple[int, int]]) -> DataFrame:
    period = F.when(in_months("payment_date", months), name).otherwise("Other Periods")
    return _with_customer(w, "region").groupBy(period.alias("period"), "region").agg(
        _avg_days().alias("avg_days"), _late_pct().alias("late_pct"), n_rows().alias("payments")
    )


def period_region_delta(w: Warehouse, name: str, months: list[tuple[int, int]]) -> DataFrame:
    """Regions seen in both the period and the rest, and their difference."""
    wide = period_region_compare(w, name, months).groupBy("region").pivot("period", [name, "Other Periods"]).agg(
        F.max("avg_days")
    )
    inside, outside = F.col(f"`{name}`"), F.col("`Other Periods`")
    return wide.filter(inside.isNotNull() & outside.isNotNull()).select(
        "region", inside.alias("period_days"), outside.alias("baseline_days"),
        round_half_up(inside - outside, 4).alias("delta_days"),
    )


def segment_method_dtp(w: Warehouse) -> DataFrame:
    return _with_customer(w, "segment").groupBy("segment", "method").agg(
        _avg_days().alias("avg_days"), _late_pct().alias("late_pct"), n_rows().alias("payments")
    )


def segment_vs_terms(w: Warehouse) -> DataFrame:
    """Actual days and contractual terms per segment, long form."""
    terms = F
    for segment, days in PAYMENT_TERMS.items():
        terms = terms.when(F.col("segment") == segment, float(days))
    grouped = _with_customer(w, "segment").groupBy("segment").agg(round_half_up(_avg_days(), 1).alias("avg_days"))
    grouped = grouped.withColumn("terms", terms).filter(F.col("terms").isNotNull())
    return grouped.unpivot("segment", ["avg_days", "terms"], "type", "days")


def method_mix(w: Warehouse) -> DataFrame:
    """Year x method; ``avg_days`` is the method's average over all years."""
    yearly = w["v_payments_clean"].groupBy(F.year("payment_date").alias("year"), "method").agg(
        n_rows().alias("payments"), money_sum("amount").alias("volume"), F.sum("days_to_pay").alias("_days")
    )
    of_method = W.partitionBy("method")  # one row per year
    overall = ratio(F.sum("_days").over(of_method), F.sum("payments").over(of_method))
    return yearly.withColumn("avg_days", overall).drop("_days")


def quarterly_ar(w: Warehouse) -> DataFrame:
    return w["v_payments_clean"].groupBy(year_quarter("payment_date").alias("quarter")).agg(
        _avg_days().alias("avg_days"), _late_pct().alias("late_pct")
    )


def invoice_status_year(w: Warehouse) -> DataFrame:
    return w["v_invoices_clean"].groupBy("status", F.year("invoice_date").alias("year")).agg(n_rows().alias("n"))


def orphan_payments(w: Warehouse) -> DataFrame:
    lost = w["payments"].join(w["invoices"].select("invoice_id"), "invoice_id", "left_anti")
    return lost.agg(n_rows().alias("orphan_payments"))
