"""Subscriptions, recurring revenue, churn and support."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.dates import month_key, year_quarter
from tidewell.functions.numbers import cents, count_if, money_avg, money_sum, percent, ratio, round_half_up
from tidewell.plans.reports.shared import histogram, n_rows
from tidewell.sources.warehouse import Warehouse

MOVEMENT_TYPES = ("new", "expansion", "contraction", "churn")
LOSSES = ("churn", "contraction")


def saas_kpis(w: Warehouse) -> DataFrame:
    active, churned = F.col("status") == "active", F.col("status") == "churned"
    row = w["v_saas_customers_clean"].agg(
        n_rows().alias("subscribers"),
        count_if(active).alias("active"),
        count_if(churned).alias("churned"),
        money_sum(F.when(active, F.col("mrr"))).alias("active_mrr"),
        F.avg(F.when(active, F.col("usage_score"))).alias("avg_usage_score"),
    )
    return row.withColumns(
        {
            "active_pct": percent(F.col("active"), F.col("subscribers")),
            "churned_pct": percent(F.col("churned"), F.col("subscribers")),
        }
    )


def saas_status_churn(w: Warehouse) -> DataFrame:
    """Count by status with the lifetime churn rate on every row."""
    counted = w["v_saas_customers_clean"].groupBy("status").agg(n_rows().alias("n"))
    whole = W.partitionBy()  # one row per status
    churned = F.coalesce(F.sum(F.when(F.col("status") == "churned", F.col("n"))).over(whole), F.lit(0))
    return counted.withColumn("lifetime_churn_pct", percent(churned, F.sum("n").over(whole)))


def plan_status_metrics(w: Warehouse) -> DataFrame:
    return w["v_saas_customers_clean"].groupBy("plan_tier", "status").agg(
        n_rows().alias("customers"),
        money_avg("mrr").alias("avg_mrr"),
        F.avg("usage_score").alias("avg_usage"),
        F.avg("contract_months").alias("avg_contract"),
    )


def plan_mean_of_means(w: Warehouse) -> DataFrame:
    return plan_status_metrics(w).groupBy("plan_tier").agg(
        round_half_up(F.avg("avg_mrr"), 4).alias("avg_mrr"), round_half_up(F.avg("avg_usage"), 4).alias("avg_usage")
    )


def mrr_total(w: Warehouse) -> DataFrame:
    active = w["v_saas_customers_clean"].filter(F.col("status") == "active")
    return active.agg(money_sum("mrr").alias("active_mrr"), (money_sum("mrr") * 12).alias("annualized"))


def mrr_movement_totals(w: Warehouse) -> DataFrame:
    return w["mrr_movements"].groupBy(year_quarter("movement_date").alias("quarter"), "movement_type").agg(
        money_sum("amount").alias("total"), n_rows().alias("movements")
    )


def mrr_waterfall(w: Warehouse) -> DataFrame:
    """Quarter rows, movement columns (losses negative) and their net."""
    wide = w["mrr_movements"].groupBy(year_quarter("movement_date").alias("quarter")).pivot(
        "movement_type", list(MOVEMENT_TYPES)
    ).agg(F.sum(cents("amount")))
    whole = {t: F.coalesce(F.col(t), F.lit(0)) for t in MOVEMENT_TYPES}
    signed = {t: -F.abs(c) if t in LOSSES else c for t, c in whole.items()}
    net = signed["new"] + signed["expansion"] + signed["contraction"] + signed["churn"]
    return wide.select(
        "quarter", *[(c / F.lit(100.0)).alias(t) for t, c in signed.items()], (net / F.lit(100.0)).alias("net")
    )


def churn_monthly(w: Warehouse) -> DataFrame:
    churn = w["mrr_movements"].filter(F.col("movement_type") == "churn")
    return churn.groupBy(month_key("movement_date").alias("month")).agg(
        n_rows().alias("churns"), money_sum(F.abs(F.col("amount"))).alias("lost_mrr")
    )


def churn_tenure(w: Warehouse, low: int = 1, high: int = 36) -> DataFrame:
    """Churns by whole 30-day months since signup, truncated toward zero."""
    churn = w["mrr_movements"].filter(F.col("movement_type") == "churn")
    signup = w["saas_customers"].select("saas_customer_id", "signup_date")
    months = (F.date_diff("movement_date", "signup_date") / 30).cast("int")
    counted = churn.join(signup, "saas_customer_id").groupBy(months.alias("months_active")).agg(
        n_rows().alias("churns")
    )
    return counted.filter(F.col("months_active").between(low, high))


def churn_cliff_share(w: Warehouse) -> DataFrame:
    months, total = F.col("months_active"), F.sum("churns")
    first = F.coalesce(F.sum(F.when(months.between(9, 14), F.col("churns"))), F.lit(0))
    second = F.coalesce(F.sum(F.when(months.between(21, 26), F.col("churns"))), F.lit(0))
    return churn_tenure(w).agg(
        first.alias("cliff_12"), second.alias("cliff_24"), total.alias("total_churn"),
        percent(first, total).alias("cliff_12_pct"), percent(second, total).alias("cliff_24_pct"),
    )


def tickets_monthly_priority(w: Warehouse) -> DataFrame:
    return w["v_support_tickets_clean"].groupBy(month_key("created_date").alias("month"), "priority").agg(
        n_rows().alias("tickets")
    )


def ticket_resolution(w: Warehouse) -> DataFrame:
    return w["support_tickets"].groupBy("category", "priority").agg(
        n_rows().alias("tickets"),
        F.avg("resolution_hours").alias("avg_hours"),
        count_if(F.col("resolved_date").isNull()).alias("unresolved"),
    )


def ticket_categories(w: Warehouse) -> DataFrame:
    return w["v_support_tickets_clean"].groupBy("category").agg(
        n_rows().alias("tickets"), round_half_up(F.avg("resolution_hours"), 1).alias("avg_hours")
    )


def unresolved_rate(w: Warehouse) -> DataFrame:
    open_ = count_if(F.col("resolved_date").isNull())
    return w["support_tickets"].agg(
        n_rows().alias("tickets"), open_.alias("unresolved"), percent(open_, n_rows()).alias("unresolved_pct")
    )


def usage_score_hist(w: Warehouse, bins: int = 40) -> DataFrame:
    scored = w["v_saas_customers_clean"].select("status", "usage_score")
    means = scored.groupBy("status").agg(ratio(F.sum("usage_score"), F.count("usage_score")).alias("mean_score"))
    return histogram(scored, "usage_score", bins, "status").join(means, "status")
