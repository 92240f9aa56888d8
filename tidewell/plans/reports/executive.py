"""Executive summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.dates import month_key
from tidewell.functions.numbers import count_if, fixed_avg, money_avg, money_sum, pct_change, round_half_up
from tidewell.plans.reports.shared import money_share_of, n_rows, share_of
from tidewell.plans.rollups import CLOSED_STAGES
from tidewell.sources.warehouse import Warehouse


def exec_kpis(w: Warehouse) -> DataFrame:
    """Six figures in one row; each view is read once."""
    orders = w["v_orders_clean"].agg(money_sum("total_amount").alias("total_rev"), n_rows().alias("total_orders"))
    customers = w["v_customers_clean"].agg(n_rows().alias("total_cust"))
    active = F.col("status") == "active"
    saas = w["v_saas_customers_clean"].agg(
        count_if(active).alias("active_saas"), money_sum(F.when(active, F.col("mrr"))).alias("total_mrr")
    )
    is_open = ~F.col("stage").isin(*CLOSED_STAGES)
    deals = w["v_opportunities_clean"].agg(money_sum(F.when(is_open, F.col("amount"))).alias("pipeline"))
    return orders.crossJoin(customers).crossJoin(saas).crossJoin(deals)


def monthly_revenue(w: Warehouse) -> DataFrame:
    return w["v_orders_clean"].groupBy(month_key("order_date").alias("month")).agg(
        money_sum("total_amount").alias("revenue"),
        n_rows().alias("orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        money_avg("total_amount").alias("avg_order_value"),
        fixed_avg("discount_pct", 4).alias("avg_discount"),
    )


def yoy_performance(w: Warehouse) -> DataFrame:
    yearly = w["v_orders_clean"].groupBy(F.year("order_date").alias("year")).agg(
        money_sum("total_amount").alias("revenue"),
        n_rows().alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        money_avg("total_amount").alias("aov"),
        (fixed_avg("discount_pct", 4) * 100).alias("avg_discount_pct"),
    )
    by_year = W.orderBy("year")  # one row per year
    return yearly.withColumns(
        {
            "rev_growth": pct_change(F.col("revenue"), F.lag("revenue").over(by_year)),
            "order_growth": pct_change(F.col("orders"), F.lag("orders").over(by_year)),
        }
    )


def region_share(w: Warehouse) -> DataFrame:
    by_region = w["v_orders_clean"].groupBy("region").agg(money_sum("total_amount").alias("revenue"))
    return by_region.withColumn("share_pct", money_share_of("revenue"))


def region_year_share(w: Warehouse) -> DataFrame:
    grouped = w["v_orders_clean"].groupBy(F.year("order_date").alias("year"), "region").agg(
        money_sum("total_amount").alias("revenue"),
        n_rows().alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
    )
    return grouped.withColumn("share_pct", money_share_of("revenue", "year"))


MIX_DIMENSIONS = ("segment", "industry", "region", "acquisition_channel", "status")


def customer_mix(w: Warehouse) -> DataFrame:
    """Count and percent per value of each dimension, from one pass.

    Combinations are counted first, so the unpivot works on few rows.
    """
    combos = w["v_customers_clean"].groupBy(*MIX_DIMENSIONS).agg(n_rows().alias("_n"))
    cells = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in MIX_DIMENSIONS]
    )
    counted = combos.select(F.inline(cells), "_n").groupBy("dimension", "value").agg(F.sum("_n").alias("n"))
    return counted.withColumn("share_pct", share_of("n", "dimension"))


def status_by_segment(w: Warehouse) -> DataFrame:
    return w["v_customers_clean"].groupBy("segment", "status").agg(n_rows().alias("n"))


def acquisition_monthly(w: Warehouse) -> DataFrame:
    return w["v_customers_clean"].groupBy(month_key("acquisition_date").alias("month")).agg(
        n_rows().alias("new_customers")
    )


def acquisition_yearly(w: Warehouse) -> DataFrame:
    return w["v_customers_clean"].groupBy(F.year("acquisition_date").alias("year")).agg(
        n_rows().alias("new_customers")
    )


def c360_top_ltv(w: Warehouse, top: int = 10) -> DataFrame:
    profile = w["customer_360"].filter(F.col("lifetime_value") > 0)
    best = profile.orderBy(F.desc("lifetime_value"), "customer_id").limit(top)
    return best.select(
        "customer_id", "company_name", "region", "segment", "total_orders",
        round_half_up("total_revenue", 0).alias("revenue"), "saas_plan", "account_health",
        round_half_up("lifetime_value", 0).alias("ltv"),
    )


def c360_bottom_health(w: Warehouse, top: int = 10) -> DataFrame:
    profile = w["customer_360"].filter(F.col("account_health").isNotNull())
    worst = profile.orderBy("account_health", "customer_id").limit(top)
    return worst.select(
        "customer_id", "company_name", "region", "segment", "account_health", "saas_plan",
        round_half_up(F.col("late_payment_pct") * 100, 1).alias("late_pct"), "total_returns", "return_rate",
    )
