"""Orders, product mix, discounts and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.dates import month_key, quarter_name
from tidewell.functions.numbers import (
    cents, fixed, fixed_avg, money_avg, money_sum, pct_change, percent, ratio, round_half_up,
)
from tidewell.functions.ranking import quantiles
from tidewell.plans.reports.shared import money_share_of, n_rows, share_of
from tidewell.plans.views import order_lines
from tidewell.sources.warehouse import Warehouse

# Expected orders of a calendar month relative to the mean.
MONTH_TARGETS = {
    1: 0.85, 2: 0.90, 3: 0.95, 4: 1.00, 5: 1.05, 6: 1.10, 7: 0.90, 8: 0.88, 9: 1.05, 10: 1.15, 11: 1.38, 12: 0.95,
}


def month_target(month):
    return F.element_at(F.array(*[F.lit(t) for t in MONTH_TARGETS.values()]), month)


def ecommerce_kpis(w: Warehouse) -> DataFrame:
    orders = w["v_orders_clean"].agg(
        money_sum("total_amount").alias("revenue"),
        n_rows().alias("orders"),
        money_avg("total_amount").alias("aov"),
        (fixed_avg("discount_pct", 4) * 100).alias("avg_discount_pct"),
    )
    returned = w["v_returns_clean"].agg(n_rows().alias("returns"))
    rate = percent(F.col("returns"), F.col("orders"))
    return orders.crossJoin(returned).withColumn("return_rate_pct", rate)


def quarterly_revenue(w: Warehouse) -> DataFrame:
    return w["v_orders_clean"].groupBy(
        F.year("order_date").alias("year"), quarter_name("order_date").alias("quarter")
    ).agg(money_sum("total_amount").alias("revenue"), n_rows().alias("orders"))


def quarterly_pivot(w: Warehouse) -> DataFrame:
    """Year rows, quarter columns, millions rounded to whole ones."""
    quarters = ["Q1", "Q2", "Q3", "Q4"]
    wide = w["v_orders_clean"].withColumn("quarter", quarter_name("order_date")).groupBy(
        F.year("order_date").alias("year")
    ).pivot("quarter", quarters).agg(F.sum(cents("total_amount")))
    return wide.select("year", *[round_half_up(F.col(q) / F.lit(1e8), 0).alias(q) for q in quarters])


def seasonality_index(w: Warehouse) -> DataFrame:
    monthly = w["v_orders_clean"].groupBy(F.month("order_date").alias("month_num")).agg(
        money_avg("total_amount").alias("avg_rev"), n_rows().alias("total_orders")
    )
    mean = F.avg("total_orders").over(W.partitionBy())  # at most twelve rows
    return monthly.withColumns(
        {
            "multiplier": round_half_up(ratio(F.col("total_orders"), mean), 2),
            "target": month_target(F.col("month_num")),
        }
    )


def q2_category_yoy(w: Warehouse) -> DataFrame:
    spring = order_lines(w, "order_date").filter(F.month("order_date").between(4, 6))
    grouped = spring.join(w["products"].select("product_id", "category"), "product_id").groupBy(
        F.year("order_date").alias("year"), "category"
    ).agg(
        money_sum("line_total").alias("revenue"),
        F.countDistinct("order_id").alias("orders"),
        money_avg("unit_price").alias("avg_price"),
    )
    before = F.lag("revenue").over(W.partitionBy("category").orderBy("year"))  # one row per year
    return grouped.withColumn("yoy_pct", pct_change(F.col("revenue"), before))


def category_monthly(w: Warehouse) -> DataFrame:
    lines = order_lines(w, "order_date").join(w["products"].select("product_id", "category"), "product_id")
    return lines.groupBy(month_key("order_date").alias("month"), "category").agg(
        money_sum("line_total").alias("revenue")
    )


def product_mix(w: Warehouse) -> DataFrame:
    lines = w["v_order_items_clean"].join(
        w["products"].select("product_id", "category", "subcategory"), "product_id"
    )
    return lines.groupBy("category", "subcategory").agg(
        money_sum("line_total").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.countDistinct("order_id").alias("orders"),
        money_avg("unit_price").alias("avg_price"),
    )


def top_subcategories(w: Warehouse, top: int = 20) -> DataFrame:
    ranked = product_mix(w).select("category", "subcategory", "revenue")
    return ranked.orderBy(F.desc("revenue"), "category", "subcategory").limit(top)


def category_summary(w: Warehouse) -> DataFrame:
    """Sums over subcategories and the plain mean of their average prices."""
    grouped = product_mix(w).groupBy("category").agg(
        money_sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        round_half_up(F.avg("avg_price"), 4).alias("avg_price"),
    )
    return grouped.withColumn("share_pct", money_share_of("revenue"))


def discount_by_segment(w: Warehouse) -> DataFrame:
    """Mean discount in percent and its five-number summary."""
    rows = w["v_orders_clean"].select("customer_id", "discount_pct").join(
        w["v_customers_clean"].select("customer_id", "segment"), "customer_id"
    ).select("segment", fixed("discount_pct", 4).alias("_bp"))
    # Few thousand distinct steps per segment, counted once for both results.
    counted = rows.filter(F.col("_bp").isNotNull()).groupBy("segment", "_bp").agg(n_rows().alias("_times"))
    spread = quantiles(
        counted, ["segment"], "_bp", {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}, "_times"
    )
    mean = counted.groupBy("segment").agg(
        F.sum("_times").alias("orders"),
        (F.sum(F.col("_bp") * F.col("_times")) / F.lit(10000.0) / F.sum("_times") * 100).alias("mean_pct"),
    )
    return mean.join(spread, "segment").select(
        "segment", "orders", "mean_pct",
        *[
            round_half_up(F.col(p) / F.lit(10000.0), 6).alias(name)
            for p, name in zip(("p0", "p25", "p50", "p75", "p100"), ("minimum", "q1", "median", "q3", "maximum"))
        ],
    )


def monthly_return_rate(w: Warehouse, how: str = "left") -> DataFrame:
    """Returns by return month over orders by order month."""
    returned = w["v_returns_clean"].groupBy(month_key("return_date").alias("month")).agg(
        n_rows().alias("returns"), money_sum("refund_amount").alias("refund_total")
    )
    ordered = w["v_orders_clean"].groupBy(month_key("order_date").alias("month")).agg(n_rows().alias("orders"))
    rate = percent(F.col("returns"), F.col("orders"))
    if how == "inner":
        rate = round_half_up(rate, 2)
    return returned.join(ordered, "month", how).withColumn("return_rate", rate)


def return_reasons(w: Warehouse) -> DataFrame:
    counted = w["v_returns_clean"].groupBy("reason").agg(n_rows().alias("n"))
    return counted.withColumn("share_pct", share_of("n"))


def returns_by_category(w: Warehouse) -> DataFrame:
    """Return x line pairs by category.

    Both sides are counted per order before they meet and the counts are
    multiplied, so an order with many returns and lines makes no pairs.
    """
    per_order = w["returns"].groupBy("order_id").agg(n_rows().alias("_r"), F.sum(cents("refund_amount")).alias("_c"))
    lines = order_lines(w).join(w["products"].select("product_id", "category"), "product_id")
    lines = lines.groupBy("order_id", "category").agg(n_rows().alias("_l"))
    return lines.join(per_order, "order_id").groupBy("category").agg(
        F.sum(F.col("_r") * F.col("_l")).alias("returns"),
        (F.sum(F.col("_c") * F.col("_l")) / F.lit(100.0)).alias("refund_total"),
    )
