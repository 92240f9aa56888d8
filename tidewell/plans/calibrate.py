"""Calibration checks on raw tables: actual against target.

Columns: metric, actual, target, ok. ``ok`` is NULL where no target is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.numbers import cents, count_if, pct_change, percent, ratio, round_half_up
from tidewell.operators.profile import unpivot
from tidewell.plans.reports.ecommerce import month_target
from tidewell.plans.reports.product import top_share
from tidewell.plans.reports.shared import n_rows
from tidewell.sources.schemas import BASE_TABLES
from tidewell.sources.warehouse import Warehouse

# Expected figures.
TARGETS = {
    "yoy_growth_pct": 8.0, "january_spike_pct": 17.0, "monthly_churn_pct": 2.5, "nrr_pct": 104.0,
    "top20_share_pct": 60.0,
}
MONTH_TOLERANCE = 0.15
AVERAGE_MONTHS_ACTIVE = 18


def _against(actual: Column, target: float | Column | None, tolerance: float | None) -> dict[str, Column]:
    goal = F.lit(None).cast("double") if target is None else (target if isinstance(target, Column) else F.lit(target))
    ok = F.lit(None).cast("boolean") if tolerance is None else F.abs(actual - goal) < F.lit(tolerance)
    return {"actual": actual.cast("double"), "target": goal, "ok": ok}


def row_counts(w: Warehouse, tables: tuple[str, ...] = BASE_TABLES) -> DataFrame:
    rows = None
    for name in tables:
        part = w[name].select(F.lit(name).alias("metric"))
        rows = part if rows is None else rows.union(part)
    counted = rows.groupBy("metric").agg(n_rows().alias("_n"))
    return counted.select("metric", *[c.alias(n) for n, c in _against(F.col("_n"), None, None).items()])


def _completed(w: Warehouse) -> DataFrame:
    return w["orders"].filter(F.col("status") == "completed")


def month_multiplier(w: Warehouse, tolerance: float = MONTH_TOLERANCE) -> DataFrame:
    monthly = _completed(w).groupBy(F.month("order_date").alias("month")).agg(
        F.sum(cents("total_amount")).alias("_c")
    )
    whole = W.partitionBy()  # at most twelve rows
    share = ratio(F.col("_c"), ratio(F.sum("_c").over(whole), n_rows().over(whole)))
    metric = F.concat(F.lit("month_"), F.lpad(F.col("month").cast("string"), 2, "0"))
    marked = monthly.select(metric.alias("metric"), share.alias("_a"), month_target(F.col("month")).alias("_t"))
    return marked.select(
        "metric", *[c.alias(n) for n, c in _against(F.col("_a"), F.col("_t"), tolerance).items()]
    )


def yoy(w: Warehouse, tolerance: float = 5.0) -> DataFrame:
    yearly = _completed(w).groupBy(F.year("order_date").alias("year")).agg(F.sum(cents("total_amount")).alias("_c"))
    growth = pct_change(F.col("_c"), F.lag("_c").over(W.orderBy("year")))  # one row per year
    shown = yearly.select(
        F.concat_ws("_", F.lit("yoy"), F.col("year").cast("string")).alias("metric"), growth.alias("_a")
    ).filter(F.col("_a").isNotNull())
    target = _against(F.col("_a"), TARGETS["yoy_growth_pct"], tolerance)
    return shown.select("metric", *[c.alias(n) for n, c in target.items()])


def _one_row(row: DataFrame, metrics: list[tuple[str, Column, float | None, float | None]]) -> DataFrame:
    return unpivot(row, [(name, _against(a, t, tol)) for name, a, t, tol in metrics], "metric")


def january_returns(w: Warehouse, tolerance: float = 5.0) -> DataFrame:
    """January's returns per completed order against the overall rate.

    Returns are counted per order first, so a hot order joins as one row.
    """
    in_january = F.month("order_date") == 1
    sold = _completed(w).agg(count_if(in_january).alias("jan_orders"), n_rows().alias("all_orders"))
    per_order = w["returns"].groupBy("order_id").agg(n_rows().alias("_n"))
    jan = per_order.join(w["orders"].filter(in_january).select("order_id"), "order_id", "left_semi").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("jan_returns")
    )
    total = w["returns"].agg(n_rows().alias("all_returns"))
    jan_rate = ratio(F.col("jan_returns"), F.greatest(F.col("jan_orders"), F.lit(1)))
    avg_rate = ratio(F.col("all_returns"), F.col("all_orders"))
    return _one_row(
        sold.crossJoin(jan).crossJoin(total),
        [("january_spike_pct", pct_change(jan_rate, avg_rate), TARGETS["january_spike_pct"], tolerance)],
    )


def monthly_churn(w: Warehouse, tolerance: float = 1.0) -> DataFrame:
    paid = F.col("plan_tier") != "free"
    row = w["saas_customers"].agg(
        count_if(paid & (F.col("status") == "churned")).alias("churned"), count_if(paid).alias("paid")
    )
    rate = percent(F.col("churned"), F.col("paid") * AVERAGE_MONTHS_ACTIVE)
    return _one_row(row, [("monthly_churn_pct", rate, TARGETS["monthly_churn_pct"], tolerance)])


def nrr(w: Warehouse, year: int, tolerance: float = 5.0) -> DataFrame:
    """Net revenue retention of one year, all sums in one pass."""
    kind, in_year = F.col("movement_type"), F.year("movement_date") == year

    def total(condition: Column, value: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.abs(cents(value)))), F.lit(0))

    row = w["mrr_movements"].agg(
        total((kind == "new") & (F.year("movement_date") < year), "new_mrr").alias("start"),
        total((kind == "expansion") & in_year, "amount").alias("up"),
        total((kind == "contraction") & in_year, "amount").alias("down"),
        total((kind == "churn") & in_year, "amount").alias("lost"),
    )
    kept = F.col("start") + F.col("up") - F.col("down") - F.col("lost")
    return _one_row(row, [("nrr_pct", percent(kept, F.col("start")), TARGETS["nrr_pct"], tolerance)])


def _paid_orders(w: Warehouse, *columns: str) -> DataFrame:
    return w["payments"].select("invoice_id", "days_to_pay").join(
        w["invoices"].select("invoice_id", "order_id"), "invoice_id"
    ).join(w["orders"].select("order_id", "order_date", *columns), "order_id")


def _avg_days(condition: Column) -> Column:
    return F.avg(F.when(condition, F.col("days_to_pay")))


def _quarter(year: int, quarter: int) -> Column:
    return (F.year("order_date") == year) & (F.quarter("order_date") == quarter)


def region_delay(w: Warehouse, region: str, year: int, quarter: int) -> DataFrame:
    inside = _quarter(year, quarter)
    row = _paid_orders(w, "region").filter(F.col("region") == region).agg(
        _avg_days(inside).alias("a"), _avg_days(~inside).alias("b")
    )
    return _one_row(row, [
        ("period_days", F.col("a"), None, None),
        ("baseline_days", F.col("b"), None, None),
        ("delta_days", round_half_up(F.col("a") - F.col("b"), 4), None, None),
    ])


def quarter_dip(w: Warehouse, year: int) -> DataFrame:
    """Second against first quarter revenue; second-quarter days against last year's."""

    def revenue(quarter: int) -> Column:
        return F.coalesce(F.sum(F.when(_quarter(year, quarter), cents("total_amount"))), F.lit(0))

    sold = _completed(w).agg(revenue(1).alias("q1"), revenue(2).alias("q2"))
    days = _paid_orders(w).agg(_avg_days(_quarter(year, 2)).alias("now"), _avg_days(_quarter(year - 1, 2)).alias("then"))
    return _one_row(sold.crossJoin(days), [
        ("q2_vs_q1_revenue_pct", pct_change(F.col("q2"), F.col("q1")), None, None),
        ("q2_days_to_pay", F.col("now"), None, None),
        ("q2_days_to_pay_last_year", F.col("then"), None, None),
    ])


def module_use(w: Warehouse) -> DataFrame:
    used = w["usage_events"].filter(F.col("feature_module") == w.rules.focus_module).agg(
        n_rows().alias("events"), F.countDistinct("saas_customer_id").alias("accounts")
    )
    active = w["saas_customers"].agg(count_if(F.col("status") == "active").alias("active"))
    return _one_row(used.crossJoin(active), [
        ("module_events", F.col("events"), None, None),
        ("module_accounts", F.col("accounts"), None, None),
        ("module_pct_of_active", percent(F.col("accounts"), F.greatest(F.col("active"), F.lit(1))), None, None),
    ])


def user_concentration(w: Warehouse) -> DataFrame:
    """Top-fifth share over raw events; ok when it reaches the target."""
    raw = w.replacing(v_usage_events_clean=lambda _: w["usage_events"])
    goal = F.lit(TARGETS["top20_share_pct"])
    return top_share(raw).select(
        F.lit("top20_share_pct").alias("metric"), F.col("top_share_pct").alias("actual"), goal.alias("target"),
        (F.col("top_share_pct") >= goal).alias("ok"),
    )
