"""Derived tables and entity rollups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.keyhash import row_key
from tidewell.functions.numbers import as_col, clamp, money_sum, ratio, round_half_up

# Days allowed by segment, probability by stage.
PAYMENT_TERMS = {"enterprise": 60, "mid_market": 45, "smb": 30}
DEFAULT_TERMS = 30
STAGE_PROBABILITY = {
    "prospecting": 10, "qualification": 25, "proposal": 40, "negotiation": 60, "closed_won": 100, "closed_lost": 0,
}
CLOSED_STAGES = ("closed_won", "closed_lost")


def _case(c: Column, mapping: dict[str, int]) -> Column:
    case = F
    for key, value in mapping.items():
        case = case.when(c == key, value)
    return case


# -- payments ---------------------------------------------------------------


def terms_for(segment: Column | str) -> Column:
    return _case(as_col(segment), PAYMENT_TERMS).otherwise(DEFAULT_TERMS)


def due_dates(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the terms of their customer's segment and the due date."""
    return orders.join(customers.select("customer_id", "segment"), "customer_id").withColumns(
        {
            "terms": terms_for("segment"),
            "due_date": F.date_add("order_date", terms_for("segment")),
        }
    )


def late_flag(days_to_pay: Column | str, terms: Column) -> Column:
    return F.when(as_col(days_to_pay) > terms, 1).otherwise(0)


def invoice_status(is_late: Column | str, payment_date: Column | str, end: dt.date) -> Column:
    overdue = (as_col(is_late) == 1) & (as_col(payment_date) > F.lit(end))
    return F.when(overdue, "overdue").otherwise("paid")


# -- orders -----------------------------------------------------------------


def discounted_price(base: Column | str, discount: Column | str) -> Column:
    return round_half_up(as_col(base) * (1 - as_col(discount)), 2)


def line_total(price: Column | str, quantity: Column | str) -> Column:
    return round_half_up(as_col(price) * as_col(quantity), 2)


def order_totals(items: DataFrame) -> DataFrame:
    """Order total = sum of rounded line totals."""
    return items.groupBy("order_id").agg(
        money_sum(line_total("unit_price", "quantity")).alias("order_total"),
        F.count(F.lit(1)).alias("n_lines"),
    )


# -- product usage ----------------------------------------------------------


def feature_adoption(events: DataFrame) -> DataFrame:
    """Per account and module: use span, events, users and depth.

    Counting per user first makes the distinct count a plain count and keeps a
    hot account's rows from meeting before they are reduced.
    """
    per_user = events.groupBy("saas_customer_id", "feature_module", "user_id").agg(
        F.min("event_date").alias("first"), F.max("event_date").alias("last"), F.count(F.lit(1)).alias("n")
    )
    grouped = per_user.groupBy("saas_customer_id", "feature_module").agg(
        F.min("first").cast("date").alias("first_used_date"),
        F.max("last").cast("date").alias("last_used_date"),
        F.sum("n").alias("total_events"),
        F.count(F.lit(1)).alias("monthly_active_users"),
    )
    n = F.col("total_events")
    return grouped.withColumns(
        {
            "adoption_id": row_key("saas_customer_id", "feature_module"),
            "adoption_depth": F.when(n >= 200, "heavy").when(n >= 50, "moderate").when(n >= 10, "light")
            .otherwise("none"),
        }
    ).select(
        "adoption_id", "saas_customer_id", "feature_module", "first_used_date", "last_used_date", "total_events",
        "monthly_active_users", "adoption_depth",
    )


def usage_scores(saas: DataFrame, events: DataFrame, users: DataFrame, as_of: dt.date) -> DataFrame:
    """Score 0..100 from the last 30 days; accounts without events keep theirs."""
    recent = events.filter(F.col("event_date").cast("date") >= F.date_sub(F.lit(as_of), 30))
    per_user = recent.groupBy("saas_customer_id", "user_id", "feature_module").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("duration_seconds").alias("seconds"),
        F.count("duration_seconds").alias("timed"),
    )
    activity = per_user.groupBy("saas_customer_id").agg(
        F.countDistinct("user_id").alias("active"),
        F.countDistinct("feature_module").alias("modules"),
        F.sum("n").alias("events"),
        ratio(F.sum("seconds"), F.sum("timed")).alias("avg_seconds"),
    )
    seats = users.filter(F.col("status") == "active").groupBy("saas_customer_id").agg(
        F.count(F.lit(1)).alias("seats")
    )
    reach = F.least(F.col("active") / F.greatest(F.coalesce("seats", F.lit(1)), F.lit(1)), F.lit(1.0))
    length = F.coalesce(F.col("avg_seconds"), F.lit(0.0)) / 600.0
    points = (
        reach * 35
        + F.col("modules") / 6.0 * 25
        + F.least(F.col("events") / 500.0, F.lit(1.0)) * 25
        + F.least(length, F.lit(1.0)) * 15
    )
    fresh = clamp(points, 0.0, 100.0).cast("int")
    churned = F.col("status") == "churned"
    score = (
        F.when(F.col("events").isNull() & churned & (F.col("usage_score") > 20), 5)
        .when(F.col("events").isNull(), F.col("usage_score"))
        .when(churned, F.least(fresh, F.lit(20)))
        .otherwise(fresh)
    )
    return (
        saas.join(activity, "saas_customer_id", "left").join(seats, "saas_customer_id", "left")
        .select("saas_customer_id", "status", score.alias("usage_score"))
    )


def last_login(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.max("event_date").cast("date").alias("last_login_date"))


# -- recurring revenue ------------------------------------------------------


def mrr_movements(balances: DataFrame, as_of: dt.date) -> DataFrame:
    """Ledger of new / expansion / contraction / churn from monthly balances.

    ``balances`` has one row per (saas_customer_id, month) with a balance;
    a missing month means no balance. A gap closes with ``churn`` in its first
    month and re-opens with ``new``. Windows hold one account's months, which
    the monthly grouping bounds.
    """
    last_month = F.trunc(F.lit(as_of), "month")
    active = balances.filter((F.col("balance") > 0) & (F.col("month") <= last_month))
    by_month = W.partitionBy("saas_customer_id").orderBy("month")
    after = F.add_months("month", 1)
    seen = active.select(
        "saas_customer_id", "month", "balance",
        F.lag("month").over(by_month).alias("prev_month"),
        F.lag("balance").over(by_month).alias("prev_balance"),
        F.lead("month").over(by_month).alias("next_month"),
    )
    follows = F.coalesce(F.col("prev_month") == F.add_months("month", -1), F.lit(False))
    prior = F.when(follows, F.col("prev_balance")).otherwise(0.0)
    kind = (
        F.when(~follows, "new").when(F.col("balance") > prior, "expansion").when(F.col("balance") < prior, "contraction")
    )
    ends = (F.col("next_month").isNull() | (F.col("next_month") > after)) & (after <= last_month)

    def movement(day: Column, type_: Column, old: Column, new: Column) -> Column:
        return F.struct(
            day.alias("movement_date"), type_.alias("movement_type"), round_half_up(new - old, 2).alias("amount"),
            old.alias("previous_mrr"), new.alias("new_mrr"),
        )

    opened = movement(F.col("month"), kind, prior, F.col("balance"))
    closed = movement(after, F.when(ends, "churn"), F.col("balance"), F.lit(0.0))
    rows = seen.select("saas_customer_id", F.inline(F.array(opened, closed)))
    stamp = F.year("movement_date") * 100 + F.month("movement_date")
    return rows.filter(F.col("movement_type").isNotNull()).select(
        (F.col("saas_customer_id") * 1000000 + stamp).alias("movement_id"), "saas_customer_id", "movement_date",
        "movement_type", "amount", "previous_mrr", "new_mrr",
    )


def current_mrr(movements: DataFrame) -> DataFrame:
    """Balance after the last movement; churned where that was a churn."""
    last = movements.groupBy("saas_customer_id").agg(
        F.max_by(F.struct("movement_type", "new_mrr"), "movement_date").alias("last")
    )
    return last.select(
        "saas_customer_id",
        F.col("last.new_mrr").alias("mrr"),
        F.when(F.col("last.movement_type") == "churn", "churned").otherwise("active").alias("status"),
    )


def months_active(movements: DataFrame, saas: DataFrame) -> DataFrame:
    """1-based month index of each movement since the signup month."""
    start = F.trunc("signup_date", "month")
    index = F.months_between("movement_date", start).cast("int") + 1
    return movements.join(saas.select("saas_customer_id", "signup_date"), "saas_customer_id").select(
        "movement_id", "saas_customer_id", "movement_date", "movement_type", index.alias("months_active")
    )


# -- CRM --------------------------------------------------------------------


def account_tier(saas_status: Column | str, usage_score: Column | str, health: Column | str) -> Column:
    at_risk = (as_col(saas_status) == "churned") | (as_col(usage_score) < 30)
    return (
        F.when(at_risk, "at_risk").when(as_col(health) >= 80, "strategic").when(as_col(health) >= 60, "growth")
        .otherwise("maintain")
    )


def account_tiers(accounts: DataFrame, saas: DataFrame) -> DataFrame:
    """Accounts with the tier that their customer's subscription implies."""
    first = _first_row(saas, "customer_id", "saas_customer_id", "status", "usage_score")
    return accounts.join(first, "customer_id", "left").select(
        "account_id", "customer_id", "health_score",
        account_tier("status", "usage_score", "health_score").alias("account_tier"),
    )


def stage_probability(stage: Column | str) -> Column:
    return _case(as_col(stage), STAGE_PROBABILITY)


# -- calendar ---------------------------------------------------------------


def period_table(spark: SparkSession, periods: dict[str, dict], parameter: str | None = None) -> DataFrame:
    """(period, year, month, value): one row per month of each named quarter."""
    rows = []
    for name, spec in periods.items():
        year, quarter = spec["quarter"]
        value = spec.get(parameter) if parameter else None
        rows += [(name, year, 3 * quarter - 2 + i, None if value is None else str(value)) for i in range(3)]
    return spark.createDataFrame(rows, "period string, year int, month int, value string")


def tag_periods(df: DataFrame, date: str, periods: DataFrame) -> DataFrame:
    """Add ``period`` and ``value``; NULL outside every named period."""
    key = (F.year(date) == F.col("_y")) & (F.month(date) == F.col("_m"))
    lookup = periods.withColumnsRenamed({"year": "_y", "month": "_m"})
    return df.join(lookup, key, "left").drop("_y", "_m")


def month_spine(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per month between two dates; the last day is clipped to the end."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return df.withColumn("first_day", F.explode(months)).withColumns(
        {
            "year": F.year("first_day"),
            "month": F.month("first_day"),
            "last_day": F.least(F.last_day("first_day"), F.col(end)),
        }
    )


# -- bridge -----------------------------------------------------------------


def _first_row(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """The row with the smallest ``order`` per key: one row per key, always."""
    first = df.groupBy(key).agg(F.min(F.struct(order, *columns)).alias("_row"))
    return first.select(key, "_row.*")


def customer_xref(t: Mapping[str, DataFrame]) -> DataFrame:
    saas = t["saas_customers"].groupBy("customer_id").agg(F.min("saas_customer_id").alias("saas_customer_id"))
    crm = t["accounts"].groupBy("customer_id").agg(F.min("account_id").alias("account_id"))
    return (
        t["customers"].select("customer_id").join(saas, "customer_id", "left").join(crm, "customer_id", "left")
        .select(
            "customer_id", F.col("customer_id").alias("ecommerce_id"), "saas_customer_id", "account_id",
            F.col("customer_id").alias("payment_customer_id"),
        )
    )


def customer_360(t: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    """One 20-column profile per customer; every side is grouped before it joins."""
    bought = t["orders"].filter(F.col("status") == "completed").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"), money_sum("total_amount").alias("total_revenue")
    )
    # Returns are counted per order first, so a hot order meets its row once.
    per_order = t["returns"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    returned = per_order.join(t["orders"].select("order_id", "customer_id"), "order_id").groupBy("customer_id").agg(
        F.sum("n").alias("total_returns")
    )
    day = F.col("event_date").cast("date")
    per_user = t["usage_events"].groupBy("saas_customer_id", "user_id", "feature_module").agg(
        F.max(day).alias("last_day"), F.sum("duration_seconds").alias("seconds"),
        F.count("duration_seconds").alias("timed"),
    )
    daily = F.countDistinct(F.when(F.col("last_day") >= F.date_sub(F.lit(as_of), 1), F.col("user_id")))
    monthly = F.countDistinct(F.when(F.col("last_day") >= F.date_sub(F.lit(as_of), 30), F.col("user_id")))
    usage = per_user.groupBy("saas_customer_id").agg(
        round_half_up(ratio(daily, monthly), 3).alias("dau_mau_ratio"),
        F.countDistinct("feature_module").alias("features_adopted"),
        round_half_up(ratio(F.sum("seconds"), F.sum("timed")) / 60.0, 1).alias("avg_session_minutes"),
    )
    paid = t["payments"].join(t["invoices"].select("invoice_id", "customer_id"), "invoice_id").groupBy(
        "customer_id"
    ).agg(
        round_half_up(F.avg("days_to_pay"), 1).alias("avg_days_to_pay"),
        round_half_up(ratio(F.sum("is_late"), F.count(F.lit(1))), 4).alias("late_payment_pct"),
    )
    touched = t["activities"].groupBy("account_id").agg(F.max("activity_date").alias("last_activity_date"))
    open_deals = t["opportunities"].filter(~F.col("stage").isin(*CLOSED_STAGES)).groupBy("account_id").agg(
        F.count(F.lit(1)).alias("open_opps")
    )
    saas = _first_row(t["saas_customers"], "customer_id", "saas_customer_id", "plan_tier", "mrr", "usage_score")
    crm = _first_row(t["accounts"], "customer_id", "account_id", "health_score")
    orders, revenue = F.coalesce("total_orders", F.lit(0)), F.coalesce("total_revenue", F.lit(0.0))
    came_back = F.coalesce("total_returns", F.lit(0))
    return (
        t["customers"].select("customer_id", "company_name", "region", "segment")
        .join(bought, "customer_id", "left")
        .join(returned, "customer_id", "left")
        .join(paid, "customer_id", "left")
        .join(saas.join(usage, "saas_customer_id", "left"), "customer_id", "left")
        .join(
            crm.join(touched, "account_id", "left").join(open_deals, "account_id", "left"), "customer_id", "left"
        )
        .select(
            "customer_id", "company_name", "region", "segment",
            orders.alias("total_orders"), revenue.alias("total_revenue"), came_back.alias("total_returns"),
            F.when(orders > 0, round_half_up(ratio(came_back, orders), 4)).otherwise(0.0).alias("return_rate"),
            F.col("plan_tier").alias("saas_plan"), F.col("mrr").alias("saas_mrr"),
            F.col("usage_score").alias("saas_usage_score"),
            "dau_mau_ratio", "features_adopted", "avg_session_minutes", "avg_days_to_pay", "late_payment_pct",
            F.col("health_score").alias("account_health"), "last_activity_date",
            F.coalesce("open_opps", F.lit(0)).alias("open_opportunities"),
            (revenue + F.coalesce("mrr", F.lit(0.0)) * 36).alias("lifetime_value"),
        )
    )
