"""Product usage, power users and feature adoption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.dates import day_key, month_key
from tidewell.functions.numbers import count_if, money_avg, percent, ratio
from tidewell.functions.ranking import cumulate, positions, quantiles
from tidewell.plans.reports.shared import n_rows
from tidewell.sources.warehouse import Warehouse

DEPTHS = ("none", "light", "moderate", "heavy")


def product_kpis(w: Warehouse) -> DataFrame:
    """Clean events, users, accounts and modules; raw events of the focus module.

    Rows are counted per (user, account, module) first: the three distinct
    counts then expand that small frame, not the events.
    """
    is_clean = F.col("session_id").isNotNull()
    combos = w["usage_events"].groupBy("user_id", "saas_customer_id", "feature_module").agg(
        count_if(is_clean).alias("_clean"), n_rows().alias("_raw")
    )

    def distinct(column: str) -> Column:
        return F.countDistinct(F.when(F.col("_clean") > 0, F.col(column)))

    focus = F.when(F.col("feature_module") == w.rules.focus_module, F.col("_raw"))
    return combos.agg(
        F.sum("_clean").alias("events"), distinct("user_id").alias("users"),
        distinct("saas_customer_id").alias("accounts"), distinct("feature_module").alias("modules"),
        F.coalesce(F.sum(focus), F.lit(0)).alias("focus_events"),
    )


def engagement(w: Warehouse, period: str = "month") -> DataFrame:
    """Events, users, accounts, sessions and mean minutes by month or day."""
    key = month_key("event_date") if period == "month" else day_key("event_date")
    combos = w["v_usage_events_clean"].groupBy(
        key.alias(period), "user_id", "saas_customer_id", "session_id"
    ).agg(
        n_rows().alias("_n"), F.sum("duration_seconds").alias("_seconds"), F.count("duration_seconds").alias("_timed")
    )
    return combos.groupBy(period).agg(
        F.sum("_n").alias("events"),
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("saas_customer_id").alias("active_accounts"),
        F.countDistinct("session_id").alias("sessions"),
        (ratio(F.sum("_seconds"), F.sum("_timed")) / 60.0).alias("avg_session_min"),
    )


def _users(w: Warehouse) -> DataFrame:
    """Counted per session first: whatever reads the users, with or without sessions, shares that one exchange of the events."""
    sessions = w["v_usage_events_clean"].groupBy("user_id", "session_id").agg(n_rows().alias("_n"))
    return sessions.groupBy("user_id").agg(F.sum("_n").alias("events"), n_rows().alias("sessions"))


def _levels(users: DataFrame) -> DataFrame:
    """One row per event count: how many users have it, and what lies above.

    d distinct counts need d*(d+1)/2 events, so N events give at most
    sqrt(2*N) rows.
    """
    levels = users.groupBy("events").agg(n_rows().alias("n_users")).withColumns(
        {"_down": -F.col("events"), "_load": F.col("events") * F.col("n_users")}
    )
    levels = cumulate(levels, [], "_down", "n_users", "users_above")
    return cumulate(levels, [], "_down", "_load", "events_above")


def pareto_users(w: Warehouse) -> DataFrame:
    """Users by events, most active first, with running shares."""
    return _ranked_users(_users(w))


def _ranked_users(users: DataFrame) -> DataFrame:
    ranked = positions(users.withColumn("_down", -F.col("events")), [], ["_down", "user_id"], "rank")
    above = _levels(users).select("events", "users_above", "events_above")
    running = F.col("events_above") + F.col("events") * (F.col("rank") - F.col("users_above"))
    # ``above`` grows with the square root of the events: the join's strategy is left to its measured size.
    return ranked.join(above, "events").select(
        "user_id", "events", "sessions", "rank",
        percent(running, users.agg(F.sum("events")).scalar()).alias("cumulative_pct"),
        percent(F.col("rank"), users.agg(n_rows()).scalar()).alias("user_rank_pct"),
    )


def pareto_sample(w: Warehouse, points: int = 200) -> DataFrame:
    """Every k-th ranked user, k = max(1, users // points): a curve to draw."""
    users = _users(w)
    step = users.agg(F.greatest(F.lit(1), F.floor(n_rows() / points))).scalar()
    picked = _ranked_users(users).filter(F.pmod(F.col("rank") - 1, step) == 0)
    return picked.select("rank", "user_rank_pct", "cumulative_pct")


def top_share(w: Warehouse, share: float = 0.2) -> DataFrame:
    """Share of events that the top fifth of users make; needs no user ranks."""
    levels = _levels(_users(w))
    totals = levels.agg(F.sum("n_users").alias("n_users"), F.sum("_load").alias("n_events"))
    top = F.floor(F.col("_n_all") * share)
    taken = F.least(F.greatest(top - F.col("users_above"), F.lit(0)), F.col("n_users"))
    joined = levels.crossJoin(
        F.broadcast(totals.withColumnsRenamed({"n_users": "_n_all", "n_events": "_e_all"}))
    )
    return joined.agg(
        F.max(top).alias("top_users"),
        F.sum(taken * F.col("events")).alias("top_events"),
        F.max("_e_all").alias("all_events"),
    ).withColumn("top_share_pct", percent(F.col("top_events"), F.col("all_events")))


def user_event_stats(w: Warehouse) -> DataFrame:
    counts = w["v_usage_events_clean"].groupBy("user_id").agg(n_rows().alias("events")).groupBy("events").agg(
        n_rows().alias("_times")
    )
    middle = quantiles(counts, [], "events", {"median_events": 0.5}, "_times")
    rest = counts.agg(
        F.sum("_times").alias("n_users"),
        ratio(F.sum(F.col("events") * F.col("_times")), F.sum("_times")).alias("mean_events"),
        F.max("events").alias("max_events"),
    )
    return rest.crossJoin(middle)


def adoption_depth(w: Warehouse) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(d) for d in DEPTHS]), F.col("adoption_depth")).cast("int")
    grouped = w["v_feature_adoption_clean"].groupBy("feature_module", "adoption_depth").agg(
        n_rows().alias("accounts"),
        F.avg("total_events").alias("avg_events"),
        F.avg("monthly_active_users").alias("avg_mau"),
    )
    return grouped.withColumn("depth_order", order)


def event_types(w: Warehouse) -> DataFrame:
    return w["v_usage_events_clean"].groupBy("event_type").agg(
        n_rows().alias("n"), F.countDistinct("user_id").alias("unique_users")
    )


def feature_launch_ramp(w: Warehouse) -> DataFrame:
    """Month x type of the focus module, from raw events."""
    combos = w["usage_events"].filter(F.col("feature_module") == w.rules.focus_module).groupBy(
        month_key("event_date").alias("month"), "event_type", "user_id", "saas_customer_id"
    ).agg(n_rows().alias("_n"))
    return combos.groupBy("month", "event_type").agg(
        F.sum("_n").alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("saas_customer_id").alias("accounts"),
    )


def feature_launch_rollup(w: Warehouse) -> DataFrame:
    """Per month: summed users and the accounts of the first event type."""
    return feature_launch_ramp(w).groupBy("month").agg(
        F.sum("events").alias("events"), F.sum("users").alias("users"),
        F.min_by("accounts", "event_type").alias("accounts"),
    )


def module_penetration(w: Warehouse) -> DataFrame:
    adopted = w["feature_adoption"].filter(F.col("feature_module") == w.rules.focus_module).agg(
        F.countDistinct("saas_customer_id").alias("adopted")
    )
    active = w["saas_customers"].agg(count_if(F.col("status") == "active").alias("active"))
    return adopted.crossJoin(active).withColumn("penetration_pct", percent(F.col("adopted"), F.col("active")))


def adopters_vs_rest(w: Warehouse) -> DataFrame:
    adopters = w["feature_adoption"].filter(F.col("feature_module") == w.rules.focus_module).select(
        F.col("saas_customer_id").alias("_adopter")
    ).distinct()
    active = w["saas_customers"].filter(F.col("status") == "active")
    group = F.when(F.col("_adopter").isNotNull(), "Adopter").otherwise("Non-Adopter")
    return active.join(adopters, F.col("saas_customer_id") == F.col("_adopter"), "left").groupBy(
        group.alias("grp")
    ).agg(
        F.avg("usage_score").alias("avg_usage_score"), n_rows().alias("customers"), money_avg("mrr").alias("avg_mrr")
    )
