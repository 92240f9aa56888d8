"""Accounts, sales activity and pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.numbers import count_if, money_avg, money_sum, percent, round_half_up
from tidewell.functions.dates import month_key
from tidewell.plans.reports.shared import histogram, n_rows, share_of
from tidewell.plans.rollups import CLOSED_STAGES
from tidewell.sources.warehouse import Warehouse


def _is_open():
    return ~F.col("stage").isin(*CLOSED_STAGES)


def crm_kpis(w: Warehouse) -> DataFrame:
    accounts = w["accounts"].agg(n_rows().alias("accounts"), F.avg("health_score").alias("avg_health"))
    deals = w["v_opportunities_clean"].agg(
        n_rows().alias("opps"), count_if(_is_open()).alias("open_opps"),
        money_sum(F.when(_is_open(), F.col("amount"))).alias("pipeline"),
    )
    touches = w["v_activities_clean"].agg(n_rows().alias("activities"))
    return accounts.crossJoin(deals).crossJoin(touches)


def pipeline_funnel(w: Warehouse) -> DataFrame:
    """Stages with their deals in percent of those of the stage with the lowest mean probability."""
    stages = w["v_opportunities_clean"].groupBy("stage").agg(
        n_rows().alias("deals"), money_sum("amount").alias("total_value"), money_avg("amount").alias("avg_deal"),
        F.avg("probability").alias("avg_prob"),
    )
    whole = W.orderBy("avg_prob", "stage").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # six stages
    return stages.withColumn("pct_of_first", percent(F.col("deals"), F.first("deals").over(whole)))


def pipeline_by_stage(w: Warehouse) -> DataFrame:
    return w["v_opportunities_clean"].groupBy("product_interest", "stage").agg(
        n_rows().alias("deals"), money_sum("amount").alias("total_value")
    )


def pipeline_by_product(w: Warehouse) -> DataFrame:
    """Open and won value per product, long form."""
    zero = F.lit(0.0)
    won = F.col("stage") == "closed_won"
    return w["v_opportunities_clean"].groupBy("product_interest").agg(
        money_sum(F.when(_is_open(), F.col("amount")).otherwise(zero)).alias("open_val"),
        money_sum(F.when(won, F.col("amount")).otherwise(zero)).alias("won_val"),
    ).unpivot("product_interest", ["open_val", "won_val"], "type", "amount")


def health_hist(w: Warehouse, bins: int = 30) -> DataFrame:
    return histogram(w["accounts"], "health_score", bins, "account_tier")


def tier_summary(w: Warehouse) -> DataFrame:
    grouped = w["accounts"].groupBy("account_tier").agg(
        n_rows().alias("accounts"), F.avg("health_score").alias("avg_health")
    )
    return grouped.withColumn("share_pct", share_of("accounts"))


def activity_monthly(w: Warehouse) -> DataFrame:
    return w["v_activities_clean"].groupBy(month_key("activity_date").alias("month"), "activity_type").agg(
        n_rows().alias("activities")
    )


def activity_outcomes(w: Warehouse) -> DataFrame:
    """Type x outcome; the type's positive share stands on each of its rows."""
    counted = w["v_activities_clean"].groupBy("activity_type", "outcome").agg(n_rows().alias("n"))
    of_type = W.partitionBy("activity_type")  # one row per outcome
    positive = F.coalesce(F.sum(F.when(F.col("outcome") == "positive", F.col("n"))).over(of_type), F.lit(0))
    return counted.withColumn("positive_pct", percent(positive, F.sum("n").over(of_type)))


def rep_leaderboard(w: Warehouse) -> DataFrame:
    """Per owner. Activities are counted per account first, so each account
    joins once and its distinct count is a plain count."""
    per_account = w["v_activities_clean"].groupBy("account_id").agg(
        n_rows().alias("_n"), count_if(F.col("outcome") == "positive").alias("_good")
    )
    grouped = per_account.join(w["accounts"].select("account_id", "owner"), "account_id").groupBy(
        F.col("owner").alias("rep")
    ).agg(
        F.sum("_n").alias("activities"), n_rows().alias("accounts_touched"), F.sum("_good").alias("positive")
    )
    return grouped.withColumn("win_rate", round_half_up(percent(F.col("positive"), F.col("activities")), 1))


def health_vs_activity(w: Warehouse) -> DataFrame:
    per_account = w["v_activities_clean"].groupBy("account_id").agg(
        n_rows().alias("_n"), F.max("activity_date").alias("last_activity")
    )
    return w["accounts"].join(per_account, "account_id", "left").select(
        "account_id", "health_score", "account_tier", F.coalesce("_n", F.lit(0)).alias("activities"), "last_activity"
    )


def activity_by_tier(w: Warehouse) -> DataFrame:
    return health_vs_activity(w).groupBy("account_tier").agg(F.avg("activities").alias("avg_activities"))


def null_notes_rate(w: Warehouse) -> DataFrame:
    missing = count_if(F.col("notes").isNull())
    return w["activities"].agg(
        n_rows().alias("activities"), missing.alias("null_notes"), percent(missing, n_rows()).alias("null_pct")
    )
