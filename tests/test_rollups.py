"""Derived tables, reports and checks on hand-written rows."""

import datetime as dt

import pytest

from tests.fixtures import D
from tidewell.plans import calibrate, rollups
from tidewell.plans.reports import crm, ecommerce, executive, payments, product, saas


def test_ledger(spark):
    months = [(1, D(2024, 1, 1), 100.0), (1, D(2024, 2, 1), 150.0), (1, D(2024, 3, 1), 150.0),
              (1, D(2024, 4, 1), 120.0), (1, D(2024, 7, 1), 80.0), (2, D(2024, 12, 1), 10.0), (3, D(2025, 5, 1), 9.0)]
    balances = spark.createDataFrame(months, "saas_customer_id bigint, month date, balance double")
    ledger = rollups.mrr_movements(balances, D(2024, 12, 31))
    rows = sorted((r.saas_customer_id, r.movement_date, r.movement_type, r.amount, r.previous_mrr, r.new_mrr)
                  for r in ledger.collect())
    assert rows == [
        (1, D(2024, 1, 1), "new", 100.0, 0.0, 100.0),
        (1, D(2024, 2, 1), "expansion", 50.0, 100.0, 150.0),
        (1, D(2024, 4, 1), "contraction", -30.0, 150.0, 120.0),
        (1, D(2024, 5, 1), "churn", -120.0, 120.0, 0.0),
        (1, D(2024, 7, 1), "new", 80.0, 0.0, 80.0),
        (1, D(2024, 8, 1), "churn", -80.0, 80.0, 0.0),
        (2, D(2024, 12, 1), "new", 10.0, 0.0, 10.0),
    ]
    assert all(before + amount == after for *_, amount, before, after in rows)
    current = {r.saas_customer_id: (r.mrr, r.status) for r in rollups.current_mrr(ledger).collect()}
    assert current == {1: (0.0, "churned"), 2: (10.0, "active")}


def test_usage_scores(business):
    got = {r.saas_customer_id: r.usage_score for r in rollups.usage_scores(
        business["saas_customers"], business["usage_events"], business["saas_users"], D(2025, 12, 31)).collect()}
    # 700: both seats active, 2 modules, 3 events, mean 300 s
    assert got[700] == int(35 + 2 / 6 * 25 + 3 / 500 * 25 + 0.5 * 15)
    assert got[701] == 20  # churned and capped
    assert got[702] == 5  # churned without events
    assert got[703] == 10  # no events: score kept


def test_adoption_and_depth(spark):
    rows = [(1, i % 3, "m", dt.datetime(2024, 1, 1 + i % 5)) for i in range(200)] + [
        (2, 1, "m", dt.datetime(2024, 1, 1))] * 9 + [(3, 1, "m", dt.datetime(2024, 1, 1))] * 50
    events = spark.createDataFrame(rows, "saas_customer_id bigint, user_id bigint, feature_module string, event_date timestamp_ntz")
    got = {r.saas_customer_id: (r.adoption_depth, r.monthly_active_users, r.total_events)
           for r in rollups.feature_adoption(events).collect()}
    assert got == {1: ("heavy", 3, 200), 2: ("none", 1, 9), 3: ("moderate", 1, 50)}


def test_customer_360(business):
    rows = {r.customer_id: r for r in rollups.customer_360(business, D(2025, 12, 31)).collect()}
    assert len(rows) == business["customers"].count()
    one = rows[1]
    assert (one.total_orders, one.total_revenue, one.total_returns, one.return_rate) == (2, 150.0, 2, 1.0)
    assert (one.saas_plan, one.dau_mau_ratio, one.features_adopted) == ("pro", 0.5, 2)
    assert (one.avg_session_minutes, one.avg_days_to_pay, one.late_payment_pct) == (5.0, 60.5, 0.5)
    assert one.open_opportunities == 1 and one.lifetime_value == 150.0 + 299.0 * 36
    nine = rows[9]
    assert (nine.total_orders, nine.saas_mrr, nine.dau_mau_ratio, nine.lifetime_value) == (0, None, None, 0.0)


def test_one_profile_per_customer_despite_two_subscriptions(spark, business):
    rows = [*business["saas_customers"].collect(), (690, 1, "basic", D(2023, 1, 1), 12, 1.0, "active", 1)]
    w = business.replacing(saas_customers=lambda _: spark.createDataFrame(rows, business["saas_customers"].schema))
    profile = rollups.customer_360(w, D(2025, 12, 31))
    assert profile.count() == business["customers"].count()
    assert {r.customer_id: r.saas_customer_id for r in rollups.customer_xref(w).collect()}[1] == 690


def test_late_and_terms(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("enterprise", 60), ("enterprise", 61), ("smb", 30), ("other", 31)], "s string, d int")
    got = df.select(rollups.late_flag("d", rollups.terms_for("s")).alias("l")).collect()
    assert [r.l for r in got] == [0, 1, 0, 1]
    assert df.select(rollups.stage_probability(F.lit("proposal"))).first()[0] == 40


def test_month_spine(spark):
    df = spark.createDataFrame([(D(2024, 1, 15), D(2024, 3, 10))], "a date, b date")
    rows = [(r.first_day, r.last_day) for r in rollups.month_spine(df, "a", "b").orderBy("first_day").collect()]
    assert rows == [(D(2024, 1, 1), D(2024, 1, 31)), (D(2024, 2, 1), D(2024, 2, 29)), (D(2024, 3, 1), D(2024, 3, 10))]


def test_period_tags(spark):
    named = {"spring": {"quarter": (2025, 2), "churn_multiplier": 1.4}, "summer": {"quarter": (2025, 3)}}
    periods = rollups.period_table(spark, named, "churn_multiplier")
    df = spark.createDataFrame([(D(2025, 5, 1),), (D(2022, 5, 1),)], "d date")
    rows = {r.d: (r.period, r.value) for r in rollups.tag_periods(df, "d", periods).collect()}
    assert rows == {D(2025, 5, 1): ("spring", "1.4"), D(2022, 5, 1): (None, None)}


def test_reports(business):
    revenue = {r.month: (r.revenue, r.orders, r.unique_customers) for r in executive.monthly_revenue(business).collect()}
    assert revenue == {"2025-12": (100.0, 1, 1), "2024-02": (20.25, 1, 1)}
    shares = {r.region: r.share_pct for r in executive.region_share(business).collect()}
    assert sum(shares.values()) == pytest.approx(100)
    fan_out = {r.category: (r.returns, r.refund_total) for r in ecommerce.returns_by_category(business).collect()}
    assert fan_out == {"accessories": (2, 12.0), "hardware": (3, 13.0)}
    assert saas.saas_kpis(business).first().churned == 2
    assert product.product_kpis(business).first().asDict() == {
        "events": 4, "users": 3, "accounts": 2, "modules": 2, "focus_events": 1}
    assert payments.payments_kpis(business).first().late_pct == 50.0
    assert crm.crm_kpis(business).first().open_opps == 1
    assert calibrate.monthly_churn(business).first().actual == pytest.approx(1 / (3 * 18) * 100)


def test_pareto(business):
    rows = sorted(product.pareto_users(business).collect(), key=lambda r: r.rank)
    assert [(r.user_id, r.events) for r in rows] == [(1, 2), (2, 1), (3, 1)]
    assert [r.cumulative_pct for r in rows] == [50.0, 75.0, 100.0]
