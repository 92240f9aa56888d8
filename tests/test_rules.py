"""Governance rules on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import D
from tidewell.operators import exclude, flags, normalize, profile
from tidewell.plans import views


def ids(df, column):
    return sorted(r[0] for r in df.select(column).collect())


def test_customer_view(business):
    rows = {r.customer_id: r for r in business["v_customers_clean"].collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert rows[1].company_name == "ACME CORP."
    assert rows[7].company_name == "TAB\tONLY"
    assert {k: r.region for k, r in rows.items()} == {
        1: "Europe", 2: "Europe", 3: "Europe", 4: "Europe", 5: "LATAM", 6: "Unknown", 7: "North America", 8: "APAC",
        9: "APAC",
    }
    case = business["customers"].select("customer_id", normalize.region_case("region").alias("r")).collect()
    assert all(r.r == rows[r.customer_id].region for r in case if r.customer_id in rows)


def test_every_region_spelling_is_mapped(spark):
    spellings = [(s, c) for c, listed in normalize.REGION_VARIANTS.items() for s in listed]
    df = spark.createDataFrame([(f" {s.lower()} ", c) for s, c in spellings], "region string, wanted string")
    mapped = normalize.standardize(df, "region", normalize.region_mapping(spark))
    assert mapped.filter(F.col("region") != F.col("wanted")).count() == 0


def test_order_views(business):
    assert ids(business["v_orders_clean"], "order_id") == [10, 13]
    assert ids(business["v_order_items_clean"], "line_id") == [3, 4, 6]
    lines = views.order_lines(business, "order_date")
    joined = business["v_order_items_clean"].join(business["v_orders_clean"], "order_id")
    assert ids(lines, "line_id") == ids(joined, "line_id")
    assert {r.return_id: r.reason for r in business["v_returns_clean"].collect()} == {
        1: "Not recorded", 2: "defective", 4: "wrong_item",
    }


def test_other_views(business):
    assert ids(business["v_payments_clean"], "payment_id") == [1, 4]
    assert ids(business["v_invoices_clean"], "invoice_id") == [1000]
    assert ids(business["v_saas_customers_clean"], "saas_customer_id") == [700, 701, 702]
    assert ids(business["v_usage_events_clean"], "event_id") == [1, 2, 3, 5]
    assert ids(business["v_opportunities_clean"], "opp_id") == [1, 2]
    shown = {r.ticket_id: r.resolution_display for r in business["v_support_tickets_clean"].collect()}
    assert shown == {1: "Open", 2: "2025-01-03"}
    notes = {r.activity_id: r for r in business["v_activities_clean"].collect()}
    assert 0 not in notes and notes[9].notes == "padded text ok" and notes[8].notes_display == ""


def test_clean_plus_excluded_is_raw_and_views_are_idempotent(business):
    for row in views.reconcile(business).collect():
        assert row.clean_rows + row.excluded == row.raw_rows
    again = business.replacing(orders=lambda w: business["v_orders_clean"])
    assert ids(again["v_orders_clean"], "order_id") == ids(business["v_orders_clean"], "order_id")


def test_lifted_rule_is_labelled(business):
    rules = {"EX-005": lambda df: exclude.exclude_future(df, "order_date", dt.date(2025, 12, 31))}
    assert exclude.govern(business["orders"], rules).select("data_scope").distinct().collect()[0][0] == "governed"
    lifted = exclude.govern(business["orders"], rules, ["EX-005"])
    assert lifted.count() == 5
    assert lifted.first().data_scope == "including excluded records"


def test_display_keeps_null(business):
    rows = normalize.display(business["returns"], {"reason": "Not recorded"}).collect()
    assert [(r.reason, r.reason_display) for r in rows if r.return_id == 1] == [(None, "Not recorded")]


def flagged(business, rule):
    return sorted((r.record_id, r.description) for r in flags.flags(business, rule).collect())


def test_duplicate_flags(business):
    assert [r for r, _ in flagged(business, "duplicate_tracked")] == [101, 102]
    assert [r for r, _ in flagged(business, "duplicate_original")] == [8, 8]
    assert flagged(business, "duplicate_cluster") == [
        (1, "Matches duplicate cluster: ACME CORP. / EU"), (2, "Matches duplicate cluster: ACME CORP. / EU"),
    ]


def test_text_flags(business):
    assert [r for r, _ in flagged(business, "truncated")] == [2, 5, 7, 9]
    punctuation = flags.truncated(business, mode="punctuation")
    assert ids(punctuation, "record_id") == [2, 4, 5, 6, 7, 9]
    assert [(r, d[-2:]) for r, d in flagged(business, "mojibake")] == [(5, "Ã¶"), (5, "Ã¼")]
    assert [r for r, _ in flagged(business, "whitespace")] == [1, 6]


def test_orphan_and_date_flags(business):
    assert flagged(business, "orphan_orders") == [(12, "customer_id=90001 does not match any customer")]
    assert flagged(business, "orphan_payments") == [(3, "invoice_id=99999 does not match any invoice")]
    assert [r for r, _ in flagged(business, "future_date")] == [0, 11, 14]


def test_outlier_flag(spark, business):
    rows = [(i, 1, 1, 1, 10.0, 10.0) for i in range(50)] + [(99, 1, 1, 1, 5000.0, 5000.0), (98, 1, 1, 1, -9e9, 0.0)]
    w = business.replacing(order_items=lambda _: spark.createDataFrame(rows, business["order_items"].schema))
    assert [r for r, _ in flagged(w, "outlier")] == [99]


def test_all_flags_numbered_without_gaps(business):
    rows = sorted(flags.all_flags(business).collect(), key=lambda r: r.flag_id)
    assert [r.flag_id for r in rows] == list(range(1, len(rows) + 1))
    order = [(r.rule_id, r.table_name, r.record_id) for r in rows]
    assert order == sorted(order)
    assert sum(r.n for r in flags.summary(business).collect()) == len(rows)


def test_profiles(business):
    rates = {r.column_name: r.null_pct for r in profile.null_rates(business["orders"], "orders").collect()}
    assert rates == {"ship_date": 20.0, "discount_pct": 20.0}
    rate = profile.orphan_rate(business["orders"], business["customers"], "customer_id", "x").first()
    assert (rate.orphans, rate.n_rows, rate.orphan_pct) == (1, 5, 20.0)
    counts = profile.duplicate_count(business["duplicate_tracking"], business["customers"]).first()
    assert (counts.tracked, counts.clusters, counts.clustered_rows) == (2, 2, 4)


def test_empty_tables(spark, business):
    empty = {n: (lambda w, n=n: business[n].limit(0)) for n in business}
    w = business.replacing(**empty)
    assert all(w[v].count() == 0 for v in views.VIEWS)
    assert flags.all_flags(w).count() == 0
    assert profile.null_rates(w["orders"], "orders").count() == 0
