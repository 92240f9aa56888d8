"""Small hand-written business tables, both sides of every boundary."""

from __future__ import annotations

import datetime as dt

from tidewell.operators.normalize import region_mapping
from tidewell.sources.schemas import schema
from tidewell.sources.warehouse import Rules, Warehouse

D = dt.date
CUTOFF = D(2025, 12, 31)


def customer(cid, name="Acme Corp.", region="Europe", segment="smb"):
    return (cid, name, "dtc", region, segment, "retail", D(2023, 1, 5), "inbound", "active", "under_1m")


CUSTOMERS = [
    customer(1, "  Acme Corp. ", "EU", "enterprise"),
    customer(2, "acme corp.", "EU", "mid_market"),
    customer(3, "ACME CORP.", "Europe "),
    customer(4, "Müller GmbH", "europe"),
    customer(5, "MÃ¼ller & SÃ¶hne", "latam"),
    customer(6, "Two  Spaces", "Mars"),
    customer(7, "Tab\tonly", "N. America"),
    customer(8, "Acme Corp", "APAC"),
    customer(9, "Plain", "Asia-Pacific "),
    customer(101, "ACME CORP", "APAC"),
    customer(102, "Acme Corp.", "APAC"),
]
TRACKING = [(101, 8, "upper"), (102, 8, "add_period")]
ORDERS = [
    (10, 1, D(2025, 12, 31), None, "completed", "online", "Europe", 100.0, 0.1),
    (11, 1, D(2026, 1, 1), D(2026, 1, 3), "completed", "online", "Europe", 50.0, 0.0),
    (12, 90001, D(2024, 5, 1), D(2024, 5, 2), "completed", "phone", "Europe", 70.0, None),
    (13, 2, D(2024, 2, 29), D(2024, 3, 2), "cancelled", "phone", "LATAM", 20.25, 0.2),
    (14, 4, D(2052, 3, 1), D(2025, 3, 2), "processing", "phone", "LATAM", 20.0, 0.2),
]
ITEMS = [
    (1, 10, 500, 1, -1.0, -1.0), (2, 10, 500, 1, 0.0, 0.0), (3, 10, 500, 3, 0.01, 0.03),
    (4, 10, 501, 1, 9999.99, 9999.99), (5, 10, 501, 1, 10000.0, 10000.0), (6, 13, 501, 2, 10.0, 20.0),
    (7, 12, 500, 1, 10.0, 10.0), (8, 99, 500, 1, 10.0, 10.0), (9, 11, 500, 1, 10.0, 10.0),
]
RETURNS = [
    (1, 10, D(2025, 12, 31), None, 5.0, "processed"), (2, 10, D(2026, 1, 2), "defective", 7.0, "pending"),
    (3, 12, D(2024, 5, 9), "defective", 7.0, "pending"), (4, 13, D(2024, 3, 9), "wrong_item", 1.0, "denied"),
]
INVOICES = [
    (1000, 10, 1, D(2025, 12, 31), D(2026, 3, 1), 100.0, "paid"),
    (1001, 12, 90001, D(2024, 5, 1), D(2024, 5, 31), 70.0, "paid"),
]
PAYMENTS = [
    (1, 1000, D(2025, 12, 31), 100.0, "ach", 60, 0), (2, 1000, D(2026, 1, 1), 10.0, "wire", 61, 1),
    (3, 99999, D(2024, 1, 1), 10.0, "wire", 3, 0), (4, 1001, D(2024, 6, 1), 70.0, "check", 31, 1),
]
SAAS = [
    (700, 1, "pro", D(2023, 1, 15), 12, 299.0, "active", 50),
    (701, 2, "free", D(2023, 2, 1), 12, 0.0, "churned", 45),
    (702, 4, "basic", D(2023, 3, 1), 24, 99.0, "churned", 60),
    (703, 90001, "basic", D(2023, 3, 1), 24, 99.0, "active", 10),
]
USERS = [
    (1, 700, "a@x", "admin", D(2023, 1, 1), None, "active"), (2, 700, "b@x", "viewer", D(2023, 1, 1), None, "active"),
    (3, 701, "c@x", "viewer", D(2023, 1, 1), None, "active"),
]
T = dt.datetime
EVENTS = [
    (1, 1, 700, T(2025, 12, 31, 9), "login", "analytics", "s1", 600),
    (2, 1, 700, T(2025, 12, 30, 9), "login", "dashboards", "s2", None),
    (3, 2, 700, T(2025, 12, 5, 9), "export", "analytics", "s3", 0),
    (4, 3, 701, T(2025, 12, 20, 9), "login", "ai_insights", None, 60),
    (5, 3, 701, T(2024, 1, 1, 9), "login", "analytics", "s4", 60),
]
TICKETS = [
    (1, 700, D(2025, 1, 1), None, "billing", "high", None),
    (2, 700, D(2025, 1, 2), D(2025, 1, 3), "billing", "high", 24.0),
]
ACCOUNTS = [
    (1, 1, "Ann", "strategic", 80, D(2025, 6, 1), None), (2, 2, "Bo", "growth", 79, None, D(2026, 1, 1)),
    (3, 5, "Bo", "maintain", 40, None, None),
]
NOTES = [
    None, "short note", "ends with a", "ends with a.", "it ends in xyz e", "it ends in X A", "long note number 7",
    "trailing line break o\n", "            ", "  padded text ok  ",
]
ACTIVITIES = [
    (i, 1 + i % 2, D(2025, 12, 31) if i else D(2026, 1, 1), "call", "s", note, "positive" if i % 3 else "neutral")
    for i, note in enumerate(NOTES)
]
OPPORTUNITIES = [
    (1, 1, "n", "closed_won", 100.0, D(2025, 12, 31), 100, "Analytics Pro"),
    (2, 1, "n", "proposal", 50.5, D(2025, 1, 1), 40, "Analytics Pro"),
    (3, 2, "n", "prospecting", 10.0, D(2026, 1, 1), 10, "Dashboard Suite"),
]
PRODUCTS = [
    (500, "Cable", "accessories", "cables", 10.0, 6.0, D(2020, 1, 1), "active"),
    (501, "Server", "hardware", "servers", 9000.0, 6.0, D(2020, 1, 1), "active"),
]
ROWS = {
    "customers": CUSTOMERS, "duplicate_tracking": TRACKING, "orders": ORDERS, "order_items": ITEMS,
    "returns": RETURNS, "invoices": INVOICES, "payments": PAYMENTS, "saas_customers": SAAS, "saas_users": USERS,
    "usage_events": EVENTS, "support_tickets": TICKETS, "accounts": ACCOUNTS, "activities": ACTIVITIES,
    "opportunities": OPPORTUNITIES, "products": PRODUCTS,
}


def warehouse(spark) -> Warehouse:
    from tidewell.plans import rollups

    builders = {n: (lambda w, n=n: spark.createDataFrame(ROWS[n], schema(n))) for n in ROWS}
    builders["region_mapping"] = lambda w: region_mapping(spark)
    builders["feature_adoption"] = lambda w: rollups.feature_adoption(w["usage_events"])
    return Warehouse(spark, builders, Rules(cutoff=CUTOFF, usage_as_of=CUTOFF))
