"""The business tables as projections of a star schema.

Maps ``customer orders lineitem part supplier nation region events documents``
onto the tables of ``schemas.DDL``. Costly columns (an order's ship date, a
customer's first order) come from left joins to frames grouped by the join key.
Catalyst knows such a key is unique and drops the join where the column is not
read, so a report pays only for what it uses.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.keyhash import number_key
from tidewell.functions.numbers import cents, clamp, round_half_up
from tidewell.plans import rollups
from tidewell.sources.warehouse import Rules, Warehouse

STAR_RULES = Rules(cutoff=dt.date(2000, 12, 31), usage_as_of=dt.date(2024, 1, 30))


# Declared, so that no job runs to read file footers.
STAR_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def load_star(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_DDL[name]).parquet(f"{directory}/{name}.parquet")


def raw(w: Warehouse, name: str, directory: str) -> DataFrame:
    return w.once(("star", name), lambda: load_star(w.spark, directory, name))


def pick(index: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def choose(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    items = list(mapping.items())
    case = F.when(c == items[0][0], items[0][1])
    for key, value in items[1:]:
        case = case.when(c == key, value)
    return case if default is None else case.otherwise(default)


SEGMENT = {
    "AUTOMOBILE": "enterprise", "MACHINERY": "enterprise",
    "BUILDING": "mid_market", "FURNITURE": "mid_market", "HOUSEHOLD": "smb",
}
PLAN = {"AUTOMOBILE": "enterprise", "MACHINERY": "pro", "BUILDING": "basic", "FURNITURE": "free"}
PAYMENT_METHOD = {
    "1-URGENT": "wire", "2-HIGH": "ach", "3-MEDIUM": "credit_card", "4-NOT SPECIFIED": "check", "5-LOW": "ach",
}
ORDER_STATUS = {"F": "completed", "O": "processing", "P": "cancelled"}


def _customer_places(w: Warehouse, d: str) -> DataFrame:
    return w.once(("star", "places"), lambda: _build_places(w, d))


def _build_places(w: Warehouse, d: str) -> DataFrame:
    nation = raw(w, "nation", d).join(raw(w, "region", d), F.col("n_regionkey") == F.col("r_regionkey"))
    place = (
        F.when(F.col("n_nationkey").isin(6, 16), "South America")
        .when(F.col("r_name") == "AMERICA", "North America")
        .when(F.col("r_name") == "EUROPE", "Europe")
        .when(F.col("r_name") == "ASIA", "APAC")
        .when(F.col("r_name") == "MIDDLE EAST", "EMEA")
        .otherwise(F.col("r_name"))
    )
    nation = nation.groupBy("n_nationkey").agg(F.min(place).alias("region"))
    return raw(w, "customer", d).join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")


# Accented names. One customer in 40 has one as it stands, so that
# some repeat in a region; one in 4 has one before its own, so that some are garbled.
ACCENTED_NAMES = ("Müller Söhne", "Café Crème", "Peña Mañana", "Grüne Aue", "Åse Bjørn", "Façade Née")


def _company_name(suffix: Column) -> Column:
    def accented(every: int) -> Column:
        return pick(F.floor(F.col("c_custkey") / every) % len(ACCENTED_NAMES), *ACCENTED_NAMES)

    own = F.when(F.col("c_custkey") % 40 == 0, accented(40))
    own = own.when(F.col("c_custkey") % 4 == 1, F.concat(accented(4), F.lit(" "), F.col("c_name")))
    return F.concat(own.otherwise(F.col("c_name")), suffix)


def customers(w: Warehouse, d: str) -> DataFrame:
    first = raw(w, "orders", d).groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("acquisition_date"))
    balance, suffix = F.col("c_acctbal"), pick(F.col("c_nationkey") % 4, " Inc.", " Corp.", " LLC", "")
    return (
        _customer_places(w, d)
        .join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            _company_name(suffix).alias("company_name"),
            F.when(balance >= 3000, "wholesale").otherwise("dtc").alias("customer_type"),
            "region",
            choose(F.col("c_mktsegment"), SEGMENT).alias("segment"),
            F.lower("c_mktsegment").alias("industry"),
            "acquisition_date",
            pick(F.col("c_nationkey") % 5, "direct_sales", "partner", "inbound", "trade_show", "referral").alias(
                "acquisition_channel"
            ),
            F.when(balance < -500, "churned").when(balance < 0, "suspended").otherwise("active").alias("status"),
            F.when(balance < 1000, "under_1m").when(balance < 4000, "1m_10m").when(balance < 8000, "10m_50m")
            .otherwise("50m_plus").alias("annual_revenue_tier"),
        )
    )


def products(w: Warehouse, d: str) -> DataFrame:
    return raw(w, "part", d).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("unit_price"),
        round_half_up(F.col("p_retailprice") * 0.6, 2).alias("cost"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), F.col("p_size") * 30).alias("launch_date"),
        F.when(F.col("p_size") > 45, "discontinued").otherwise("active").alias("status"),
    )


def _order_lines(w: Warehouse, d: str) -> DataFrame:
    return w.once(("star", "order lines"), lambda: _build_order_lines(w, d))


def _build_order_lines(w: Warehouse, d: str) -> DataFrame:
    discount = F.sum(cents("l_discount")) / F.lit(100.0) / F.count("l_discount")
    return raw(w, "lineitem", d).groupBy("l_orderkey").agg(
        F.min("l_shipdate").cast("date").alias("first_ship"),
        round_half_up(discount, 4).alias("discount_pct"),
    )


def orders(w: Warehouse, d: str) -> DataFrame:
    places = _customer_places(w, d).groupBy("c_custkey").agg(F.min("region").alias("region"))
    return (
        raw(w, "orders", d)
        .join(_order_lines(w, d), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(places, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("first_ship").alias("ship_date"),
            choose(F.col("o_orderstatus"), ORDER_STATUS).alias("status"),
            F.lower("o_orderpriority").alias("channel"),
            "region",
            F.col("o_totalprice").alias("total_amount"),
            "discount_pct",
        )
    )


def _line_key() -> Column:
    return number_key(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint"), cents("l_extendedprice"),
        F.floor("l_quantity"),
    )


def order_items(w: Warehouse, d: str) -> DataFrame:
    return raw(w, "lineitem", d).select(
        _line_key().alias("line_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        round_half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
    )


def returns(w: Warehouse, d: str) -> DataFrame:
    reasons = pick(
        F.col("l_linenumber") % 5, "defective", "wrong_item", "not_as_described", "changed_mind", "late_delivery"
    )
    return raw(w, "lineitem", d).filter(F.col("l_returnflag") == "R").select(
        _line_key().alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").cast("date").alias("return_date"),
        F.when(F.col("l_linestatus") == "F", reasons).alias("reason"),
        F.col("l_extendedprice").alias("refund_amount"),
        F.when(F.col("l_tax") > 0.06, "pending").otherwise("processed").alias("status"),
    )


def _terms() -> Column:
    """Payment terms of the customer's segment; see ``rollups.PAYMENT_TERMS``."""
    return rollups.terms_for(choose(F.col("c_mktsegment"), SEGMENT))


def invoices(w: Warehouse, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return (
        raw(w, "orders", d).filter(F.col("o_orderstatus") == "F")
        .join(raw(w, "customer", d), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            (F.col("o_orderkey") * 10 + 1).alias("invoice_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            day.alias("invoice_date"),
            F.date_add(day, _terms()).alias("due_date"),
            F.col("o_totalprice").alias("amount"),
            F.when(F.date_add(day, _terms()) > F.lit(w.rules.cutoff), "overdue").otherwise("paid").alias("status"),
        )
    )


def payments(w: Warehouse, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    days = F.date_diff("first_ship", day)
    return (
        raw(w, "orders", d).filter(F.col("o_orderstatus") == "F")
        .join(_order_lines(w, d), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(raw(w, "customer", d), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            (F.col("o_orderkey") * 10 + 2).alias("payment_id"),
            (F.col("o_orderkey") * 10 + 1).alias("invoice_id"),
            F.date_add(day, days).alias("payment_date"),
            F.col("o_totalprice").alias("amount"),
            choose(F.col("o_orderpriority"), PAYMENT_METHOD).alias("method"),
            days.alias("days_to_pay"),
            rollups.late_flag(days, _terms()).alias("is_late"),
        )
    )


def saas_customers(w: Warehouse, d: str) -> DataFrame:
    first = raw(w, "orders", d).groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("signup_date"))
    balance = F.col("c_acctbal")
    return (
        raw(w, "customer", d).filter(F.col("c_mktsegment") != "HOUSEHOLD")
        .join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            (F.col("c_custkey") * 2 + 1).alias("saas_customer_id"),
            F.col("c_custkey").alias("customer_id"),
            choose(F.col("c_mktsegment"), PLAN).alias("plan_tier"),
            "signup_date",
            F.when(F.col("c_nationkey") % 2 == 0, 12).otherwise(24).alias("contract_months"),
            round_half_up(F.abs(balance) / 10, 2).alias("mrr"),
            F.when(balance < 1000, "churned").otherwise("active").alias("status"),
            F.floor((balance + 1000) / 110).cast("int").alias("usage_score"),
        )
    )


def monthly_balances(w: Warehouse, d: str) -> DataFrame:
    """(saas_customer_id, month, balance): ordered value per customer and month."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return raw(w, "orders", d).groupBy(
        (F.col("o_custkey") * 2 + 1).alias("saas_customer_id"), month.alias("month")
    ).agg((F.sum(cents("o_totalprice")) / F.lit(100.0)).alias("balance"))


def mrr_movements(w: Warehouse, d: str) -> DataFrame:
    return rollups.mrr_movements(w["monthly_balances"], w.rules.cutoff)


def support_tickets(w: Warehouse, d: str) -> DataFrame:
    day, total = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    solved = F.when(F.col("first_ship") >= day, F.col("first_ship"))
    priority = {"1-URGENT": "critical", "2-HIGH": "high", "3-MEDIUM": "medium"}
    return (
        raw(w, "orders", d)
        .join(_order_lines(w, d), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            (F.col("o_orderkey") * 10 + 3).alias("ticket_id"),
            (F.col("o_custkey") * 2 + 1).alias("saas_customer_id"),
            day.alias("created_date"),
            solved.alias("resolved_date"),
            F.when(total > 300000, "feature_request").when(F.col("o_orderstatus") == "F", "billing")
            .when(F.col("o_orderstatus") == "O", "technical").otherwise("onboarding").alias("category"),
            choose(F.col("o_orderpriority"), priority, "low").alias("priority"),
            (F.date_diff(solved, day) * 24.0).alias("resolution_hours"),
        )
    )


def _event_account() -> Column:
    return F.floor(F.col("user_id") / 3) * 2 + 1


def usage_events(w: Warehouse, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    module = (
        F.when(k < 30, "analytics").when(k < 50, "dashboards").when(k < 65, "integrations")
        .when(k < 80, "admin").when(k < 90, "data_management").otherwise("ai_insights")
    )
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
    return raw(w, "events", d).select(
        "event_id",
        "user_id",
        _event_account().alias("saas_customer_id"),
        F.col("ts").alias("event_date"),
        "event_type",
        module.alias("feature_module"),
        F.when(k >= 4, session).alias("session_id"),
        F.when(k < 94, F.floor(F.col("value") * 10).cast("int")).alias("duration_seconds"),
    )


def saas_users(w: Warehouse, d: str) -> DataFrame:
    seen = raw(w, "events", d).groupBy("user_id").agg(
        F.min("ts").cast("date").alias("created_date"), F.max("ts").cast("date").alias("last_login_date")
    )
    recent = F.date_sub(F.lit(w.rules.usage_as_of), 3)
    return seen.select(
        "user_id",
        _event_account().alias("saas_customer_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
        pick(F.col("user_id") % 3, "admin", "analyst", "viewer").alias("role"),
        "created_date",
        "last_login_date",
        F.when(F.col("last_login_date") >= recent, "active").otherwise("inactive").alias("status"),
    )


def feature_adoption(w: Warehouse, d: str) -> DataFrame:
    return rollups.feature_adoption(w["usage_events"])


def accounts(w: Warehouse, d: str) -> DataFrame:
    balance = F.col("s_acctbal")
    health = clamp(F.floor((balance + 1000) / 110), 0, 100).cast("int")
    spread = F.floor(F.abs(balance)) % 365
    score = F.floor((balance + 2000) / 120).cast("int")
    status = F.when(balance < -200, "churned").otherwise("active")
    return raw(w, "supplier", d).join(
        raw(w, "nation", d), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").alias("account_id"),
        (F.col("s_suppkey") * 3 + 1).alias("customer_id"),
        F.col("n_name").alias("owner"),
        rollups.account_tier(status, score, health).alias("account_tier"),
        health.alias("health_score"),
        F.when(balance >= 0, F.date_sub(F.lit(w.rules.cutoff), spread.cast("int"))).alias("last_contact_date"),
        F.when(balance < 9000, F.date_add(F.lit(w.rules.cutoff), spread.cast("int"))).alias("next_renewal_date"),
    )


def activities(w: Warehouse, d: str) -> DataFrame:
    doc, size = F.col("doc_id"), F.col("n_chars")
    outcome = pick(F.pmod(size, F.lit(4)), "positive", "neutral", "negative", "follow_up_needed")
    kind = choose(F.col("lang"), {"en": "call", "fr": "email", "de": "meeting", "es": "demo"}, "qbr")
    return raw(w, "documents", d).select(
        doc.alias("activity_id"),
        F.pmod(doc * 31, F.floor(doc / 10) + 1).alias("account_id"),
        F.date_add(F.lit(dt.date(1996, 1, 1)), F.pmod(size * 7 + doc, F.lit(2000)).cast("int")).alias("activity_date"),
        kind.alias("activity_type"),
        F.concat_ws(": ", "lang", "source").alias("subject"),
        F.when(F.pmod(size, F.lit(11)) != 0, F.col("text")).alias("notes"),
        outcome.alias("outcome"),
    )


def opportunities(w: Warehouse, d: str) -> DataFrame:
    status, level = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1).cast("int")
    stage = (
        F.when((status == "F") & (level <= 3), "closed_won").when(status == "F", "closed_lost")
        .when((status == "O") & (level <= 2), "negotiation").when(status == "O", "proposal")
        .when(level <= 2, "qualification").otherwise("prospecting")
    )
    interest = pick(
        level - 1, "Analytics Pro", "Dashboard Suite", "Integration Hub", "Data Connector", "Enterprise Platform"
    )
    return raw(w, "orders", d).select(
        (F.col("o_orderkey") * 10 + 4).alias("opp_id"),
        F.floor(F.col("o_custkey") / 15).alias("account_id"),
        F.concat(F.lit("Renewal: "), interest).alias("opp_name"),
        stage.alias("stage"),
        F.col("o_totalprice").alias("amount"),
        F.date_add(F.col("o_orderdate").cast("date"), 90).alias("close_date"),
        rollups.stage_probability(stage).alias("probability"),
        interest.alias("product_interest"),
    )


def customer_xref(w: Warehouse, d: str) -> DataFrame:
    return rollups.customer_xref(w)


def customer_360(w: Warehouse, d: str) -> DataFrame:
    return rollups.customer_360(w, w.rules.usage_as_of)


def duplicate_tracking(w: Warehouse, d: str) -> DataFrame:
    from tidewell.sources.schemas import schema

    return w.spark.createDataFrame([], schema("duplicate_tracking"))


def region_mapping(w: Warehouse, d: str) -> DataFrame:
    from tidewell.operators.normalize import region_mapping as mapping

    return mapping(w.spark)


_ADAPTERS = (
    customers, products, orders, order_items, returns, saas_customers, monthly_balances, mrr_movements,
    support_tickets, saas_users, usage_events, feature_adoption, invoices, payments, accounts, activities,
    opportunities, customer_xref, customer_360, duplicate_tracking, region_mapping,
)


def star(spark: SparkSession, directory: str, rules: Rules = STAR_RULES) -> Warehouse:
    builders = {f.__name__: (lambda w, f=f: f(w, directory)) for f in _ADAPTERS}
    return Warehouse(spark, builders, rules)
