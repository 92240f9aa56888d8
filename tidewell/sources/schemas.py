"""Declared schemas of the business tables.

Fixed values: table names, column names, types and nullability of the data
model. Keys are 64-bit, money is double, dates are dates. Columns that data
defects may blank are declared nullable.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

DDL: dict[str, str] = {
    # e-commerce
    "customers": """customer_id BIGINT NOT NULL, company_name STRING NOT NULL, customer_type STRING NOT NULL,
        region STRING NOT NULL, segment STRING NOT NULL, industry STRING NOT NULL, acquisition_date DATE,
        acquisition_channel STRING NOT NULL, status STRING NOT NULL, annual_revenue_tier STRING NOT NULL""",
    "products": """product_id BIGINT NOT NULL, product_name STRING NOT NULL, category STRING NOT NULL,
        subcategory STRING NOT NULL, unit_price DOUBLE NOT NULL, cost DOUBLE NOT NULL, launch_date DATE NOT NULL,
        status STRING NOT NULL""",
    "orders": """order_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, order_date DATE NOT NULL, ship_date DATE,
        status STRING NOT NULL, channel STRING NOT NULL, region STRING, total_amount DOUBLE NOT NULL,
        discount_pct DOUBLE""",
    "order_items": """line_id BIGINT NOT NULL, order_id BIGINT NOT NULL, product_id BIGINT NOT NULL,
        quantity INT NOT NULL, unit_price DOUBLE NOT NULL, line_total DOUBLE NOT NULL""",
    "returns": """return_id BIGINT NOT NULL, order_id BIGINT NOT NULL, return_date DATE NOT NULL, reason STRING,
        refund_amount DOUBLE NOT NULL, status STRING NOT NULL""",
    # subscriptions
    "saas_customers": """saas_customer_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, plan_tier STRING NOT NULL,
        signup_date DATE, contract_months INT NOT NULL, mrr DOUBLE NOT NULL, status STRING NOT NULL,
        usage_score INT NOT NULL""",
    "mrr_movements": """movement_id BIGINT NOT NULL, saas_customer_id BIGINT NOT NULL, movement_date DATE NOT NULL,
        movement_type STRING NOT NULL, amount DOUBLE NOT NULL, previous_mrr DOUBLE NOT NULL,
        new_mrr DOUBLE NOT NULL""",
    "support_tickets": """ticket_id BIGINT NOT NULL, saas_customer_id BIGINT NOT NULL, created_date DATE NOT NULL,
        resolved_date DATE, category STRING NOT NULL, priority STRING NOT NULL, resolution_hours DOUBLE""",
    # product analytics
    "saas_users": """user_id BIGINT NOT NULL, saas_customer_id BIGINT NOT NULL, email STRING NOT NULL,
        role STRING NOT NULL, created_date DATE NOT NULL, last_login_date DATE, status STRING NOT NULL""",
    "usage_events": """event_id BIGINT NOT NULL, user_id BIGINT NOT NULL, saas_customer_id BIGINT NOT NULL,
        event_date TIMESTAMP_NTZ NOT NULL, event_type STRING NOT NULL, feature_module STRING NOT NULL,
        session_id STRING, duration_seconds INT""",
    "feature_adoption": """adoption_id BIGINT NOT NULL, saas_customer_id BIGINT NOT NULL,
        feature_module STRING NOT NULL, first_used_date DATE, last_used_date DATE, total_events BIGINT NOT NULL,
        monthly_active_users BIGINT NOT NULL, adoption_depth STRING NOT NULL""",
    # payments
    "invoices": """invoice_id BIGINT NOT NULL, order_id BIGINT NOT NULL, customer_id BIGINT NOT NULL,
        invoice_date DATE NOT NULL, due_date DATE NOT NULL, amount DOUBLE NOT NULL, status STRING NOT NULL""",
    "payments": """payment_id BIGINT NOT NULL, invoice_id BIGINT NOT NULL, payment_date DATE NOT NULL,
        amount DOUBLE NOT NULL, method STRING NOT NULL, days_to_pay INT NOT NULL, is_late INT NOT NULL""",
    # CRM
    "accounts": """account_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, owner STRING NOT NULL,
        account_tier STRING NOT NULL, health_score INT NOT NULL, last_contact_date DATE, next_renewal_date DATE""",
    "activities": """activity_id BIGINT NOT NULL, account_id BIGINT NOT NULL, activity_date DATE NOT NULL,
        activity_type STRING NOT NULL, subject STRING NOT NULL, notes STRING, outcome STRING NOT NULL""",
    "opportunities": """opp_id BIGINT NOT NULL, account_id BIGINT NOT NULL, opp_name STRING NOT NULL,
        stage STRING NOT NULL, amount DOUBLE NOT NULL, close_date DATE NOT NULL, probability INT NOT NULL,
        product_interest STRING NOT NULL""",
    # bridge
    "customer_xref": """customer_id BIGINT NOT NULL, ecommerce_id BIGINT, saas_customer_id BIGINT,
        account_id BIGINT, payment_customer_id BIGINT""",
    "customer_360": """customer_id BIGINT NOT NULL, company_name STRING, region STRING, segment STRING,
        total_orders BIGINT, total_revenue DOUBLE, total_returns BIGINT, return_rate DOUBLE, saas_plan STRING,
        saas_mrr DOUBLE, saas_usage_score INT, dau_mau_ratio DOUBLE, features_adopted BIGINT,
        avg_session_minutes DOUBLE, avg_days_to_pay DOUBLE, late_payment_pct DOUBLE, account_health INT,
        last_activity_date DATE, open_opportunities BIGINT, lifetime_value DOUBLE""",
    # governance
    "region_mapping": "variant STRING NOT NULL, canonical STRING NOT NULL",
    "duplicate_tracking": """duplicate_customer_id BIGINT NOT NULL, original_customer_id BIGINT NOT NULL,
        variation_type STRING NOT NULL""",
    "data_quality_flags": """flag_id BIGINT NOT NULL, rule_id STRING NOT NULL, table_name STRING NOT NULL,
        record_id BIGINT, flag_type STRING NOT NULL, description STRING""",
}

BASE_TABLES = tuple(name for name in DDL if name not in ("region_mapping", "duplicate_tracking", "data_quality_flags"))


def schema(name: str) -> StructType:
    return StructType.fromDDL(DDL[name])


class _Schemas(dict):
    def __missing__(self, name: str) -> StructType:
        self[name] = schema(name)
        return self[name]


SCHEMAS: dict[str, StructType] = _Schemas()
