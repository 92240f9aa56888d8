"""Every registered query, runnable over a folder of star-schema Parquet files."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import money_avg, money_sum
from tidewell.operators import degrade, exclude, flags, normalize, profile
from tidewell.plans import calibrate, rollups, views
from tidewell.plans.reports import crm, ecommerce, executive, payments, product, saas
from tidewell.plans.reports.shared import n_rows
from tidewell.sources.catalog import build_schema, coerce_dates, column_types
from tidewell.sources.schemas import BASE_TABLES
from tidewell.sources.star import STAR_DDL, load_star, star
from tidewell.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The star schema ends in 2001, so typos and named periods use its years.
TYPO_YEARS = {1998: 9, 1999: 18, 2000: 27}
QUARTER = (1998, 3)
QUARTER_MONTHS = [(1998, 7), (1998, 8), (1998, 9)]
STAR_PERIODS = {
    "q2_1997_growth": {"quarter": (1997, 2)},
    "q3_1998_delays": {"quarter": (1998, 3), "payment_improvement": 1.2},
    "q1_1999_push": {"quarter": (1999, 1), "payment_improvement": 0.85},
}


def clean(f: Callable[[Warehouse], DataFrame]) -> Query:
    """Query over the tables as they are."""
    return lambda spark, directory: f(star(spark, directory))


def dirty(f: Callable[[Warehouse], DataFrame]) -> Query:
    """Query over the tables with planted defects, for the governance rules."""
    return lambda spark, directory: f(degrade.degraded(star(spark, directory), TYPO_YEARS))


# -- sources ------------------------------------------------------------------


def _text_dates(spark: SparkSession, directory: str) -> DataFrame:
    """Orders with their days as text, some of which are no dates, read back as dates."""
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(key % 7 == 0, F.concat(F.substring(day, 1, 5), F.lit("13-45"))).when(key % 11 == 0, "n/a").when(key % 13 == 0, None).otherwise(day)
    shipped = F.concat(day, F.lit(" 08:30:00"))
    orders = load_star(spark, directory, "orders").select("o_orderkey", text.alias("order_date"), shipped.alias("ship_date"))
    return coerce_dates(orders, ["order_date", "ship_date", "no_such_column"])


def _warehouse_types(spark: SparkSession, directory: str) -> DataFrame:
    """Every star table with warehouse types: what its columns become, and how many values they hold."""
    parts = []
    for table in STAR_DDL:
        raw = load_star(spark, directory, table)
        days = [f.name for f in raw.schema.fields if f.name.endswith("date")]
        parts.append(column_types(build_schema(coerce_dates(raw, days), days), table))
    return reduce(DataFrame.unionByName, parts)


SOURCES: dict[str, Query] = {"src_coerce_dates": _text_dates, "src_build_schema": _warehouse_types}


# -- exclusion ----------------------------------------------------------------


def _priced(w: Warehouse) -> DataFrame:
    return w["order_items"].select("line_id", "order_id", "product_id", "unit_price")


def _nonpositive_by_product(w: Warehouse) -> DataFrame:
    kept = exclude.exclude_nonpositive(w["order_items"].filter(F.col("unit_price") != 0), "unit_price")
    return kept.groupBy("product_id").agg(n_rows().alias("n_lines"), F.min("unit_price").alias("min_price"))


def _override(w: Warehouse) -> DataFrame:
    rules = {
        "EX-003": lambda df: exclude.exclude_orphans(df, w["customers"], "customer_id"),
        "EX-005": lambda df: exclude.exclude_future(df, "order_date", w.rules.cutoff),
    }
    governed = exclude.govern(w["orders"], rules)
    lifted = exclude.govern(w["orders"], rules, lift=["EX-005"])
    return governed.unionByName(lifted).groupBy("data_scope").agg(
        n_rows().alias("orders"), money_sum("total_amount").alias("revenue")
    )


EXCLUSIONS: dict[str, Query] = {
    "ex_zero_price": dirty(lambda w: exclude.exclude_nonpositive(_priced(w), "unit_price")),
    "ex_negative_price": dirty(_nonpositive_by_product),
    "ex_orphan_orders": dirty(
        lambda w: exclude.exclude_orphans(
            w["orders"].select("order_id", "customer_id", "total_amount"), w["customers"], "customer_id"
        )
    ),
    "ex_orphan_payments": dirty(
        lambda w: exclude.exclude_orphans(
            w["payments"].select("payment_id", "invoice_id", "amount"), w["invoices"], "invoice_id"
        )
    ),
    "ex_future_orders": dirty(
        lambda w: exclude.exclude_future(w["orders"].select("order_id", "order_date"), "order_date", w.rules.cutoff)
    ),
    "ex_future_activities": dirty(
        lambda w: exclude.exclude_future(
            w["activities"].select("activity_id", "activity_date"), "activity_date", w.rules.cutoff
        )
    ),
    "ex_future_payments": dirty(
        lambda w: exclude.exclude_future(
            w["payments"].select("payment_id", "payment_date"), "payment_date", w.rules.cutoff
        )
    ),
    "ex_known_duplicates": dirty(
        lambda w: exclude.exclude_listed(
            w["customers"].select("customer_id", "company_name"), w["duplicate_tracking"], "customer_id",
            "duplicate_customer_id",
        )
    ),
    "ex_price_cap": dirty(lambda w: exclude.exclude_above(_priced(w), "unit_price", w.rules.price_cap)),
    "ex_null_key": dirty(
        lambda w: exclude.exclude_null(w["usage_events"].select("event_id", "session_id"), "session_id")
    ),
    "ex_override_label": dirty(_override),
}


# -- normalisation and imputation ----------------------------------------------


def _cap_percentile(w: Warehouse) -> DataFrame:
    capped = normalize.cap_percentile(w["order_items"].select("product_id", "unit_price"), "unit_price", 0.99, "capped")
    return capped.groupBy("product_id").agg(
        n_rows().alias("n_lines"), money_avg("unit_price").alias("avg_price"),
        (F.sum(F.floor(F.col("capped") * 10000 + 0.5)) / F.lit(10000.0) / n_rows()).alias("avg_capped"),
    )


def _discount_null(w: Warehouse) -> DataFrame:
    return w["orders"].select("order_id", normalize.coalesce0("discount_pct").alias("discount_pct"))


def _display(table: str, key: str, column: str) -> Query:
    def query(w: Warehouse) -> DataFrame:
        text = normalize.DISPLAY_TEXT[column]
        return normalize.display(w[table].select(key, column), {column: text})

    return dirty(query)


NORMALISATIONS: dict[str, Query] = {
    "nrm_company_name": dirty(
        lambda w: w["customers"].select("customer_id", normalize.norm_name("company_name").alias("company_name"))
    ),
    "nrm_notes_trim": dirty(
        lambda w: w["activities"].select("activity_id", normalize.trim_text("notes").alias("notes"))
    ),
    "nrm_region_lookup": dirty(
        lambda w: normalize.standardize(w["customers"].select("customer_id", "region"), "region", w["region_mapping"])
    ),
    "nrm_region_case": dirty(
        lambda w: w["customers"].select("customer_id", normalize.region_case("region").alias("region"))
    ),
    "nrm_cap_percentile": dirty(_cap_percentile),
    "nrm_discount_null": clean(_discount_null),
    "imp_ship_date": _display("orders", "order_id", "ship_date"),
    "imp_reason": _display("returns", "return_id", "reason"),
    "imp_resolved": _display("support_tickets", "ticket_id", "resolved_date"),
    "imp_hours": _display("support_tickets", "ticket_id", "resolution_hours"),
    "imp_notes": _display("activities", "activity_id", "notes"),
    "imp_last_contact": _display("accounts", "account_id", "last_contact_date"),
    "imp_renewal": _display("accounts", "account_id", "next_renewal_date"),
    "imp_session": _display("usage_events", "event_id", "session_id"),
    "imp_duration": _display("usage_events", "event_id", "duration_seconds"),
    "imp_last_used": _display("feature_adoption", "adoption_id", "last_used_date"),
    "imp_count_semantics": dirty(lambda w: normalize.null_semantics(w["support_tickets"], "resolution_hours")),
}

CLEAN_VIEWS: dict[str, Query] = {
    f"cv_{name[2:-6]}": dirty(lambda w, n=name: w[n]) for name in views.VIEWS
}
CLEAN_VIEWS["cv_reconcile"] = dirty(views.reconcile)


# -- flags ----------------------------------------------------------------------


def _mojibake_notes(w: Warehouse) -> DataFrame:
    """Company names here are plain ASCII; document texts carry accents."""
    garbled = w["activities"].withColumn("notes", degrade.garbled("activity_id", "notes", (0.0, 0.2)))
    found = flags.mojibake({"activities": garbled}, "activities", "activity_id", "notes")
    return found.select(*flags.FLAG_COLUMNS)


def _clusters(w: Warehouse) -> DataFrame:
    """Part names repeat within a brand, customers' names do not."""
    parts = w["products"].select("product_id", "product_name", "subcategory")
    return flags.clusters(parts, "product_name", "subcategory").select(
        "product_id", F.col("_norm").alias("cluster_name"), "subcategory", F.col("_size").alias("cluster_size")
    )


FLAGS: dict[str, Query] = {
    f"flg_{name}": dirty(lambda w, n=name: flags.flags(w, n)) for name in flags.RULES if name != "mojibake"
}
FLAGS |= {
    "flg_mojibake": clean(_mojibake_notes),
    "flg_truncated_punctuation": dirty(
        lambda w: flags.truncated(w, mode="punctuation").select(*flags.FLAG_COLUMNS)
    ),
    "flg_cluster_rows": clean(_clusters),
    "flg_all": dirty(flags.all_flags),
    "flg_summary": dirty(flags.summary),
    "flg_summary_tables": dirty(lambda w: flags.summary(w, ["orders", "payments"])),
}


# -- profiling --------------------------------------------------------------------

def _over(tables: tuple[str, ...], f: Callable[[DataFrame, str], DataFrame]) -> Query:
    def query(w: Warehouse) -> DataFrame:
        report = None
        for table in tables:
            part = f(w[table], table)
            report = part if report is None else report.unionByName(part)
        return report

    return dirty(query)


def _orphan_rates(w: Warehouse) -> DataFrame:
    orders = profile.orphan_rate(w["orders"], w["customers"], "customer_id", "orders.customer_id")
    return orders.unionByName(profile.orphan_rate(w["payments"], w["invoices"], "invoice_id", "payments.invoice_id"))


def _raw_vs_clean(w: Warehouse) -> DataFrame:
    return profile.with_excluded_share(views.reconcile(w)).withColumn("table_name", F.regexp_extract("view_name", "^v_(.*)_clean$", 1)).drop("view_name")


DATED = [("orders", "order_date"), ("payments", "payment_date"), ("activities", "activity_date"),
         ("opportunities", "close_date")]

PROFILES: dict[str, Query] = {
    "prf_raw_vs_clean": dirty(_raw_vs_clean),
    "prf_null_rates": _over(BASE_TABLES, profile.null_rates),
    "prf_completeness_alert": _over(BASE_TABLES, profile.completeness_alert),
    "prf_orphan_rate": dirty(_orphan_rates),
    "prf_outlier_counts": dirty(
        lambda w: profile.outlier_counts(w["order_items"], ["quantity", "unit_price", "line_total"])
    ),
    "prf_encoding_counts": clean(
        lambda w: profile.encoding_counts(
            w["activities"].withColumn("notes", degrade.garbled("activity_id", "notes", (0.0, 0.2))), "notes"
        )
    ),
    "prf_future_counts": dirty(lambda w: profile.future_counts({t: w[t] for t, _ in DATED}, DATED, w.rules.cutoff)),
    "prf_duplicate_count": dirty(lambda w: profile.duplicate_count(w["duplicate_tracking"], w["customers"])),
    "prf_value_variants": dirty(lambda w: profile.value_variants(w["customers"], w["v_customers_clean"])),
    "prf_page_callouts": dirty(profile.page_callouts),
}


# -- degradation --------------------------------------------------------------------


def _edited(table: str, key: str, column: str, edit: Callable[[str, str], object]) -> Query:
    return clean(lambda w: w[table].select(key, edit(key, column).alias(column)))


def _near_duplicates(w: Warehouse) -> DataFrame:
    all_rows, tracking = degrade.near_duplicates(
        w["customers"].select("customer_id", "company_name", "region"), "customer_id", "company_name"
    )
    return all_rows.join(tracking, F.col("customer_id") == F.col("duplicate_customer_id"), "left").select(
        "customer_id", "company_name", "region", "original_customer_id", "variation_type"
    )


def _orphan_fk(w: Warehouse) -> DataFrame:
    orders = w["orders"].select("order_id", "customer_id")
    return degrade.orphan_fk(orders, "order_id", "customer_id", degrade.customer_ghosts(w["customers"]))


DEGRADATIONS: dict[str, Query] = {
    "deg_null_columns": clean(
        lambda w: degrade.null_columns(w["support_tickets"], "support_tickets").select(
            "ticket_id", "resolved_date", "resolution_hours"
        )
    ),
    "deg_name_variation": _edited("customers", "customer_id", "company_name", degrade.varied_name),
    "deg_region_variant": _edited("customers", "customer_id", "region", degrade.region_variant),
    "deg_whitespace": _edited(
        "activities", "activity_id", "notes", lambda k, c: degrade.whitespace(k, c, degrade.NOTES_SPACE_RANGE, "null.notes")
    ),
    "deg_near_duplicates": clean(_near_duplicates),
    "deg_shift_dates": _edited("payments", "payment_id", "payment_date", degrade.shifted_date),
    "deg_year_typo": _edited(
        "orders", "order_id", "order_date", lambda k, c: degrade.year_typo(k, c, years=TYPO_YEARS)
    ),
    "deg_zero": _edited("order_items", "line_id", "unit_price", degrade.zeroed),
    "deg_negative": _edited("order_items", "line_id", "unit_price", degrade.negated),
    "deg_outlier": _edited("order_items", "line_id", "unit_price", degrade.outlying),
    "deg_orphan_fk": clean(_orphan_fk),
    "deg_mojibake": _edited("activities", "activity_id", "notes", degrade.garbled),
    "deg_truncate": _edited("activities", "activity_id", "notes", degrade.truncated),
    "deg_report": clean(lambda w: degrade.report(w, TYPO_YEARS)),
    "deg_dry_run": clean(degrade.dry_run),
}


# -- derived tables -------------------------------------------------------------------


def _due_dates(w: Warehouse) -> DataFrame:
    orders = w["orders"].select("order_id", "customer_id", "order_date")
    return rollups.due_dates(orders, w["customers"])


def _late(w: Warehouse) -> DataFrame:
    billed = w["invoices"].select("invoice_id", F.date_diff("due_date", "invoice_date").alias("terms"))
    return w["payments"].join(billed, "invoice_id").select(
        "payment_id", "days_to_pay", "terms", rollups.late_flag("days_to_pay", F.col("terms")).alias("is_late")
    )


def _overdue(w: Warehouse) -> DataFrame:
    status = rollups.invoice_status("is_late", "payment_date", w.rules.cutoff)
    return w["payments"].select("invoice_id", "payment_date", "is_late", status.alias("invoice_status"))


def _discounted(w: Warehouse) -> DataFrame:
    lines = w["order_items"].select("line_id", "order_id", "product_id")
    return (
        lines.join(w["orders"].select("order_id", "discount_pct"), "order_id")
        .join(w["products"].select("product_id", F.col("unit_price").alias("base_price")), "product_id")
        .select("line_id", rollups.discounted_price("base_price", "discount_pct").alias("price"))
    )


def _period_tag(w: Warehouse) -> DataFrame:
    periods = rollups.period_table(w.spark, STAR_PERIODS, "payment_improvement")
    daily = w["orders"].groupBy("order_date").agg(n_rows().alias("orders"), money_sum("total_amount").alias("revenue"))
    return rollups.tag_periods(daily, "order_date", periods).select("order_date", "orders", "revenue", "period", "value")


def _month_spine(w: Warehouse) -> DataFrame:
    span = w["saas_customers"].filter(F.col("signup_date") <= F.lit(w.rules.cutoff)).select(
        "saas_customer_id", "signup_date", F.lit(w.rules.cutoff).alias("end_date")
    )
    return rollups.month_spine(span, "signup_date", "end_date").select(
        "saas_customer_id", "year", "month", "first_day", "last_day"
    )


DERIVED: dict[str, Query] = {
    "der_feature_adoption": clean(lambda w: rollups.feature_adoption(w["usage_events"])),
    "der_usage_score": clean(
        lambda w: rollups.usage_scores(w["saas_customers"], w["usage_events"], w["saas_users"], w.rules.usage_as_of)
    ),
    "der_last_login": clean(lambda w: rollups.last_login(w["usage_events"])),
    "der_invoice": clean(_due_dates),
    "der_is_late": clean(_late),
    "der_invoice_overdue": clean(_overdue),
    "der_order_total": clean(lambda w: rollups.order_totals(w["order_items"])),
    "der_discounted_price": clean(_discounted),
    "der_mrr_movements": clean(lambda w: rollups.mrr_movements(w["monthly_balances"], w.rules.cutoff)),
    "der_current_mrr": clean(lambda w: rollups.current_mrr(w["mrr_movements"])),
    "der_months_active": clean(lambda w: rollups.months_active(w["mrr_movements"], w["saas_customers"])),
    "der_account_tier": clean(lambda w: rollups.account_tiers(w["accounts"], w["saas_customers"])),
    "der_stage_probability": clean(
        lambda w: w["opportunities"].select("opp_id", "stage", rollups.stage_probability("stage").alias("probability"))
    ),
    "der_period_tag": clean(_period_tag),
    "der_month_spine": clean(_month_spine),
    "der_customer_xref": clean(rollups.customer_xref),
    "der_customer_360": clean(lambda w: rollups.customer_360(w, w.rules.usage_as_of)),
}


# -- reports and checks -----------------------------------------------------------------

REPORTS: dict[str, Query] = {
    f.__name__: clean(f)
    for f in (
        executive.exec_kpis, executive.monthly_revenue, executive.yoy_performance, executive.region_share,
        executive.region_year_share, executive.customer_mix, executive.status_by_segment,
        executive.acquisition_monthly, executive.acquisition_yearly, executive.c360_top_ltv,
        executive.c360_bottom_health,
        ecommerce.ecommerce_kpis, ecommerce.quarterly_revenue, ecommerce.quarterly_pivot,
        ecommerce.seasonality_index, ecommerce.q2_category_yoy, ecommerce.category_monthly, ecommerce.product_mix,
        ecommerce.top_subcategories, ecommerce.category_summary, ecommerce.discount_by_segment,
        ecommerce.monthly_return_rate, ecommerce.return_reasons, ecommerce.returns_by_category,
        saas.saas_kpis, saas.saas_status_churn, saas.plan_status_metrics, saas.plan_mean_of_means, saas.mrr_total,
        saas.mrr_movement_totals, saas.mrr_waterfall, saas.churn_monthly, saas.churn_tenure, saas.churn_cliff_share,
        saas.tickets_monthly_priority, saas.ticket_resolution, saas.ticket_categories, saas.unresolved_rate,
        saas.usage_score_hist,
        product.product_kpis, product.pareto_users, product.user_event_stats, product.pareto_sample,
        product.adoption_depth, product.event_types, product.feature_launch_ramp, product.feature_launch_rollup,
        product.module_penetration, product.adopters_vs_rest,
        payments.payments_kpis, payments.dtp_monthly, payments.dtp_hist, payments.segment_method_dtp,
        payments.segment_vs_terms, payments.method_mix, payments.quarterly_ar, payments.invoice_status_year,
        crm.crm_kpis, crm.pipeline_funnel, crm.pipeline_by_stage, crm.pipeline_by_product, crm.health_hist,
        crm.tier_summary, crm.activity_monthly, crm.activity_outcomes, crm.rep_leaderboard, crm.health_vs_activity,
        crm.activity_by_tier,
    )
}
REPORTS |= {
    "monthly_return_rate_inner": clean(lambda w: ecommerce.monthly_return_rate(w, "inner")),
    "engagement_monthly": clean(lambda w: product.engagement(w, "month")),
    "engagement_daily": clean(lambda w: product.engagement(w, "day")),
    "top20_share": clean(product.top_share),
    "period_region_compare": clean(lambda w: payments.period_region_compare(w, "Q3 1998", QUARTER_MONTHS)),
    "period_region_delta": clean(lambda w: payments.period_region_delta(w, "Q3 1998", QUARTER_MONTHS)),
    "orphan_payments": dirty(payments.orphan_payments),
    "null_notes_rate": dirty(crm.null_notes_rate),
}

# The same reports as users meet them: over degraded tables, through the governed views.
GOVERNED: dict[str, Query] = {
    f"{f.__name__}_governed": dirty(f)
    for f in (
        executive.exec_kpis, executive.monthly_revenue, executive.yoy_performance, executive.region_share,
        executive.region_year_share, executive.customer_mix, executive.status_by_segment,
        executive.acquisition_monthly,
        ecommerce.ecommerce_kpis, ecommerce.quarterly_revenue, ecommerce.q2_category_yoy, ecommerce.category_monthly,
        ecommerce.product_mix, ecommerce.top_subcategories, ecommerce.category_summary, ecommerce.discount_by_segment,
        ecommerce.monthly_return_rate, ecommerce.return_reasons, ecommerce.returns_by_category,
        payments.payments_kpis, payments.dtp_monthly, payments.dtp_hist, payments.segment_method_dtp,
        payments.segment_vs_terms, payments.method_mix, payments.quarterly_ar,
        saas.saas_kpis, saas.saas_status_churn, saas.plan_status_metrics, saas.mrr_total, saas.mrr_movement_totals,
        saas.mrr_waterfall, saas.churn_monthly, saas.churn_tenure, saas.churn_cliff_share, saas.tickets_monthly_priority,
        saas.ticket_resolution, saas.ticket_categories, saas.unresolved_rate, saas.usage_score_hist,
        product.product_kpis, product.user_event_stats, product.adoption_depth, product.event_types,
        product.feature_launch_ramp, product.feature_launch_rollup, product.module_penetration, product.adopters_vs_rest,
        crm.crm_kpis, crm.pipeline_funnel, crm.pipeline_by_stage, crm.pipeline_by_product, crm.health_hist,
        crm.tier_summary, crm.activity_monthly, crm.activity_outcomes, crm.rep_leaderboard, crm.health_vs_activity,
        crm.activity_by_tier,
    )
}

CHECKS: dict[str, Query] = {
    "val_row_counts": dirty(calibrate.row_counts),
    "val_month_multiplier": clean(calibrate.month_multiplier),
    "val_yoy": clean(calibrate.yoy),
    "val_january_returns": clean(calibrate.january_returns),
    "val_monthly_churn": clean(calibrate.monthly_churn),
    "val_nrr": clean(lambda w: calibrate.nrr(w, 1999)),
    "val_region_delay": clean(lambda w: calibrate.region_delay(w, "Europe", *QUARTER)),
    "val_quarter_dip": clean(lambda w: calibrate.quarter_dip(w, 1999)),
    "val_module_use": clean(calibrate.module_use),
    "val_user_concentration": clean(calibrate.user_concentration),
}

QUERIES: dict[str, Query] = {
    **SOURCES, **EXCLUSIONS, **NORMALISATIONS, **CLEAN_VIEWS, **FLAGS, **PROFILES, **DEGRADATIONS, **DERIVED, **REPORTS,
    **GOVERNED, **CHECKS,
}
