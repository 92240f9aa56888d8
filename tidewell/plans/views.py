"""The twelve governed views."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.numbers import count_if
from tidewell.operators import exclude as ex
from tidewell.operators import normalize as nrm
from tidewell.sources.warehouse import Warehouse


def valid_customers(w: Warehouse) -> DataFrame:
    return w["customers"].select("customer_id")


def _valid_orders(w: Warehouse) -> DataFrame:
    orders = ex.exclude_future(w["orders"], "order_date", w.rules.cutoff)
    return ex.exclude_orphans(orders, valid_customers(w), "customer_id")


def customers(w: Warehouse) -> DataFrame:
    df = ex.exclude_listed(w["customers"], w["duplicate_tracking"], "customer_id", "duplicate_customer_id")
    df = nrm.standardize(df.withColumn("company_name", nrm.norm_name("company_name")), "region", w["region_mapping"])
    return df.select(
        "customer_id", "company_name", "region", "segment", "industry", "customer_type", "acquisition_date",
        "acquisition_channel", "status", "annual_revenue_tier",
    )


def orders(w: Warehouse) -> DataFrame:
    return _valid_orders(w)


def _priced_items(w: Warehouse) -> DataFrame:
    return ex.exclude_above(ex.exclude_nonpositive(w["order_items"], "unit_price"), "unit_price", w.rules.price_cap)


def order_items(w: Warehouse) -> DataFrame:
    # The order key is unique, so the inner join is a semi join.
    return ex.exclude_orphans(_priced_items(w), _valid_orders(w), "order_id")


def order_lines(w: Warehouse, *order_columns: str) -> DataFrame:
    """Clean lines with columns of their clean order, in one join.

    Equals joining the two views: the item view already holds exactly the
    lines of the orders the order view keeps.
    """
    return _priced_items(w).join(_valid_orders(w).select("order_id", *order_columns), "order_id")


def returns(w: Warehouse) -> DataFrame:
    reason = F.coalesce(F.col("reason"), F.lit(nrm.DISPLAY_TEXT["reason"]))
    df = ex.exclude_orphans(w["returns"], _valid_orders(w), "order_id")
    return df.select("return_id", "order_id", "return_date", reason.alias("reason"), "refund_amount", "status")


def saas_customers(w: Warehouse) -> DataFrame:
    return ex.exclude_orphans(w["saas_customers"], valid_customers(w), "customer_id")


def support_tickets(w: Warehouse) -> DataFrame:
    shown = F.coalesce(F.col("resolved_date").cast("string"), F.lit(nrm.DISPLAY_TEXT["resolved_date"]))
    return w["support_tickets"].withColumn("resolution_display", shown)


def usage_events(w: Warehouse) -> DataFrame:
    return ex.exclude_null(w["usage_events"], "session_id")


def feature_adoption(w: Warehouse) -> DataFrame:
    return w["feature_adoption"].select(
        "adoption_id", "saas_customer_id", "feature_module", "first_used_date", "last_used_date", "total_events",
        "monthly_active_users", "adoption_depth",
    )


def invoices(w: Warehouse) -> DataFrame:
    return ex.exclude_orphans(w["invoices"], valid_customers(w), "customer_id")


def payments(w: Warehouse) -> DataFrame:
    df = ex.exclude_future(w["payments"], "payment_date", w.rules.cutoff)
    return ex.exclude_orphans(df, w["invoices"], "invoice_id")


def activities(w: Warehouse) -> DataFrame:
    trimmed = nrm.trim_text("notes")
    return ex.exclude_future(w["activities"], "activity_date", w.rules.cutoff).select(
        "activity_id", "account_id", "activity_date", "activity_type", "subject", trimmed.alias("notes"),
        F.coalesce(trimmed, F.lit(nrm.DISPLAY_TEXT["notes"])).alias("notes_display"), "outcome",
    )


def opportunities(w: Warehouse) -> DataFrame:
    return ex.exclude_future(w["opportunities"], "close_date", w.rules.cutoff)


_SOURCES = (
    customers, orders, order_items, returns, saas_customers, support_tickets, usage_events, feature_adoption,
    invoices, payments, activities, opportunities,
)
VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {f"v_{f.__name__}_clean": f for f in _SOURCES}


def register_views(w: Warehouse) -> list[str]:
    """Create all governed views as temporary views of the same name."""
    for name in VIEWS:
        w[name].createOrReplaceTempView(name)
    return list(VIEWS)


def _marked(w: Warehouse) -> dict[str, tuple[DataFrame, Column]]:
    """Per view its raw rows, with marks from existence joins, and the condition under which the view keeps a row.

    The views themselves are semi and anti joins, which drop rows early; here
    all rows stay, so that one pass counts both kinds.
    """
    no_later = {c: F.col(c) <= F.lit(w.rules.cutoff) for c in ("order_date", "payment_date", "activity_date", "close_date")}
    price, every = F.col("unit_price"), F.lit(True)

    def of_customer(name: str, *more: str) -> DataFrame:
        return ex.mark_known(w[name].select("customer_id", *more), valid_customers(w), "customer_id", "_known")

    orders_ = of_customer("orders", "order_id", "order_date")
    good_order = F.col("_known") & no_later["order_date"]
    good_orders = orders_.filter(good_order).select("order_id")
    return {
        "customers": (ex.mark_known(w["customers"].select("customer_id"), w["duplicate_tracking"], "customer_id", "_copy", "duplicate_customer_id"), ~F.col("_copy")),
        "orders": (orders_, good_order),
        "order_items": (ex.mark_known(w["order_items"].select("order_id", "unit_price"), good_orders, "order_id", "_known"),
                        F.col("_known") & (price > 0) & (price < w.rules.price_cap)),
        "returns": (ex.mark_known(w["returns"].select("order_id"), good_orders, "order_id", "_known"), F.col("_known")),
        "saas_customers": (of_customer("saas_customers"), F.col("_known")),
        "support_tickets": (w["support_tickets"], every),
        "usage_events": (w["usage_events"], F.col("session_id").isNotNull()),
        "feature_adoption": (w["feature_adoption"], every),
        "invoices": (of_customer("invoices"), F.col("_known")),
        "payments": (ex.mark_known(w["payments"].select("invoice_id", "payment_date"), w["invoices"], "invoice_id", "_known"),
                     F.col("_known") & no_later["payment_date"]),
        "activities": (w["activities"], no_later["activity_date"]),
        "opportunities": (w["opportunities"], no_later["close_date"]),
    }


def reconcile(w: Warehouse, names: tuple[str, ...] | None = None) -> DataFrame:
    """Clean, raw and excluded row counts per view, in one pass over each view's table."""
    marked = _marked(w)
    parts = [
        rows.agg(count_if(kept).alias("clean_rows"), F.count(F.lit(1)).alias("raw_rows")).select(
            F.lit(f"v_{name}_clean").alias("view_name"), "clean_rows", "raw_rows", (F.col("raw_rows") - F.col("clean_rows")).alias("excluded"))
        for name, (rows, kept) in marked.items() if names is None or name in names
    ]
    return reduce(DataFrame.union, parts)
