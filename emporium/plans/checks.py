"""Declared tests of the warehouse as data (the schema-file tests), plus the
two singular tests (Q8, Q9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators.quality import Check

# Accepted values declared for the marts.
TIERS = ("gold", "silver", "bronze")
CATEGORIES = ("electronics", "accessories", "lifestyle")
STOCK_STATUSES = ("in_stock", "low_stock", "out_of_stock")
PAYMENT_STATUSES = ("succeeded", "pending", "failed", "refunded")
SOURCE_SYSTEMS = ("shopify", "stripe")
ORDER_STATUSES = ("completed", "pending", "cancelled", "returned")
PAYMENT_METHODS = ("credit_card", "paypal", "gift_card", "bank_transfer")
DEVICE_TYPES = ("desktop", "mobile", "tablet")
CHANNELS = ("organic_search", "paid_search", "direct", "email", "social", "referral")
EVENT_TYPES = ("page_view", "product_click", "add_to_cart", "checkout", "purchase")
DISPUTE_STATUSES = ("under_review", "won", "lost")
DAILY_REVENUE_ROWS = (1, 1000)
MAX_SESSION_SECONDS = 86400  # our bound for the duration check (not given upstream)


def _pk(model: str, col: str) -> list[Check]:
    return [Check(model, col, "unique"), Check(model, col, "not_null")]


def _nn(model: str, *cols: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in cols]


def _nneg(model: str, *cols: str) -> list[Check]:
    return [Check(model, c, "not_negative") for c in cols]


def _av(model: str, col: str, values: tuple) -> Check:
    return Check(model, col, "accepted_values", values)


MART_CHECKS: list[Check] = [
    *_pk("dim_customers", "customer_key"), *_pk("dim_customers", "user_id"),
    *_nn("dim_customers", "full_name", "tier"), _av("dim_customers", "tier", TIERS),
    *_nneg("dim_customers", "lifetime_order_count", "lifetime_spend_dollars"),
    *_pk("dim_products", "product_key"), *_pk("dim_products", "product_id"),
    *_nn("dim_products", "product_name", "category", "price_dollars", "stock_status"),
    _av("dim_products", "stock_status", STOCK_STATUSES), *_nneg("dim_products", "total_stock_quantity"),
    *_pk("dim_dates", "date_day"), *_nn("dim_dates", "year", "month", "day_of_month"),
    *_pk("fct_orders", "order_id"), *_nn("fct_orders", "customer_id", "order_total_dollars"),
    *_nneg("fct_orders", "order_total_dollars", "payment_amount_dollars"),
    *_pk("fct_payments", "payment_id"), *_nn("fct_payments", "order_id", "amount_dollars"),
    *_nneg("fct_payments", "amount_dollars"), *_nn("fct_payments", "currency"),
    Check("fct_payments", "currency", "valid_currency_code"), *_nn("fct_payments", "status"),
    _av("fct_payments", "status", PAYMENT_STATUSES),
    *_pk("fct_refunds", "refund_key"), *_nn("fct_refunds", "refund_id", "order_id", "source_system"),
    _av("fct_refunds", "source_system", SOURCE_SYSTEMS), *_nn("fct_refunds", "refund_amount_dollars"),
    *_nneg("fct_refunds", "refund_amount_dollars"),
    *_pk("rpt_daily_revenue", "revenue_date"), *_nn("rpt_daily_revenue", "order_count"),
    *_nneg("rpt_daily_revenue", "order_count"), *_nn("rpt_daily_revenue", "gross_revenue_dollars"),
    *_nneg("rpt_daily_revenue", "gross_revenue_dollars"), *_nn("rpt_daily_revenue", "total_refund_dollars"),
    *_nneg("rpt_daily_revenue", "total_refund_dollars"),
    Check("rpt_daily_revenue", None, "row_count_between", DAILY_REVENUE_ROWS),
    *_pk("fct_sessions", "session_id"), *_nneg("fct_sessions", "session_duration_seconds"),
    *_nn("fct_sessions", "channel", "device_type", "converted"),
    Check("fct_sessions", "session_duration_seconds", "expression",
          expr=f"session_duration_seconds > {MAX_SESSION_SECONDS}"),
    *_pk("fct_attribution", "order_id"), *_nn("fct_attribution", "customer_id", "order_total_dollars"),
    *_nneg("fct_attribution", "order_total_dollars"),
    *_pk("rpt_channel_performance", "channel"), *_nn("rpt_channel_performance", "session_count"),
    *_nneg("rpt_channel_performance", "session_count"),
    *_nn("rpt_channel_performance", "attributed_revenue_dollars"),
    *_nneg("rpt_channel_performance", "attributed_revenue_dollars"),
    *_nn("rpt_channel_performance", "conversion_rate"),
    *_pk("int_orders_with_payments", "order_id"),
    *_nn("int_orders_with_payments", "customer_id", "order_status"),
    *_nneg("int_orders_with_payments", "payment_amount_cents"),
    *_pk("int_sessions_mapped_to_users", "session_id"),
    *_nneg("int_sessions_mapped_to_users", "session_duration_seconds"),
    *_pk("int_product_inventory_current", "inventory_id"),
    *_nn("int_product_inventory_current", "product_id", "quantity"),
    *_nneg("int_product_inventory_current", "quantity"),
]

STAGING_CHECKS: list[Check] = [
    # app_db
    *_pk("stg_users", "user_id"), *_nn("stg_users", "full_name", "tier"), _av("stg_users", "tier", TIERS),
    *_nn("stg_users", "created_at", "updated_at"),
    *_pk("stg_products", "product_id"), *_nn("stg_products", "product_name", "category"),
    _av("stg_products", "category", CATEGORIES), *_nn("stg_products", "price_cents"),
    *_nneg("stg_products", "price_cents"), *_nn("stg_products", "price_dollars", "created_at"),
    *_pk("stg_inventory", "inventory_id"),
    *_nn("stg_inventory", "product_id", "warehouse_location", "quantity"), *_nneg("stg_inventory", "quantity"),
    *_pk("stg_addresses", "address_id"), *_nn("stg_addresses", "user_id", "country", "is_default"),
    # shopify
    *_pk("stg_orders", "order_id"), *_nn("stg_orders", "customer_id", "order_date", "status"),
    _av("stg_orders", "status", ORDER_STATUSES), *_nn("stg_orders", "total_amount_cents"),
    *_nneg("stg_orders", "total_amount_cents"), *_nn("stg_orders", "total_amount_dollars", "order_updated_at"),
    *_pk("stg_order_items", "order_item_id"),
    *_nn("stg_order_items", "order_id", "product_id", "quantity"), *_nneg("stg_order_items", "quantity"),
    *_nn("stg_order_items", "unit_price_cents"), *_nneg("stg_order_items", "unit_price_cents"),
    *_nn("stg_order_items", "unit_price_dollars"),
    # the generic referential test, attached here (upstream defines it without using it)
    Check("stg_order_items", "order_id", "referential_integrity", ("stg_orders", "order_id")),
    *_pk("stg_shopify_refunds", "refund_id"), *_nn("stg_shopify_refunds", "order_id", "reason"),
    *_nn("stg_shopify_refunds", "refund_amount_cents"), *_nneg("stg_shopify_refunds", "refund_amount_cents"),
    *_nn("stg_shopify_refunds", "refund_amount_dollars", "refunded_at"),
    # stripe
    *_pk("stg_payments", "payment_id"), *_nn("stg_payments", "order_id", "amount_cents"),
    *_nneg("stg_payments", "amount_cents"), *_nn("stg_payments", "amount_dollars", "currency"),
    Check("stg_payments", "currency", "valid_currency_code"), *_nn("stg_payments", "status"),
    _av("stg_payments", "status", PAYMENT_STATUSES), *_nn("stg_payments", "payment_method"),
    _av("stg_payments", "payment_method", PAYMENT_METHODS),
    *_pk("stg_charges", "charge_id"), *_nn("stg_charges", "payment_id", "amount_cents"),
    *_nneg("stg_charges", "amount_cents"), *_nn("stg_charges", "amount_dollars", "currency"),
    Check("stg_charges", "currency", "valid_currency_code"), *_nn("stg_charges", "status"),
    _av("stg_charges", "status", PAYMENT_STATUSES),
    *_pk("stg_stripe_refunds", "refund_id"), *_nn("stg_stripe_refunds", "charge_id", "amount_cents"),
    *_nneg("stg_stripe_refunds", "amount_cents"),
    *_nn("stg_stripe_refunds", "amount_dollars", "reason", "status"),
    *_pk("stg_disputes", "dispute_id"), *_nn("stg_disputes", "charge_id", "amount_cents"),
    *_nneg("stg_disputes", "amount_cents"), *_nn("stg_disputes", "amount_dollars", "reason", "status"),
    _av("stg_disputes", "status", DISPUTE_STATUSES),
    # web_analytics
    *_pk("stg_sessions", "session_id"), *_nn("stg_sessions", "session_start", "session_end", "device_type"),
    _av("stg_sessions", "device_type", DEVICE_TYPES), *_nn("stg_sessions", "channel"),
    _av("stg_sessions", "channel", CHANNELS),
    *_pk("stg_events", "event_id"), *_nn("stg_events", "session_id", "event_type"),
    _av("stg_events", "event_type", EVENT_TYPES), *_nn("stg_events", "event_timestamp"),
    *_pk("stg_page_views", "page_view_id"),
    *_nn("stg_page_views", "session_id", "page_url", "view_timestamp", "duration_seconds"),
    *_nneg("stg_page_views", "duration_seconds"),
]

ALL_CHECKS = MART_CHECKS + STAGING_CHECKS


def checked_columns(model: str) -> set[str]:
    """Columns of a model that some check names."""
    return {c.column for c in ALL_CHECKS if c.model == model and c.column}


def assert_no_orphaned_order_items(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:  # Q8
    return (stg_order_items.select("order_item_id", "order_id")
            .join(stg_orders.select("order_id"), "order_id", "left_anti")
            .select("order_item_id", "order_id"))


def assert_revenue_reconciles(fct_orders: DataFrame, fct_payments: DataFrame) -> DataFrame:  # Q9
    o = fct_orders.where((F.col("order_status") == "completed") & (F.col("payment_status") == "succeeded")
                         ).select("order_id", "order_total_cents")
    p = (fct_payments.where(F.col("status") == "succeeded").groupBy("order_id")
         .agg(F.sum("amount_cents").alias("total_payment_cents")))
    return (o.join(p, "order_id", "inner")
            .where(F.col("order_total_cents") != F.col("total_payment_cents"))
            .select("order_id", "order_total_cents", "total_payment_cents",
                    (F.col("order_total_cents") - F.col("total_payment_cents")).alias("difference_cents")))
