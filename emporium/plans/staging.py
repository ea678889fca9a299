"""Staging models S1-S14: rename, normalise case, cents -> dollars, drop
soft-deleted rows. Pure projections/filters: no shuffle, pushed to the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions.macros import cents_to_dollars


def stg_users(users: DataFrame) -> DataFrame:  # S1
    return users.where(F.col("is_deleted") == F.lit(False)).select(
        "user_id", "email", F.col("name").alias("full_name"), F.lower("tier").alias("tier"),
        "created_at", "updated_at", "_etl_loaded_at")


def stg_products(products: DataFrame) -> DataFrame:  # S2
    return products.where(F.col("is_deleted") == F.lit(False)).select(
        "product_id", F.col("name").alias("product_name"), F.lower("category").alias("category"),
        "price_cents", cents_to_dollars("price_cents").alias("price_dollars"),
        "created_at", "updated_at", "_etl_loaded_at")


def stg_inventory(inventory: DataFrame) -> DataFrame:  # S3
    return inventory.select("inventory_id", "product_id", "warehouse_location", "quantity",
                            "updated_at", "_etl_loaded_at")


def stg_addresses(addresses: DataFrame) -> DataFrame:  # S4
    return addresses.select("address_id", "user_id", "street", "city", "state", "zip",
                            F.upper("country").alias("country"), "is_default", "_etl_loaded_at")


def stg_orders(orders: DataFrame) -> DataFrame:  # S5
    return orders.select(
        "order_id", "customer_id", "order_date", F.lower("status").alias("status"),
        "total_amount_cents", cents_to_dollars("total_amount_cents").alias("total_amount_dollars"),
        "shipping_address_id", "order_updated_at", "_etl_loaded_at")


def stg_order_items(items: DataFrame) -> DataFrame:  # S6
    return items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price_cents",
                        cents_to_dollars("unit_price_cents").alias("unit_price_dollars"),
                        "_etl_loaded_at")


def stg_shopify_refunds(refunds: DataFrame) -> DataFrame:  # S7
    return refunds.select("refund_id", "order_id", "reason", "refund_amount_cents",
                          cents_to_dollars("refund_amount_cents").alias("refund_amount_dollars"),
                          "refunded_at", "_etl_loaded_at")


def stg_payments(payments: DataFrame) -> DataFrame:  # S8
    return payments.select(
        "payment_id", "order_id", "amount_cents", cents_to_dollars("amount_cents").alias("amount_dollars"),
        F.lower("currency").alias("currency"), F.lower("status").alias("status"),
        F.lower("payment_method").alias("payment_method"), "created_at", "_etl_loaded_at")


def stg_charges(charges: DataFrame) -> DataFrame:  # S9
    return charges.select(
        "charge_id", "payment_id", "amount_cents", cents_to_dollars("amount_cents").alias("amount_dollars"),
        F.lower("currency").alias("currency"), F.lower("status").alias("status"),
        "created_at", "_etl_loaded_at")


def stg_stripe_refunds(refunds: DataFrame) -> DataFrame:  # S10
    return refunds.select(
        "refund_id", "charge_id", "amount_cents", cents_to_dollars("amount_cents").alias("amount_dollars"),
        "reason", F.lower("status").alias("status"), "created_at", "_etl_loaded_at")


def stg_disputes(disputes: DataFrame) -> DataFrame:  # S11
    return disputes.select(
        "dispute_id", "charge_id", "amount_cents", cents_to_dollars("amount_cents").alias("amount_dollars"),
        "reason", F.lower("status").alias("status"), "created_at", "_etl_loaded_at")


def stg_sessions(sessions: DataFrame) -> DataFrame:  # S12
    return sessions.select(
        "session_id", "user_id", "session_start", "session_end",
        F.lower("device_type").alias("device_type"), F.lower("channel").alias("channel"),
        "landing_page", "_etl_loaded_at")


def stg_events(events: DataFrame) -> DataFrame:  # S13 (ephemeral: inlined by the caller)
    return events.select("event_id", "session_id", F.lower("event_type").alias("event_type"),
                         "event_timestamp", "page_url", "_etl_loaded_at")


def stg_page_views(page_views: DataFrame) -> DataFrame:  # S14
    return page_views.select("page_view_id", "session_id", "page_url", "view_timestamp",
                             "duration_seconds", "_etl_loaded_at")


STAGING = {
    "users": stg_users, "products": stg_products, "inventory": stg_inventory,
    "addresses": stg_addresses, "orders": stg_orders, "order_items": stg_order_items,
    "shopify_refunds": stg_shopify_refunds, "payments": stg_payments, "charges": stg_charges,
    "stripe_refunds": stg_stripe_refunds, "disputes": stg_disputes, "sessions": stg_sessions,
    "events": stg_events, "page_views": stg_page_views,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging views over ``raw``, built lazily per table."""
    from emporium.sources.testdata import LazyTables

    return LazyTables(list(raw), lambda t: STAGING[t](raw[t]))
