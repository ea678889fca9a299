"""Intermediate models I1-I3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions.macros import seconds_between
from emporium.operators.latest import latest_per_key


def order_items_summary(stg_order_items: DataFrame) -> DataFrame:
    """Per order: count, quantity, cents and dollars totals (partial agg map-side)."""
    return stg_order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum(F.col("unit_price_cents") * F.col("quantity")).alias("calculated_total_cents"),
        F.sum(F.col("unit_price_dollars") * F.col("quantity")).cast("decimal(18,2)")
         .alias("calculated_total_dollars"))


def int_orders_with_payments(stg_orders: DataFrame, stg_order_items: DataFrame,
                             stg_payments: DataFrame) -> DataFrame:  # I1
    """Orders LEFT JOIN item summary LEFT JOIN payments.

    All three sides are fact-sized, so these are shuffle joins on order_id;
    the item summary is aggregated before it is shuffled for the join and
    the two joins share the order_id partitioning (one exchange per side).
    """
    o = stg_orders.select(
        "order_id", "customer_id", "order_date", F.col("status").alias("order_status"),
        F.col("total_amount_cents").alias("order_total_cents"),
        F.col("total_amount_dollars").alias("order_total_dollars"),
        "shipping_address_id", "order_updated_at")
    p = stg_payments.select(
        "order_id", "payment_id", F.col("amount_cents").alias("payment_amount_cents"),
        F.col("amount_dollars").alias("payment_amount_dollars"),
        F.col("currency").alias("payment_currency"), F.col("status").alias("payment_status"),
        "payment_method", F.col("created_at").alias("payment_created_at"))
    return (o.join(order_items_summary(stg_order_items), "order_id", "left")
            .join(p, "order_id", "left"))


def int_product_inventory_current(stg_inventory: DataFrame, stg_products: DataFrame) -> DataFrame:  # I2
    """Newest inventory row per (product, warehouse), for live products.

    Ties on updated_at go to the highest inventory_id (then other columns).
    """
    inv = stg_inventory.select("inventory_id", "product_id", "warehouse_location", "quantity",
                               "updated_at")
    latest = latest_per_key(inv, ["product_id", "warehouse_location"], ["updated_at", "inventory_id"])
    p = stg_products.select("product_id", "product_name", "category", "price_dollars")
    return latest.join(p, "product_id", "inner").select(
        "inventory_id", "product_id", "product_name", "category", "price_dollars",
        "warehouse_location", "quantity", F.col("updated_at").alias("inventory_updated_at"))


def int_sessions_mapped_to_users(stg_sessions: DataFrame, stg_users: DataFrame) -> DataFrame:  # I3
    """Sessions LEFT JOIN users. Anonymous sessions match nobody, but all have
    the null key; a hash of the session in its place spreads them over the
    partitions instead of piling them up in one, and the join condition still
    wants a user id, so a hash that happens to be some id matches nothing."""
    u = stg_users.select(F.col("user_id").alias("__user"), F.col("full_name").alias("user_name"),
                         F.col("email").alias("user_email"), F.col("tier").alias("user_tier"))
    s = stg_sessions.withColumn("__key", F.coalesce("user_id", F.xxhash64("session_id")))
    return s.join(u, (s["__key"] == u["__user"]) & s["user_id"].isNotNull(), "left").select(
        "session_id", "user_id", "user_name", "user_email", "user_tier", "session_start",
        "session_end", "device_type", "channel", "landing_page",
        F.col("user_id").isNull().alias("is_anonymous"),
        seconds_between("session_start", "session_end").alias("session_duration_seconds"))
