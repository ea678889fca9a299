"""Core marts M1-M5 and M11."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.functions.macros import date_spine, date_spine_between, surrogate_key
from emporium.operators.latest import latest_per_key
from emporium.plans.intermediate import int_orders_with_payments

# The calendar range of the date dimension.
DATE_SPINE_START = "2023-01-01"
DATE_SPINE_END = "2025-12-31"
LOW_STOCK_BELOW = 50
ORDER_LOOKBACK = "72 HOURS"   # late-arriving orders

FCT_ORDER_COLUMNS = [
    "order_id", "customer_id", "order_date", "order_status", "order_total_cents",
    "order_total_dollars", "shipping_address_id", "order_updated_at", "item_count",
    "total_quantity", "calculated_total_cents", "calculated_total_dollars", "payment_id",
    "payment_amount_cents", "payment_amount_dollars", "payment_currency", "payment_status",
    "payment_method", "payment_created_at"]

FCT_PAYMENT_COLUMNS = ["payment_id", "order_id", "amount_cents", "amount_dollars", "currency",
                       "status", "payment_method", "created_at"]


def default_addresses(stg_addresses: DataFrame) -> DataFrame:
    """One default address per user: newest load, then highest address_id.

    Deviation kept on purpose: a user with two default addresses would fan
    out the customer dimension, so the choice is made explicit here.
    """
    d = stg_addresses.where(F.col("is_default") == F.lit(True)).select(
        "user_id", "_etl_loaded_at", "address_id", "street", "city", "state", "zip", "country")
    return latest_per_key(d, ["user_id"], ["_etl_loaded_at", "address_id"]).drop(
        "_etl_loaded_at", "address_id")


def customer_order_stats(stg_orders: DataFrame) -> DataFrame:
    return (stg_orders.where(F.col("status") == "completed").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lifetime_order_count"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("total_amount_dollars").cast("decimal(18,2)").alias("lifetime_spend_dollars"))
        .withColumnRenamed("customer_id", "user_id"))


def dim_customers(stg_users: DataFrame, stg_addresses: DataFrame, stg_orders: DataFrame) -> DataFrame:  # M1
    u = stg_users
    return (u.join(default_addresses(stg_addresses), "user_id", "left")
            .join(customer_order_stats(stg_orders), "user_id", "left")
            .select(surrogate_key("user_id").alias("customer_key"), "user_id", "full_name", "email",
                    "tier", F.col("created_at").alias("customer_created_at"), "street", "city",
                    "state", "zip", "country",
                    F.coalesce("lifetime_order_count", F.lit(0).cast("bigint")).alias("lifetime_order_count"),
                    "first_order_date", "last_order_date",
                    F.coalesce("lifetime_spend_dollars", F.lit(0).cast("decimal(18,2)"))
                     .alias("lifetime_spend_dollars")))


def dim_products(stg_products: DataFrame, inventory_current: DataFrame) -> DataFrame:  # M2
    inv = inventory_current.groupBy("product_id").agg(
        F.sum("quantity").alias("total_stock_quantity"),
        F.countDistinct("warehouse_location").alias("warehouse_count"))
    stock = F.coalesce("total_stock_quantity", F.lit(0).cast("bigint"))
    return stg_products.join(inv, "product_id", "left").select(
        surrogate_key("product_id").alias("product_key"), "product_id", "product_name", "category",
        "price_cents", "price_dollars", F.col("created_at").alias("product_created_at"),
        stock.alias("total_stock_quantity"),
        F.coalesce("warehouse_count", F.lit(0).cast("bigint")).alias("warehouse_count"),
        F.when(stock == 0, "out_of_stock").when(F.col("total_stock_quantity") < LOW_STOCK_BELOW,
                                                "low_stock").otherwise("in_stock").alias("stock_status"))


def dim_dates(spark: SparkSession, start: str = DATE_SPINE_START, end: str = DATE_SPINE_END,
              covering: DataFrame | None = None) -> DataFrame:  # M3
    """The calendar from ``start`` to ``end``, widened to the days in the
    first column of ``covering`` if that is given (one row of bounds, never
    collected)."""
    if covering is None:
        spine = date_spine(spark, start, end)
    else:
        day = F.col(covering.columns[0]).cast("date")
        bounds = covering.agg(F.least(F.min(day), F.lit(start).cast("date")).alias("lo"),
                              F.greatest(F.max(day), F.lit(end).cast("date")).alias("hi"))
        spine = date_spine_between(bounds, "lo", "hi")
    d = F.col("date_day")
    dow = F.dayofweek(d) - 1  # Sunday = 0
    return spine.select(
        "date_day", F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week_of_year"),
        dow.isin(0, 6).alias("is_weekend"))


def metricflow_time_spine(dates: DataFrame) -> DataFrame:  # M11
    return dates.select("date_day")


def fct_orders_full(orders_with_payments: DataFrame) -> DataFrame:  # M4, full rebuild
    return orders_with_payments.select(*FCT_ORDER_COLUMNS)


def fct_orders_since(stg: dict[str, DataFrame], cutoff: str | None) -> DataFrame:
    """The order fact of orders updated at or after ``cutoff`` (text; None: all).

    The filter is a literal on the staged orders, so it reaches their scan,
    and only items and payments of those orders are aggregated and joined.
    """
    orders, items, payments = stg["orders"], stg["order_items"], stg["payments"]
    if cutoff is not None:
        orders = orders.where(F.col("order_updated_at") >= F.lit(cutoff).cast("timestamp_ntz"))
        ids = orders.select("order_id")
        items, payments = items.join(ids, "order_id", "left_semi"), payments.join(ids, "order_id", "left_semi")
    return fct_orders_full(int_orders_with_payments(orders, items, payments))


def fct_payments_full(stg_payments: DataFrame) -> DataFrame:  # M5, full rebuild
    return stg_payments.select(*FCT_PAYMENT_COLUMNS)
