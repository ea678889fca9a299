"""Finance marts M6, M7 and the refund audit X1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions.macros import surrogate_key

REFUND_COLUMNS = ["refund_id", "order_id", "reason", "refund_amount_cents",
                  "refund_amount_dollars", "refunded_at", "source_system"]


def fct_refunds(stg_shopify_refunds: DataFrame, stg_stripe_refunds: DataFrame,
                stg_charges: DataFrame, stg_payments: DataFrame) -> DataFrame:  # M6
    shop = stg_shopify_refunds.select(*REFUND_COLUMNS[:-1], F.lit("shopify").alias("source_system"))
    c = stg_charges.select("charge_id", "payment_id")
    p = stg_payments.select("payment_id", "order_id")
    stripe = (stg_stripe_refunds.join(c, "charge_id", "inner").join(p, "payment_id", "inner")
              .select("refund_id", "order_id", "reason",
                      F.col("amount_cents").alias("refund_amount_cents"),
                      F.col("amount_dollars").alias("refund_amount_dollars"),
                      F.col("created_at").alias("refunded_at"),
                      F.lit("stripe").alias("source_system")))
    return shop.unionByName(stripe).select(
        surrogate_key("refund_id", "source_system").alias("refund_key"), "refund_id", "order_id",
        "source_system", "reason", "refund_amount_cents", "refund_amount_dollars", "refunded_at")


def rpt_daily_revenue(fct_orders: DataFrame, refunds: DataFrame, dates: DataFrame) -> DataFrame:  # M7
    """Completed orders and shopify refunds per day on the calendar spine,
    between the first and last completed order day.

    The order-day and refund-day aggregates have at most one row per calendar
    day, so the joins below run on day-grain data. ``dates`` should cover all
    order days (the warehouse's default does); with a fixed calendar, see
    ``orders_outside`` for what the report leaves out.
    The bounds come from a one-row aggregate joined in - never collected.
    """
    orders = fct_orders.where(F.col("order_status") == "completed")
    day = F.col("order_date").cast("date")
    daily_orders = orders.groupBy(day.alias("revenue_date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("customer_id").alias("unique_customer_count"),
        F.sum("order_total_dollars").cast("decimal(18,2)").alias("gross_revenue_dollars"),
        F.sum("total_quantity").alias("total_items_sold"))
    daily_refunds = (refunds.where(F.col("source_system") == "shopify")
                     .groupBy(F.col("refunded_at").cast("date").alias("revenue_date")).agg(
                         F.count(F.lit(1)).alias("refund_count"),
                         F.sum("refund_amount_dollars").cast("decimal(18,2)").alias("total_refund_dollars")))
    bounds = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    spine = (dates.select(F.col("date_day").alias("revenue_date"))
             .join(F.broadcast(bounds), F.col("revenue_date").between(F.col("lo"), F.col("hi")))
             .select("revenue_date"))
    zero = F.lit(0)
    gross = F.coalesce("gross_revenue_dollars", zero.cast("decimal(18,2)"))
    refund = F.coalesce("total_refund_dollars", zero.cast("decimal(18,2)"))
    return (spine.join(daily_orders, "revenue_date", "left")
            .join(daily_refunds, "revenue_date", "left")
            .select("revenue_date",
                    F.coalesce("order_count", zero.cast("bigint")).alias("order_count"),
                    F.coalesce("unique_customer_count", zero.cast("bigint")).alias("unique_customer_count"),
                    gross.alias("gross_revenue_dollars"),
                    F.coalesce("total_items_sold", zero.cast("bigint")).alias("total_items_sold"),
                    F.coalesce("refund_count", zero.cast("bigint")).alias("refund_count"),
                    refund.alias("total_refund_dollars"),
                    (gross - refund).cast("decimal(18,2)").alias("net_revenue_dollars")))


def orders_outside(fct_orders: DataFrame, start: str, end: str) -> DataFrame:
    """Completed orders whose day a fixed calendar leaves out of the daily report, before and after it."""
    day = F.col("order_date").cast("date")
    side = F.when(day < F.lit(start).cast("date"), "before").when(day > F.lit(end).cast("date"), "after")
    return (fct_orders.where(F.col("order_status") == "completed").select(side.alias("side"), "order_total_dollars")
            .where(F.col("side").isNotNull()).groupBy("side")
            .agg(F.count(F.lit(1)).alias("order_count"), F.sum("order_total_dollars").cast("decimal(18,2)").alias("gross_revenue_dollars")))


def refund_audit(refunds: DataFrame) -> DataFrame:  # X1
    """Shopify vs Stripe refunds per order: full outer join of the two halves'
    per-order totals; a row is reported when they disagree or one is missing."""
    def side(src: str, pfx: str) -> DataFrame:
        return (refunds.where(F.col("source_system") == src).groupBy("order_id").agg(
            F.count(F.lit(1)).alias(f"{pfx}_refund_count"),
            F.sum("refund_amount_cents").alias(f"{pfx}_refund_cents")))

    j = side("shopify", "shopify").join(side("stripe", "stripe"), "order_id", "full_outer")
    status = (F.when(F.col("stripe_refund_cents").isNull(), "missing_in_stripe")
              .when(F.col("shopify_refund_cents").isNull(), "missing_in_shopify")
              .when(F.col("shopify_refund_cents") != F.col("stripe_refund_cents"), "amount_mismatch")
              .otherwise("match"))
    return (j.select("order_id",
                     F.coalesce("shopify_refund_count", F.lit(0).cast("bigint")).alias("shopify_refund_count"),
                     "shopify_refund_cents",
                     F.coalesce("stripe_refund_count", F.lit(0).cast("bigint")).alias("stripe_refund_count"),
                     "stripe_refund_cents",
                     (F.coalesce("shopify_refund_cents", F.lit(0)) - F.coalesce("stripe_refund_cents", F.lit(0)))
                     .alias("difference_cents"),
                     status.alias("audit_status"))
            .where(F.col("audit_status") != "match"))
