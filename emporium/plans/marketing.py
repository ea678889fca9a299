"""Marketing marts M8-M10 and the ML feature export X2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators.asof import asof_latest

# The event types counted per session.
EVENT_COUNTS = ["page_view", "product_click", "add_to_cart", "checkout", "purchase"]
SESSION_LOOKBACK = "24 HOURS"

FCT_SESSION_COLUMNS = [
    "session_id", "user_id", "user_name", "user_email", "user_tier", "session_start",
    "session_end", "session_duration_seconds", "device_type", "channel", "landing_page",
    "is_anonymous", "event_count", "page_view_count", "product_click_count",
    "add_to_cart_count", "checkout_count", "purchase_count", "converted"]


def events_summary(stg_events: DataFrame) -> DataFrame:
    """Per session: total and per-type event counts (one partial aggregate)."""
    et = F.col("event_type")
    return stg_events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.count(F.when(et == t, F.lit(1))).alias(f"{t}_count") for t in EVENT_COUNTS])


def fct_sessions_full(sessions_mapped: DataFrame, stg_events: DataFrame) -> DataFrame:  # M8
    e = events_summary(stg_events)
    zero = F.lit(0).cast("bigint")
    counts = ["event_count"] + [f"{t}_count" for t in EVENT_COUNTS]
    return sessions_mapped.join(e, "session_id", "left").select(
        *[c for c in FCT_SESSION_COLUMNS if c not in counts and c != "converted"],
        *[F.coalesce(c, zero).alias(c) for c in counts],
        (F.coalesce("purchase_count", zero) > 0).alias("converted")).select(*FCT_SESSION_COLUMNS)


def fct_sessions_since(stg: dict[str, DataFrame], sessions_mapped: DataFrame, cutoff: str | None) -> DataFrame:
    """The session fact of sessions starting at or after ``cutoff`` (text; None: all).

    The filter is a literal on the staged sessions; events are cut down to
    those sessions before they are counted.
    """
    if cutoff is None:
        return fct_sessions_full(sessions_mapped, stg["events"])
    late = F.col("session_start") >= F.lit(cutoff).cast("timestamp_ntz")
    ids = stg["sessions"].where(late).select("session_id")
    return fct_sessions_full(sessions_mapped.where(late), stg["events"].join(ids, "session_id", "left_semi"))


def fct_sessions_changed(raw: dict[str, DataFrame], stg: dict[str, DataFrame], sessions_mapped: DataFrame,
                         watermark: str | None) -> DataFrame:
    """The session fact of sessions that something loaded after ``watermark`` (text; None: all) has a part in.

    Newly loaded events and sessions name the sessions, by a filter on the
    load time that reaches both scans; only the events of those sessions are
    then counted. A session whose events came late is found however old it is.
    """
    if watermark is None:
        return fct_sessions_full(sessions_mapped, stg["events"])
    new = F.col("_etl_loaded_at") > F.lit(watermark).cast("timestamp_ntz")
    touched = raw["events"].where(new).select("session_id").unionByName(raw["sessions"].where(new).select("session_id")).distinct()
    return fct_sessions_full(sessions_mapped.join(touched, "session_id", "left_semi"),
                             stg["events"].join(touched, "session_id", "left_semi"))


def fct_attribution(fct_orders: DataFrame, fct_sessions: DataFrame, bucket: str = "7 days",
                    strategy: str = "auto") -> DataFrame:  # M9
    """Last touch: per completed order, the customer's newest converted,
    identified session starting at or before the order (ties: highest
    session_id). Orders without one keep null attribution columns."""
    orders = fct_orders.where(F.col("order_status") == "completed").select(
        "order_id", "customer_id", "order_date", "order_total_dollars")
    sessions = fct_sessions.where((F.col("converted") == F.lit(True)) & F.col("user_id").isNotNull()).select(
        "session_id", "user_id", "session_start", "channel", "landing_page")
    out = asof_latest(orders, sessions, "customer_id", "order_date", "user_id", "session_start",
                      "session_id", ["session_id", "channel", "landing_page", "session_start"],
                      prefix="attribution_", bucket=bucket, strategy=strategy)
    return out.select("order_id", "customer_id", "order_date", "order_total_dollars",
                      "attribution_session_id", "attribution_channel", "attribution_landing_page",
                      "attribution_session_start")


def rpt_channel_performance(fct_sessions: DataFrame, attribution: DataFrame) -> DataFrame:  # M10
    cs = fct_sessions.groupBy("channel").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.countDistinct("user_id").alias("unique_user_count"),
        F.count(F.when(F.col("converted"), F.lit(1))).alias("converted_session_count"),
        # mean of the durations from an exact integer sum of microseconds:
        # a sum of doubles depends on partition order, this does not
        (F.sum(F.timestamp_diff("MICROSECOND", F.col("session_start"), F.col("session_end"))).cast("double")
         / F.count("session_duration_seconds") / F.lit(1e6)).alias("avg_session_duration_seconds"))
    cr = attribution.groupBy(F.col("attribution_channel").alias("channel")).agg(
        F.countDistinct("order_id").alias("attributed_order_count"),
        F.sum("order_total_dollars").cast("decimal(18,2)").alias("attributed_revenue_dollars"))
    # One row per channel on both sides; AQE picks a broadcast from the
    # measured size at runtime, so no unchecked broadcast hint is given.
    return cs.join(cr, "channel", "left").select(
        "channel", "session_count", "unique_user_count", "converted_session_count",
        "avg_session_duration_seconds",
        F.coalesce("attributed_order_count", F.lit(0).cast("bigint")).alias("attributed_order_count"),
        F.coalesce("attributed_revenue_dollars", F.lit(0).cast("decimal(18,2)")).alias("attributed_revenue_dollars"),
        F.when(F.col("session_count") > 0,
               F.col("converted_session_count").cast("double") / F.col("session_count"))
         .otherwise(F.lit(0.0)).alias("conversion_rate"))


def customer_features(dim_customers: DataFrame) -> DataFrame:  # X2
    return dim_customers.select("customer_key", "user_id", "lifetime_spend_dollars",
                                "lifetime_order_count", "tier", "country")
