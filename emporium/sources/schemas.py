"""Declared schemas of the 14 raw shop tables (never inferred).

Timestamps are ``timestamp_ntz``: the sources carry wall-clock times without
a zone, which is exactly what the warehouse's ``timestamp`` meant.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, S, B, TS = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields]
                        + [T.StructField("_etl_loaded_at", TS, True)])


RAW_SCHEMAS: dict[str, T.StructType] = {
    # app_db
    "users": _schema(("user_id", L), ("email", S), ("name", S), ("tier", S),
                     ("created_at", TS), ("updated_at", TS), ("is_deleted", B)),
    "products": _schema(("product_id", L), ("name", S), ("category", S), ("price_cents", L),
                        ("created_at", TS), ("updated_at", TS), ("is_deleted", B)),
    "inventory": _schema(("inventory_id", L), ("product_id", L), ("warehouse_location", S),
                         ("quantity", L), ("updated_at", TS)),
    "addresses": _schema(("address_id", L), ("user_id", L), ("street", S), ("city", S),
                         ("state", S), ("zip", S), ("country", S), ("is_default", B)),
    # shopify
    "orders": _schema(("order_id", L), ("customer_id", L), ("order_date", TS), ("status", S),
                      ("total_amount_cents", L), ("shipping_address_id", L),
                      ("order_updated_at", TS)),
    "order_items": _schema(("order_item_id", L), ("order_id", L), ("product_id", L),
                           ("quantity", L), ("unit_price_cents", L)),
    "shopify_refunds": _schema(("refund_id", L), ("order_id", L), ("reason", S),
                               ("refund_amount_cents", L), ("refunded_at", TS)),
    # stripe
    "payments": _schema(("payment_id", L), ("order_id", L), ("amount_cents", L), ("currency", S),
                        ("status", S), ("payment_method", S), ("created_at", TS)),
    "charges": _schema(("charge_id", L), ("payment_id", L), ("amount_cents", L), ("currency", S),
                       ("status", S), ("created_at", TS)),
    "stripe_refunds": _schema(("refund_id", L), ("charge_id", L), ("amount_cents", L),
                              ("reason", S), ("status", S), ("created_at", TS)),
    "disputes": _schema(("dispute_id", L), ("charge_id", L), ("amount_cents", L), ("reason", S),
                        ("status", S), ("created_at", TS)),
    # web_analytics
    "sessions": _schema(("session_id", S), ("user_id", L), ("session_start", TS),
                        ("session_end", TS), ("device_type", S), ("channel", S),
                        ("landing_page", S)),
    "events": _schema(("event_id", S), ("session_id", S), ("event_type", S),
                      ("event_timestamp", TS), ("page_url", S)),
    "page_views": _schema(("page_view_id", S), ("session_id", S), ("page_url", S),
                          ("view_timestamp", TS), ("duration_seconds", L)),
}

PRIMARY_KEYS: dict[str, str] = {
    "users": "user_id", "products": "product_id", "inventory": "inventory_id",
    "addresses": "address_id", "orders": "order_id", "order_items": "order_item_id",
    "shopify_refunds": "refund_id", "payments": "payment_id", "charges": "charge_id",
    "stripe_refunds": "refund_id", "disputes": "dispute_id", "sessions": "session_id",
    "events": "event_id", "page_views": "page_view_id",
}

SOURCE_OF: dict[str, str] = {
    "users": "app_db", "products": "app_db", "inventory": "app_db", "addresses": "app_db",
    "orders": "shopify", "order_items": "shopify", "shopify_refunds": "shopify",
    "payments": "stripe", "charges": "stripe", "stripe_refunds": "stripe", "disputes": "stripe",
    "sessions": "web_analytics", "events": "web_analytics", "page_views": "web_analytics",
}

RAW_TABLES = tuple(RAW_SCHEMAS)
