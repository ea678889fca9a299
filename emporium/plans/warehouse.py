"""Wires the models together: raw tables in, every model out, all lazy.

Python attribute access plays the role of ``ref()``; Catalyst sees one plan
per requested model and prunes what it does not need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from emporium.plans import core, finance, intermediate, marketing, staging
from emporium.session import landed


class Warehouse:
    """Every model is a plan over the raw tables; nothing is kept in memory,
    so each query reads only the columns and rows it needs. ``build`` reads
    models that others use back from their written tables.

    ``calendar``: first and last day of the date dimension. Without it the
    declared calendar is widened to the days of all orders, so that no
    order day falls outside the reports."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], calendar: tuple[str, str] | None = None):
        self.spark = spark
        self.raw = raw
        self.calendar = calendar

    def forget(self) -> None:
        """Plan every model anew, from the staged tables as they are now."""
        for name in self.MODELS + ("outside_calendar",):
            self.__dict__.pop(name, None)

    def land(self, root: str, wanted: dict[str, set[str]]) -> None:
        """Write these models, each once, into folders of ``root``: all rows,
        with the wanted columns and those that later models read. What is
        planned from then on reads them from there."""
        for step in self.COMPUTED:
            frames = {}
            for name in [n for n in step if n in wanted]:
                model, read = getattr(self, name), wanted[name] | self.READ_ON.get(name, set())
                frames[name] = model.select(*[c for c in model.columns if c in read])
            written = landed({f"{root}/{name}": df for name, df in frames.items()})
            self.__dict__.update({name: written[f"{root}/{name}"] for name in frames})
            if "orders_with_payments" in frames:  # its projection, of the columns that are there
                orders = self.orders_with_payments
                self.__dict__["fct_orders"] = orders.select(*[c for c in core.FCT_ORDER_COLUMNS if c in orders.columns])

    # staging (views)
    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return staging.stage_all(self.raw)

    # intermediate
    @cached_property
    def orders_with_payments(self) -> DataFrame:
        s = self.stg
        return intermediate.int_orders_with_payments(s["orders"], s["order_items"], s["payments"])

    @cached_property
    def inventory_current(self) -> DataFrame:
        return intermediate.int_product_inventory_current(self.stg["inventory"], self.stg["products"])

    @cached_property
    def sessions_mapped(self) -> DataFrame:
        return intermediate.int_sessions_mapped_to_users(self.stg["sessions"], self.stg["users"])

    # core
    @cached_property
    def dim_customers(self) -> DataFrame:
        s = self.stg
        return core.dim_customers(s["users"], s["addresses"], s["orders"])

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.dim_products(self.stg["products"], self.inventory_current)

    @cached_property
    def dim_dates(self) -> DataFrame:
        if self.calendar is not None:
            return core.dim_dates(self.spark, *self.calendar)
        return core.dim_dates(self.spark, covering=self.stg["orders"].select("order_date"))

    @cached_property
    def time_spine(self) -> DataFrame:
        return core.metricflow_time_spine(self.dim_dates)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return core.fct_orders_full(self.orders_with_payments)

    @cached_property
    def fct_payments(self) -> DataFrame:
        return core.fct_payments_full(self.stg["payments"])

    # finance
    @cached_property
    def fct_refunds(self) -> DataFrame:
        s = self.stg
        return finance.fct_refunds(s["shopify_refunds"], s["stripe_refunds"], s["charges"], s["payments"])

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return finance.rpt_daily_revenue(self.fct_orders, self.fct_refunds, self.dim_dates)

    @cached_property
    def refund_audit(self) -> DataFrame:
        return finance.refund_audit(self.fct_refunds)

    @cached_property
    def outside_calendar(self) -> DataFrame:
        return finance.orders_outside(self.fct_orders, core.DATE_SPINE_START, core.DATE_SPINE_END)

    # marketing
    @cached_property
    def fct_sessions(self) -> DataFrame:
        return marketing.fct_sessions_full(self.sessions_mapped, self.stg["events"])

    @cached_property
    def fct_attribution(self) -> DataFrame:
        return marketing.fct_attribution(self.fct_orders, self.fct_sessions)

    @cached_property
    def channel_performance(self) -> DataFrame:
        return marketing.rpt_channel_performance(self.fct_sessions, self.fct_attribution)

    @cached_property
    def customer_features(self) -> DataFrame:
        return marketing.customer_features(self.dim_customers)

    MODELS = ("orders_with_payments", "inventory_current", "sessions_mapped", "dim_customers",
              "dim_products", "dim_dates", "time_spine", "fct_orders", "fct_payments",
              "fct_refunds", "daily_revenue", "refund_audit", "fct_sessions", "fct_attribution",
              "channel_performance", "customer_features")

    #: Models that join, group or scan in order; each reads only those of the steps before.
    COMPUTED = (("inventory_current", "orders_with_payments", "sessions_mapped", "dim_customers", "dim_dates", "fct_refunds"),
                ("dim_products", "daily_revenue", "fct_sessions"), ("fct_attribution",), ("channel_performance",))
    #: Columns that later models read of them.
    READ_ON = {
        "orders_with_payments": {"order_id", "customer_id", "order_date", "order_status", "order_total_dollars", "total_quantity"},
        "inventory_current": {"product_id", "warehouse_location", "quantity"},
        "sessions_mapped": set(marketing.FCT_SESSION_COLUMNS),
        "dim_dates": {"date_day"},
        "fct_refunds": {"source_system", "refunded_at", "refund_amount_dollars"},
        "fct_sessions": {"session_id", "user_id", "session_start", "session_end", "session_duration_seconds", "channel",
                         "landing_page", "converted"},
        "fct_attribution": {"order_id", "order_total_dollars", "attribution_channel"},
    }
