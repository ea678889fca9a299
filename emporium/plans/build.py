"""A full build: judge freshness, materialise the marts as Parquet tables, take
the snapshots, run all declared checks and append one audit row.

Views (staging) and ephemeral models (intermediate) stay lazy DataFrames and
are inlined into the tables that use them (O1, O2); marts are written with a
full refresh (O3, O4) or incrementally (O7, O8). Later models read the
written Parquet of the earlier ones, which also cuts lineage. The order fact
is built from the cutoff on: only recent orders, their items and payments
are read and joined.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators import audit
from emporium.operators.bucketed import read_bucketed, write_bucketed
from emporium.operators.incremental import append_absent_table, full_refresh_table, upsert_table
from emporium.operators.freshness import source_freshness
from emporium.operators.fs import delete_paths
from emporium.operators.quality import quality_report
from emporium.operators.snapshot import snapshot_table
from emporium.operators.table_state import read_table
from emporium.plans import core, finance, marketing
from emporium.plans.checks import ALL_CHECKS, assert_no_orphaned_order_items, assert_revenue_reconciles, checked_columns
from emporium.plans.warehouse import Warehouse
from emporium.session import shared_dir

# Partition column and its SQL expression per fact table (expressions are
# built into Columns on use, so importing this module needs no session).
FACT_LAYOUT = {
    "fct_orders": ("order_month", "date_format(order_date, 'yyyy-MM')"),
    "fct_payments": ("created_month", "date_format(created_at, 'yyyy-MM')"),
    "fct_sessions": ("session_day", "date_format(session_start, 'yyyy-MM-dd')"),
}


def fact_layout(name: str) -> tuple[str, Column]:
    col, expr = FACT_LAYOUT[name]
    return col, F.expr(expr)


def build(spark: SparkSession, w: Warehouse, root: str, target_name: str = "dev",
          full_refresh: bool = False, now: str | None = None, run_id: str | None = None, buckets: int | None = None) -> dict:
    """One run: freshness, models, snapshots, all checks, and always an audit row.

    ``now`` is the time freshness is judged at and hard deletes are closed at
    (default: the clock). A stale source is reported and does not stop the
    run. If a step raises, its result is ``error``, what depends on it is not
    tried, and the audit row is written before the error goes on.

    With ``buckets`` the staged orders, items and payments are landed first
    in that many hash buckets of the order id. The order fact, the checks of
    orders with payments and the search for orphaned items then read them
    without a shuffle; without, each of these shuffles all three.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    now, run_id = now or started.strftime("%Y-%m-%d %H:%M:%S"), run_id or uuid.uuid4().hex
    results: list[dict] = []
    try:
        for r in source_freshness(w.raw, now).collect():  # a row a raw table
            results.append({"resource_type": "freshness", "name": r.table_name,
                            "status": {"error": "warn"}.get(r.status, r.status)})
        if buckets:
            _step(results, "landing", "order_tables", lambda: land_order_tables(w, f"{root}/landed", buckets))
        checked = _models(spark, w, root, full_refresh, results)
        for name, table, key, columns in SNAPSHOTS:
            _step(results, "snapshot", name, lambda t=table, k=key, c=columns, n=name: snapshot_table(
                spark, f"{root}/{n}", w.raw[t].select(*c), k, "updated_at", now, run_id))
        _checks(w, checked, results)
    finally:
        audit.log_run(spark, f"{root}/run_audit", audit.audit_row(spark, started, target_name, results))
    return {"models": sum(r["resource_type"] == "model" for r in results),
            "tests": sum(r["resource_type"] == "test" for r in results),
            "stale": [r["name"] for r in results if r["resource_type"] == "freshness" and r["status"] == "warn"],
            "failed": [r["name"] for r in results if r["status"] == "fail"]}


#: Staged tables that meet on the order id.
ORDER_TABLES = ("orders", "order_items", "payments")


def land_order_tables(w: Warehouse, root: str, buckets: int) -> None:
    """Write the staged order tables in buckets of the order id, and let the warehouse's models read them from there."""
    for name in ORDER_TABLES:
        write_bucketed(w.stg[name], f"{root}/{name}", "order_id", buckets)
    w.stg = {**{name: w.stg[name] for name in w.raw if name not in ORDER_TABLES},
             **{name: read_bucketed(w.spark, f"{root}/{name}") for name in ORDER_TABLES}}
    w.forget()


#: Snapshot, raw table, key and tracked columns.
SNAPSHOTS = (
    ("snap_customers", "users", "user_id", ("user_id", "email", "name", "tier", "created_at", "updated_at")),
    ("snap_products", "products", "product_id", ("product_id", "name", "category", "price_cents", "created_at", "updated_at")),
)


def _step(results: list[dict], kind: str, name: str, run) -> None:
    try:
        run()
    except Exception:
        results.append({"resource_type": kind, "name": name, "status": "error"})
        raise
    results.append({"resource_type": kind, "name": name, "status": "success"})


def _models(spark: SparkSession, w: Warehouse, root: str, full_refresh: bool, results: list[dict]) -> dict[str, DataFrame]:
    """Write the models in dependency order; returns them, read back, by name."""
    built: dict[str, DataFrame] = {}

    def write(name: str, make) -> None:
        _step(results, "model", name, lambda: full_refresh_table(make(), f"{root}/{name}"))
        built[name] = read_table(spark, f"{root}/{name}")

    def incremental(name: str, make, key: str, ts: str | None = None, lookback: str | None = None) -> None:
        """``make`` builds the model from a cutoff (None: all of it)."""
        path, (col, expr) = f"{root}/{name}", fact_layout(name)

        def run():
            if full_refresh:
                full_refresh_table(make(None), path, col, expr, key, ts)
            elif ts is None:
                append_absent_table(spark, path, make(None), key, col, expr)
            else:
                upsert_table(spark, path, make, key, ts, lookback, col, expr)
        _step(results, "model", name, run)
        built[name] = read_table(spark, path).drop(col)

    incremental("fct_orders", lambda cutoff: core.fct_orders_since(w.stg, cutoff), "order_id", "order_updated_at", core.ORDER_LOOKBACK)
    incremental("fct_payments", lambda cutoff: w.fct_payments, "payment_id")
    write("dim_customers", lambda: w.dim_customers)
    write("dim_products", lambda: w.dim_products)
    write("dim_dates", lambda: w.dim_dates)
    write("metricflow_time_spine", lambda: core.metricflow_time_spine(built["dim_dates"]))
    write("fct_refunds", lambda: w.fct_refunds)
    write("rpt_daily_revenue", lambda: finance.rpt_daily_revenue(built["fct_orders"], built["fct_refunds"], built["dim_dates"]))
    incremental("fct_sessions", lambda cutoff: marketing.fct_sessions_since(w.stg, w.sessions_mapped, cutoff), "session_id", "session_start", marketing.SESSION_LOOKBACK)
    write("fct_attribution", lambda: marketing.fct_attribution(built["fct_orders"], built["fct_sessions"]))
    write("rpt_channel_performance", lambda: marketing.rpt_channel_performance(built["fct_sessions"], built["fct_attribution"]))
    return built


def _checks(w: Warehouse, built: dict[str, DataFrame], results: list[dict]) -> None:
    """Every declared check and both singular ones: written tables as written, staging models as planned, intermediate ones
    written for the checks."""
    root = shared_dir(w.spark, f"checked-{uuid.uuid4().hex[:10]}")
    w.land(root, {name: checked_columns(n) for n, name in (("int_orders_with_payments", "orders_with_payments"), (
        "int_sessions_mapped_to_users", "sessions_mapped"), ("int_product_inventory_current", "inventory_current"))})
    frames = {f"stg_{t}": w.stg[t] for t in w.raw} | {
        "int_orders_with_payments": w.orders_with_payments, "int_sessions_mapped_to_users": w.sessions_mapped,
        "int_product_inventory_current": w.inventory_current} | built
    for r in quality_report(frames, ALL_CHECKS).collect():  # one row per check: bounded by the check list, not the data
        results.append({"resource_type": "test", "name": f"{r.model}.{r.column_name}.{r.test}", "status": r.status})
    singular = {"no_orphaned_order_items": assert_no_orphaned_order_items(w.stg["order_items"], w.stg["orders"]),
                "revenue_reconciles": assert_revenue_reconciles(built["fct_orders"], built["fct_payments"])}
    for name, failing in singular.items():
        results.append({"resource_type": "test", "name": name, "status": "pass" if failing.isEmpty() else "fail"})
    delete_paths(w.spark, [root])
    w.forget()
