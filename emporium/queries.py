"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the raw shop tables the adapter derives from the driver's tables.

Most are lazy plans. Those that go through table writers, streams, bucketed
scans or an incremental cutoff run jobs when they are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators.fs import delete_paths
from emporium.operators.incremental import append_absent_frame, lookback_cutoff, upsert_frame
from emporium.operators.snapshot import snapshot_frame
from emporium.operators.table_state import read_table
from emporium.plans import core
from emporium.plans.core import ORDER_LOOKBACK, fct_orders_since
from emporium.plans.marketing import SESSION_LOOKBACK, fct_sessions_changed, fct_sessions_since
from emporium.plans.warehouse import Warehouse
from emporium.sources.seeds import land
from emporium.sources.testdata import LOAD_1, LOAD_2
from emporium.session import ensure_checkpoint_dir
from emporium.sources.testdata import TestdataSource


def source(spark: SparkSession, sf_dir: str) -> TestdataSource:
    ensure_checkpoint_dir(spark)
    return TestdataSource(spark, sf_dir)


def warehouse(spark: SparkSession, sf_dir: str, state: str = "current", calendar: tuple[str, str] | None = None) -> Warehouse:
    """Models over one state of the folder, planned anew on each call: files that changed are seen."""
    return Warehouse(spark, source(spark, sf_dir).tables_cache(state), calendar)


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(warehouse(spark, sf_dir), name)
    run.__name__ = name
    return run


def _staging(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse(spark, sf_dir).stg[table]
    run.__name__ = f"stg_{table}"
    return run


daily_revenue = _model("daily_revenue")


def daily_revenue_fixed_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 on the declared three-year calendar only; ``orders_outside_calendar`` has what it leaves out."""
    return warehouse(spark, sf_dir, calendar=(core.DATE_SPINE_START, core.DATE_SPINE_END)).daily_revenue


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# S1-S14
for _t in ("users", "products", "inventory", "addresses", "orders", "order_items",
           "shopify_refunds", "payments", "charges", "stripe_refunds", "disputes", "sessions",
           "events", "page_views"):
    QUERIES[f"stg_{_t}"] = _staging(_t)

# I1-I3, M1-M11, X1, X2
QUERIES.update({
    "int_orders_with_payments": _model("orders_with_payments"),
    "inventory_current": _model("inventory_current"),
    "sessions_mapped": _model("sessions_mapped"),
    "dim_customers": _model("dim_customers"),
    "dim_products": _model("dim_products"),
    "dim_dates": _model("dim_dates"),
    "time_spine": _model("time_spine"),
    "fct_orders": _model("fct_orders"),
    "fct_payments": _model("fct_payments"),
    "fct_refunds": _model("fct_refunds"),
    "daily_revenue": daily_revenue,
    "daily_revenue_fixed_calendar": daily_revenue_fixed_calendar,
    "orders_outside_calendar": _model("outside_calendar"),
    "refund_audit": _model("refund_audit"),
    "fct_sessions": _model("fct_sessions"),
    "attribution_last_touch": _model("fct_attribution"),
    "channel_performance": _model("channel_performance"),
    "customer_features": _model("customer_features"),
})


# ---------------------------------------------------------------- O6-O9
def _orders_batch(spark: SparkSession, sf_dir: str, target: DataFrame) -> DataFrame:
    """Order-fact rows within the lookback of the newest order of ``target``.

    The cutoff is resolved first (one scalar) and becomes a literal filter on
    the orders scan; the batch is checkpointed, as it is both inserted and
    matched against the target.
    """
    cutoff = lookback_cutoff(target, "order_updated_at", ORDER_LOOKBACK).select(F.col("__cutoff").cast("string")).first()[0]
    if cutoff is None:
        return target.limit(0)
    return fct_orders_since(warehouse(spark, sf_dir).stg, cutoff).checkpoint()


def fct_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 after two runs: full build on batch 1, then delete+insert of the
    current state with the 72 h lookback on order_updated_at."""
    first = warehouse(spark, sf_dir, "b1")
    return upsert_frame(first.fct_orders, _orders_batch(spark, sf_dir, first.stg["orders"]), "order_id")


def fct_payments_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 after two runs: payments already present never change (trap T2)."""
    target = warehouse(spark, sf_dir, "b1").fct_payments
    source = warehouse(spark, sf_dir).fct_payments
    return target.unionByName(append_absent_frame(target, source, "payment_id"))


def fct_sessions_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 after two runs with the 24 h lookback on session_start (trap T13).

    The cutoff is resolved first and becomes a literal on the sessions; the
    batch is checkpointed, as it is both inserted and matched.
    """
    target, later = warehouse(spark, sf_dir, "b1").fct_sessions, warehouse(spark, sf_dir)
    starts = warehouse(spark, sf_dir, "b1").stg["sessions"]
    cutoff = lookback_cutoff(starts, "session_start", SESSION_LOOKBACK).select(F.col("__cutoff").cast("string")).first()[0]
    if cutoff is None:
        return target
    batch = fct_sessions_since(later.stg, later.sessions_mapped, cutoff).checkpoint()
    return upsert_frame(target, batch, "session_id")


def _snapshot(table: str, key: str, cols: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = source(spark, sf_dir)
        b1 = src.tables_cache("b1")[table].select(*cols)
        b2 = src.tables_cache("b2")[table].select(*cols)
        first = snapshot_frame(None, b1, key, "updated_at", LOAD_1)
        return snapshot_frame(first, b2, key, "updated_at", LOAD_2)
    run.__name__ = f"snapshot_{table}"
    return run


def raw_orders_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing upsert of the two order extracts equals the current state."""
    src = source(spark, sf_dir)
    return land([src.tables_cache("b1")["orders"], src.tables_cache("b2")["orders"]], "order_id")


def seed_orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5: both order extracts written as header CSV, read back with the declared schema and landed."""
    from emporium.sources.seeds import read_seed
    import uuid

    from emporium.session import shared_dir

    root, src = shared_dir(spark, f"seeds-{uuid.uuid4().hex[:10]}"), source(spark, sf_dir)
    for batch, state in (("initial", "b1"), ("incremental", "b2")):
        (src.tables_cache(state)["orders"].write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
         .csv(f"{root}/shopify/orders_{batch}.csv"))
    return land([read_seed(spark, root, "orders", b) for b in ("initial", "incremental")], "order_id")


QUERIES.update({
    "seed_orders_csv": seed_orders_csv,
    "fct_orders_incremental": fct_orders_incremental,
    "fct_payments_incremental": fct_payments_incremental,
    "fct_sessions_incremental": fct_sessions_incremental,
    "snapshot_customers": _snapshot("users", "user_id",
                                    ["user_id", "email", "name", "tier", "created_at", "updated_at"]),
    "snapshot_products": _snapshot("products", "product_id",
                                   ["product_id", "name", "category", "price_cents", "created_at",
                                    "updated_at"]),
    "raw_orders_landing": raw_orders_landing,
})


# ------------------------------------------------------- quality, freshness
#: Warehouse names of the models, and their names here.
MODEL_NAMES = {
    "int_orders_with_payments": "orders_with_payments",
    "int_product_inventory_current": "inventory_current",
    "int_sessions_mapped_to_users": "sessions_mapped",
    "dim_customers": "dim_customers", "dim_products": "dim_products", "dim_dates": "dim_dates",
    "fct_orders": "fct_orders", "fct_payments": "fct_payments", "fct_refunds": "fct_refunds",
    "rpt_daily_revenue": "daily_revenue", "fct_sessions": "fct_sessions",
    "fct_attribution": "fct_attribution", "rpt_channel_performance": "channel_performance",
}


def model_frames(w: Warehouse) -> dict[str, DataFrame]:
    """Models by their warehouse names (the names the checks refer to)."""
    from emporium.sources.testdata import LazyTables

    names = list(MODEL_NAMES) + [f"stg_{t}" for t in w.raw]
    return LazyTables(names, lambda n: getattr(w, MODEL_NAMES[n]) if n in MODEL_NAMES else w.stg[n[4:]])


def landed_models(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """All models by their warehouse names, those that take more than a projection written once under ``root``: all
    rows, with the columns that are checked or read on."""
    from emporium.plans.checks import checked_columns

    src = source(spark, sf_dir)
    src.land(f"{root}/raw")
    w = Warehouse(spark, src.tables_cache("current"))
    w.land(f"{root}/models", {name: checked_columns(n) | (checked_columns("fct_orders") if name == "orders_with_payments" else set())
                              for n, name in MODEL_NAMES.items()})
    return model_frames(w)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q7 over landed models: each is computed once, however many models and checks read it."""
    from emporium.operators.quality import quality_report as report
    from emporium.plans.checks import ALL_CHECKS

    return report(landed_models(spark, sf_dir, _table(spark, "checked")), ALL_CHECKS)


def assert_no_orphaned_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from emporium.plans import checks

    w = warehouse(spark, sf_dir)
    return checks.assert_no_orphaned_order_items(w.stg["order_items"], w.stg["orders"])


def assert_revenue_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from emporium.plans import checks

    w = warehouse(spark, sf_dir)
    return checks.assert_revenue_reconciles(w.fct_orders, w.fct_payments)


def snapshot_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10 on the customer history with planted defects: some open rows doubled, some closed ones turned around."""
    from emporium.operators.quality import snapshot_invariants as inv

    history = QUERIES["snapshot_customers"](spark, sf_dir).select("user_id", "valid_from", "valid_to")
    doubled = history.where(F.col("valid_to").isNull() & (F.col("user_id") % 37 == 5))
    turned = history.where(F.col("valid_to").isNotNull() & (F.col("user_id") % 41 == 3)).select(
        "user_id", F.col("valid_to").alias("valid_from"), F.col("valid_from").alias("valid_to"))
    return inv(history.unionByName(doubled).unionByName(turned), "user_id")


def spine_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 on the daily revenue report's days (the spine as the report sees it)."""
    from emporium.operators.quality import spine_gaps as gaps

    return gaps(warehouse(spark, sf_dir).daily_revenue, "revenue_date")


# Fixed evaluation times of the freshness queries (reproducible ages): one lies
# exactly on the limits, one off them.
FRESHNESS_NOW, FRESHNESS_LATER = "2024-06-16 12:00:00", "2024-06-16 15:20:00"


def _freshness(now: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from emporium.operators.freshness import source_freshness as fresh

        return fresh(source(spark, sf_dir).load_times("current"), now)
    return run


source_freshness = _freshness(FRESHNESS_NOW)


def source_freshness_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over landed tables: every raw table is written with its load time as a number, and judged by the files' footers."""
    from emporium.operators.freshness import landed_freshness, with_loaded_micros
    from emporium.operators.incremental import full_refresh_table
    from emporium.operators.table_state import load, location

    root, raw = _table(spark, "raw"), source(spark, sf_dir).tables_cache("current")
    for name in raw:
        full_refresh_table(with_loaded_micros(raw[name]), f"{root}/{name}")
    return landed_freshness(spark, {name: location(f"{root}/{name}", load(spark, f"{root}/{name}")) for name in raw}, FRESHNESS_NOW)


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 fed with real results: the models checked, every check's outcome, and what follows for the run's status.

    Ids and times differ from run to run, so the query shows the other columns.
    """
    from emporium.operators import audit
    from emporium.operators.quality import quality_report as report
    from emporium.plans.checks import ALL_CHECKS
    import datetime as dt

    root = _table(spark, "checked")
    frames = landed_models(spark, sf_dir, root)
    results = [{"resource_type": "model", "status": "success"} for n in frames if not n.startswith("stg_")]
    results += [{"resource_type": "test", "status": r.status} for r in report(frames, ALL_CHECKS).collect()]  # a row a check
    delete_paths(spark, [root])
    row = audit.audit_row(spark, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), "dev", results)
    return row.select("target_name", "model_count", "test_count", "status")


def union_sources_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 by discovery: both extracts are landed as tables of two schemas, found by pattern and stacked."""
    from emporium.operators.union import union_sources
    import uuid

    from emporium.session import shared_dir

    root, src = shared_dir(spark, f"landing-{uuid.uuid4().hex[:10]}"), source(spark, sf_dir)
    for schema, state in (("shopify_initial", "b1"), ("shopify_incremental", "b2"), ("stripe_initial", "b1")):
        src.tables_cache(state)["orders"].write.parquet(f"{root}/{schema}/orders")
    return union_sources(spark, root, "shopify_*", "orders")


def union_order_extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 over the two order extracts, tagged by their landing schema (Q14:
    the row count is the sum of the inputs)."""
    from emporium.operators.union import union_relations

    src = source(spark, sf_dir)
    return union_relations({"shopify_initial": src.tables_cache("b1")["orders"],
                            "shopify_incremental": src.tables_cache("b2")["orders"]})


def _metric_query(metrics: list[str], by: list[str], grain: str | None, model: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from emporium.operators.metrics import query_metrics

        w = warehouse(spark, sf_dir)
        return query_metrics(getattr(w, model), metrics, by, grain)
    return run


def _order_levels():
    from emporium.operators.metrics import Level

    return [Level("day"), Level("week", ("payment_method",)), Level("month", ("order_status",)),
            Level("year", ("order_status", "payment_method")), Level()]


def metric_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order metrics at five levels of detail from one pass over the order fact."""
    from emporium.operators.metrics import query_metric_levels

    return query_metric_levels(warehouse(spark, sf_dir).fct_orders,
                               ["revenue", "orders", "average_order_value", "unique_customers"], _order_levels())


def metric_customers_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers by level, exactly, and whether the merged sketches are within five standard errors of that."""
    from emporium.operators.metrics import SKETCH_BITS, query_metric_levels

    orders = warehouse(spark, sf_dir).fct_orders
    names = ["level", "metric_time", "order_status", "payment_method"]
    both = [query_metric_levels(orders, ["unique_customers"], _order_levels(), approximate=a).withColumnRenamed("unique_customers", n)
            for a, n in ((False, "exact"), (True, "estimate"))]
    one = both[0].select(*names, "exact", F.lit(None).cast("long").alias("estimate")).unionByName(
        both[1].select(*names, F.lit(None).cast("long").alias("exact"), "estimate"))
    g = one.groupBy(*names).agg(F.max("exact").alias("unique_customers"), F.max("estimate").alias("estimate"))
    bound = F.greatest(F.lit(1.0), F.col("unique_customers") * F.lit(5 * 1.04 / 2 ** (SKETCH_BITS / 2)))
    return g.select(*names, "unique_customers",
                    (F.abs(F.col("estimate") - F.col("unique_customers")) <= bound).alias("estimate_within_bound"))


QUERIES.update({
    "quality_report": quality_report,
    "assert_no_orphaned_order_items": assert_no_orphaned_order_items,
    "assert_revenue_reconciles": assert_revenue_reconciles,
    "snapshot_invariants": snapshot_invariants,
    "spine_gaps": spine_gaps,
    "source_freshness": source_freshness,
    "source_freshness_later": _freshness(FRESHNESS_LATER),
    "source_freshness_landed": source_freshness_landed,
    "run_audit": run_audit,
    "union_sources_discovered": union_sources_discovered,
    "union_sources": union_order_extracts,
    "metric_revenue_by_day": _metric_query(["revenue", "orders"], [], "day", "fct_orders"),
    "metric_aov": _metric_query(["average_order_value", "revenue", "orders"],
                                ["order_status", "payment_method"], "month", "fct_orders"),
    "metric_conversion_rate": _metric_query(["conversion_rate", "sessions", "converted_sessions"],
                                            ["channel", "device_type"], "day", "fct_sessions"),
    "metric_sessions_by_anonymity": _metric_query(["sessions", "converted_sessions"],
                                                  ["is_anonymous"], None, "fct_sessions"),
    "metric_levels": metric_levels,
    "metric_customers_approximate": metric_customers_approximate,
})


# ---------------------------------------------------------------- streams
def _stream_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    import uuid

    from emporium.session import shared_dir

    run = uuid.uuid4().hex[:10]
    base = shared_dir(spark, f"streams/{name}-{run}")
    return f"{base}/out", f"{base}/_checkpoint"


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 over the driver's events file as a bounded stream (availableNow).
    Sessions still open when the file ends (within the watermark) are not emitted."""
    from emporium.streaming import jobs

    raw = jobs.file_stream(spark, sf_dir, jobs.DRIVER_EVENTS_SCHEMA, glob="events.parquet")
    out, ckpt = _stream_dirs(spark, "sessions")
    jobs.run_to_parquet(jobs.sessionized_events(source(spark, sf_dir).visitor_events(raw)), out, ckpt)
    return spark.read.parquet(out)


def stream_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4 over the driver's orders file as a bounded stream (availableNow).
    Days still open when the file ends (within the watermark) are not emitted."""
    from emporium.streaming import jobs

    raw = jobs.file_stream(spark, sf_dir, jobs.DRIVER_ORDERS_SCHEMA, glob="orders.parquet")
    out, ckpt = _stream_dirs(spark, "daily_revenue")
    jobs.run_to_parquet(jobs.daily_revenue_stream(source(spark, sf_dir).orders_from(raw)), out, ckpt)
    return spark.read.parquet(out)


QUERIES.update({"stream_sessions": stream_sessions, "stream_daily_revenue": stream_daily_revenue})


def stream_payments_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: the two payment extracts arrive as two streaming runs over the
    driver's orders file; each micro-batch is appended where the payment id
    is absent. Equals the append-if-absent fact (existing rows never change)."""
    from emporium.plans import core, staging
    from emporium.streaming import jobs

    src = source(spark, sf_dir)
    out, ckpt = _stream_dirs(spark, "payments")
    for state in ("b1", "b2"):
        raw = jobs.file_stream(spark, sf_dir, jobs.DRIVER_ORDERS_SCHEMA, glob="orders.parquet")
        pays = core.fct_payments_full(staging.stg_payments(src.payments_from(raw, state)))
        jobs.run_foreach_batch(pays, jobs.payments_append_sink(spark, out), f"{ckpt}-{state}")
    return read_table(spark, out).drop("created_month")


def stream_orders_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2: the two order extracts arrive as two streaming runs; each
    micro-batch becomes order-fact rows (joined with the item summary and
    payments known at that time) merged by delete+insert with the 72 h
    lookback into a partitioned table."""
    from emporium.plans import core, intermediate, staging
    from emporium.streaming import jobs

    src = source(spark, sf_dir)
    out, ckpt = _stream_dirs(spark, "orders")
    for state, known in (("b1", "b1"), ("b2", "current")):
        stg = warehouse(spark, sf_dir, known).stg
        items, pays = stg["order_items"], stg["payments"]

        def to_fact(batch: DataFrame, items=items, pays=pays) -> DataFrame:
            return core.fct_orders_full(intermediate.int_orders_with_payments(
                staging.stg_orders(batch), items, pays))

        raw = jobs.file_stream(spark, sf_dir, jobs.DRIVER_ORDERS_SCHEMA, glob="orders.parquet")
        jobs.run_foreach_batch(src.orders_from(raw, state), jobs.orders_upsert_sink(spark, out, to_fact),
                               f"{ckpt}-{state}")
    return read_table(spark, out).drop("order_month")


def fct_orders_incremental_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13: running the incremental order fact twice on the same source
    changes nothing (no duplicates, same rows)."""
    once = fct_orders_incremental(spark, sf_dir)
    return upsert_frame(once, _orders_batch(spark, sf_dir, once), "order_id")


def fct_orders_schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6 and O7 through the table writer: a first build, a run whose source
    has one column more, and the same run again."""
    from emporium.operators.incremental import upsert_table
    from emporium.plans.build import fact_layout
    import uuid

    from emporium.session import shared_dir

    path, (col, expr) = shared_dir(spark, f"tables/fct_orders-{uuid.uuid4().hex[:10]}"), fact_layout("fct_orders")
    first, later = warehouse(spark, sf_dir, "b1"), warehouse(spark, sf_dir)
    size = F.when(F.col("total_quantity") >= 100, "large").otherwise("small")
    upsert_table(spark, path, first.fct_orders, "order_id", "order_updated_at", ORDER_LOOKBACK, col, expr)
    for _ in range(2):
        upsert_table(spark, path, lambda cutoff: fct_orders_since(later.stg, cutoff).withColumn("order_size", size),
                     "order_id", "order_updated_at", ORDER_LOOKBACK, col, expr)
    return read_table(spark, path).drop(col)


def _table(spark: SparkSession, name: str) -> str:
    """Path of a table of its own for one run of a query."""
    import uuid

    from emporium.session import shared_dir

    return shared_dir(spark, f"tables/{name}-{uuid.uuid4().hex[:10]}")


def fct_orders_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 and O4 through the table writer: a first build of batch 1, then the weekly full refresh in its place."""
    from emporium.operators.incremental import full_refresh_table, upsert_table
    from emporium.plans.build import fact_layout

    path, (col, expr) = _table(spark, "fct_orders"), fact_layout("fct_orders")
    upsert_table(spark, path, warehouse(spark, sf_dir, "b1").fct_orders, "order_id", "order_updated_at", ORDER_LOOKBACK, col, expr)
    full_refresh_table(warehouse(spark, sf_dir).fct_orders, path, col, expr, "order_id", "order_updated_at")
    return read_table(spark, path).drop(col)


def fct_orders_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 over orders, items and payments landed in buckets of the order id: joined and summed without a shuffle."""
    from emporium.plans.build import land_order_tables

    w = warehouse(spark, sf_dir)
    land_order_tables(w, _table(spark, "landed"), 16)
    return w.fct_orders


def fct_sessions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 through the table writer: a first build, a run with the 24 h lookback, and the same run again."""
    from emporium.operators.incremental import upsert_table
    from emporium.plans.build import fact_layout

    path, (col, expr) = _table(spark, "fct_sessions"), fact_layout("fct_sessions")
    for state in ("b1", "current", "current"):
        w = warehouse(spark, sf_dir, state)
        upsert_table(spark, path, lambda cutoff, w=w: fct_sessions_since(w.stg, w.sessions_mapped, cutoff),
                     "session_id", "session_start", SESSION_LOOKBACK, col, expr)
    return read_table(spark, path).drop(col)


def fct_sessions_captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 by change capture: a first build, then only sessions that newly loaded events or sessions name, then nothing new."""
    from emporium.operators.incremental import capture_table
    from emporium.plans.build import fact_layout

    path, (col, expr) = _table(spark, "fct_sessions"), fact_layout("fct_sessions")
    for state, loaded in (("b1", LOAD_1), ("current", LOAD_2), ("current", LOAD_2)):
        w = warehouse(spark, sf_dir, state)
        capture_table(spark, path, lambda watermark, w=w: fct_sessions_changed(w.raw, w.stg, w.sessions_mapped, watermark),
                      loaded, "session_id", "session_start", col, expr)
    return read_table(spark, path).drop(col)


def _snapshot_table(table: str, key: str, cols: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A history through the table writer, the second run twice under one run id."""
        from emporium.operators.snapshot import read_snapshot, snapshot_table

        path, src = _table(spark, f"snap_{table}"), source(spark, sf_dir)
        for state, at, run_id in (("b1", LOAD_1, "one"), ("b2", LOAD_2, "two"), ("b2", LOAD_2, "two")):
            snapshot_table(spark, path, src.tables_cache(state)[table].select(*cols), key, "updated_at", at, run_id)
        return read_snapshot(spark, path)
    run.__name__ = f"snapshot_{table}_table"
    return run


QUERIES.update({"stream_payments_append": stream_payments_append,
                "stream_orders_upsert": stream_orders_upsert,
                "fct_orders_incremental_rerun": fct_orders_incremental_rerun,
                "fct_orders_schema_sync": fct_orders_schema_sync,
                "fct_orders_full_refresh": fct_orders_full_refresh,
                "fct_orders_bucketed": fct_orders_bucketed,
                "fct_sessions_table": fct_sessions_table,
                "fct_sessions_captured": fct_sessions_captured,
                "snapshot_customers_table": _snapshot_table("users", "user_id", ["user_id", "email", "name", "tier", "created_at", "updated_at"]),
                "snapshot_products_table": _snapshot_table("products", "product_id",
                                                           ["product_id", "name", "category", "price_cents", "created_at", "updated_at"])})


def attribution_asof_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 with fixed 7-day time buckets instead of range buckets: the same
    union-and-scan as-of, cheaper when timelines are spread out; must equal
    ``attribution_last_touch``."""
    from emporium.plans.marketing import fct_attribution

    w = warehouse(spark, sf_dir)
    return fct_attribution(w.fct_orders, w.fct_sessions, bucket="7 days", strategy="time")


QUERIES["attribution_asof_union"] = attribution_asof_union
