"""The whole flow on a small shop of invented rows: results worked out by hand."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

L1, L2 = "2024-01-04 06:00:00", "2024-01-07 06:00:00"

# table -> (first batch, second batch); the load time is added to each row
ROWS = {
    "users": ([(1, "ann@x", "Ann", "Gold", "2023-01-01 00:00:00", "2023-01-01 00:00:00", "false"),
               (2, "", "Bob", "Silver", "2023-01-01 00:00:00", "2023-01-01 00:00:00", "false"),
               (3, "cy@x", "Cy", "Bronze", "2023-01-01 00:00:00", "2023-01-01 00:00:00", "true")],
              [(2, "bob@x", "Bob", "Gold", "2023-01-01 00:00:00", "2024-01-05 00:00:00", "false"),
               (4, "di@x", "Di", "Bronze", "2024-01-05 00:00:00", "2024-01-05 00:00:00", "false")]),
    "products": ([(1, "Lamp", "Electronics", 1999, "2023-01-01 00:00:00", "2023-01-01 00:00:00", "false"),
                  (2, "Mug", "Lifestyle", 550, "2023-01-01 00:00:00", "2023-01-01 00:00:00", "false")], []),
    "inventory": ([(1, 1, "A", 30, "2023-12-01 00:00:00"), (2, 1, "A", 20, "2023-12-02 00:00:00"),
                   (3, 1, "B", 40, "2023-12-01 00:00:00"), (4, 2, "A", 0, "2023-12-01 00:00:00")], []),
    "addresses": ([(1, 1, "1 Main", "Rome", "RM", "00100", "it", "true"), (2, 1, "2 Side", "Oslo", "OS", "0150", "no", "false")], []),
    "orders": ([(10, 1, "2024-01-01 12:00:00", "Completed", 2549, 1, "2024-01-01 13:00:00"),
                (11, 1, "2024-01-03 09:00:00", "completed", 550, 1, "2024-01-03 10:00:00"),
                (12, 2, "2024-01-02 09:00:00", "Pending", 1999, 1, "2024-01-02 10:00:00")],
               [(12, 2, "2024-01-02 09:00:00", "Completed", 1999, 1, "2024-01-05 10:00:00"),
                (13, 4, "2024-01-06 09:00:00", "Completed", 1100, 1, "2024-01-06 10:00:00")]),
    "order_items": ([(1, 10, 1, 1, 1999), (2, 10, 2, 1, 550), (3, 11, 2, 1, 550), (4, 12, 1, 1, 1999)], [(5, 13, 2, 2, 550)]),
    "shopify_refunds": ([(1, 11, "damaged", 550, "2024-01-03 20:00:00")], []),
    "payments": ([(100, 10, 2549, "USD", "Succeeded", "PayPal", "2024-01-01 13:00:00"),
                  (101, 11, 549, "usd", "Succeeded", "credit_card", "2024-01-03 10:00:00"),
                  (102, 12, 1999, "EUR", "Pending", "credit_card", "2024-01-02 10:00:00")],
                 [(102, 12, 1999, "EUR", "Succeeded", "credit_card", "2024-01-02 10:00:00"),
                  (103, 13, 1100, "usd", "Succeeded", "credit_card", "2024-01-06 10:00:00")]),
    "charges": ([(1000, 100, 2549, "usd", "Succeeded", "2024-01-01 13:01:00"), (1010, 101, 549, "usd", "Succeeded", "2024-01-03 10:01:00")], []),
    "stripe_refunds": ([(7, 1010, 500, "damaged", "Succeeded", "2024-01-03 21:00:00")], []),
    "disputes": ([(1, 1000, 2549, "fraudulent", "Won", "2024-01-03 00:00:00")], []),
    "sessions": ([("S1", 1, "2024-01-01 08:00:00", "2024-01-01 08:10:00", "Desktop", "Email", "/a"),
                  ("S2", 1, "2024-01-02 09:00:00", "2024-01-02 09:30:00", "Mobile", "Social", "/b"),
                  ("S3", "", "2024-01-03 09:00:00", "2024-01-03 09:01:00", "Tablet", "Social", "/c")], []),
    "events": ([("E1", "S1", "Purchase", "2024-01-01 08:05:00", "/a"), ("E2", "S1", "Page_View", "2024-01-01 08:00:00", "/a"),
                ("E3", "S2", "Page_View", "2024-01-02 09:00:00", "/b")], []),
    "page_views": ([("P1", "S1", "/a", "2024-01-01 08:00:00", 300)], []),
}


@pytest.fixture(scope="module")
def seeds(tmp_path_factory):
    from emporium.sources.schemas import RAW_SCHEMAS, SOURCE_OF

    root = tmp_path_factory.mktemp("seeds")
    for table, batches in ROWS.items():
        folder = root / SOURCE_OF[table]
        folder.mkdir(exist_ok=True)
        for name, rows, load in zip(("initial", "incremental"), batches, (L1, L2)):
            lines = [",".join(RAW_SCHEMAS[table].names)] + [",".join(map(str, (*r, load))) for r in rows]
            (folder / f"{table}_{name}.csv").write_text("\n".join(lines) + "\n")
    return str(root)


def shop(spark, seeds, batches):
    from emporium.plans.warehouse import Warehouse
    from emporium.sources.seeds import load_seed_tables

    return Warehouse(spark, load_seed_tables(spark, seeds, batches))


def test_landing(spark, seeds):
    w = shop(spark, seeds, ("initial", "incremental"))
    assert {r.user_id: (r.email, r.tier) for r in w.raw["users"].collect()} == {
        1: ("ann@x", "Gold"), 2: ("bob@x", "Gold"), 3: ("cy@x", "Bronze"), 4: ("di@x", "Bronze")}
    assert w.raw["addresses"].where("address_id = 1").first().zip == "00100"
    assert shop(spark, seeds, ("initial",)).raw["users"].where("email is null").count() == 1


def test_models(spark, seeds):
    w = shop(spark, seeds, ("initial",))
    assert [(str(r.revenue_date), r.order_count, r.gross_revenue_dollars, r.total_refund_dollars, r.net_revenue_dollars)
            for r in w.daily_revenue.orderBy("revenue_date").collect()] == [
        ("2024-01-01", 1, D("25.49"), D("0.00"), D("25.49")), ("2024-01-02", 0, D("0.00"), D("0.00"), D("0.00")),
        ("2024-01-03", 1, D("5.50"), D("5.50"), D("0.00"))]
    assert {(r.order_id, r.attribution_session_id) for r in w.fct_attribution.collect()} == {(10, "S1"), (11, "S1")}
    assert {(r.channel, r.session_count, r.unique_user_count, r.converted_session_count, r.avg_session_duration_seconds,
             r.attributed_order_count, r.attributed_revenue_dollars) for r in w.channel_performance.collect()} == {
        ("email", 1, 1, 1, 600.0, 2, D("30.99")), ("social", 2, 1, 0, 930.0, 0, D("0.00"))}
    assert {(r.product_id, r.total_stock_quantity, r.warehouse_count, r.stock_status) for r in w.dim_products.collect()} == {
        (1, 60, 2, "in_stock"), (2, 0, 0 + 1, "out_of_stock")}
    assert {(r.user_id, r.lifetime_order_count, r.lifetime_spend_dollars, r.city) for r in w.dim_customers.collect()} == {
        (1, 2, D("30.99"), "Rome"), (2, 0, D("0.00"), None)}
    assert {(r.order_id, r.audit_status, r.difference_cents) for r in w.refund_audit.collect()} == {(11, "amount_mismatch", 50)}


def test_two_batches_through_the_build(spark, seeds, scratch):
    from emporium.operators.snapshot import read_snapshot
    from emporium.operators.table_state import read_table
    from emporium.plans.build import build

    root = f"{scratch}/wh"
    first = build(spark, shop(spark, seeds, ("initial",)), root, now=L1)
    assert first["tests"] == 203 + 2 and first["failed"] == ["revenue_reconciles"] and first["stale"] == []
    second = build(spark, shop(spark, seeds, ("initial", "incremental")), root, now=L2)
    orders = read_table(spark, f"{root}/fct_orders")
    done = orders.where("order_status = 'completed'")
    assert orders.count() == 4 and done.agg(F.sum("order_total_dollars")).first()[0] == D("61.98")
    # payments never change once they are there
    assert {r.payment_id: r.status for r in read_table(spark, f"{root}/fct_payments").collect()} == {
        100: "succeeded", 101: "succeeded", 102: "pending", 103: "succeeded"}
    assert read_table(spark, f"{root}/rpt_daily_revenue").count() == 6
    history = read_snapshot(spark, f"{root}/snap_customers").collect()
    assert sorted((r.user_id, r.tier, str(r.valid_to)) for r in history) == [
        (1, "Gold", "None"), (2, "Gold", "None"), (2, "Silver", "2024-01-05 00:00:00"), (3, "Bronze", "None"), (4, "Bronze", "None")]
    audit = read_table(spark, f"{root}/run_audit").collect()
    assert len(audit) == 2 and {(r.model_count, r.test_count, r.status) for r in audit} == {(11, 205, "error")}
    assert second["stale"] == sorted(second["stale"], key=second["stale"].index) and "products" in second["stale"]
