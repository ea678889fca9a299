import datetime as dt
from decimal import Decimal

import pytest

from emporium.operators.metrics import Level, query_metric_levels, query_metrics

T = dt.datetime


def test_ratio_metrics_and_grains(spark):
    orders = spark.createDataFrame(
        [(1, 10, T(2024, 1, 1, 9), "completed", "paypal", "succeeded", Decimal("10.00")),
         (2, 11, T(2024, 1, 1, 15), "completed", "paypal", "succeeded", Decimal("30.00")),
         (3, 10, T(2024, 1, 20), "pending", "gift_card", "pending", Decimal("5.00"))],
        "order_id long, customer_id long, order_date timestamp_ntz, order_status string, "
        "payment_method string, payment_status string, order_total_dollars decimal(12,2)")
    by_day = {r.metric_time: (r.revenue, r.orders, r.average_order_value) for r in
              query_metrics(orders, ["revenue", "orders", "average_order_value"], grain="day").collect()}
    assert by_day == {dt.date(2024, 1, 1): (Decimal("40.00"), 2, 20.0),
                      dt.date(2024, 1, 20): (Decimal("5.00"), 1, 5.0)}
    by_month = query_metrics(orders, ["orders"], by=["order_status"], grain="month").collect()
    assert {(r.metric_time, r.order_status, r.orders) for r in by_month} == {
        (dt.date(2024, 1, 1), "completed", 2), (dt.date(2024, 1, 1), "pending", 1)}


def test_conversion_rate_null_on_zero_denominator(spark):
    sessions = spark.createDataFrame([], "session_id string, channel string, device_type string, "
                                         "is_anonymous boolean, converted boolean, session_start timestamp_ntz")
    total = query_metrics(sessions, ["conversion_rate", "sessions"]).collect()
    assert len(total) == 1 and total[0].sessions == 0 and total[0].conversion_rate is None


ORDER_COLUMNS = ("order_id long, customer_id long, order_date timestamp_ntz, order_status string, "
                 "payment_method string, payment_status string, order_total_dollars decimal(12,2)")
LEVELS = [Level("day"), Level("week", ("payment_method",)), Level("month", ("order_status",)), Level()]
ORDER_METRICS = ["revenue", "orders", "average_order_value", "unique_customers"]


def _orders(spark):
    """Ties, a repeated row, null dimensions, a null customer, a null time, a null amount."""
    rows = [(i, i * 7 % 11, T(2024, 1 + i % 3, 1 + i * 5 % 28, i % 24), ["completed", "pending", None][i % 3],
             ["paypal", None][i % 2], "succeeded", Decimal(i) / 4) for i in range(60)]
    rows += [rows[5], (100, None, T(2024, 1, 1), "completed", "paypal", None, None), (101, 3, None, "completed", None, None, Decimal(1))]
    return spark.createDataFrame(rows, ORDER_COLUMNS), rows


def test_levels_equal_a_query_for_each(spark):
    orders, _ = _orders(spark)
    got = query_metric_levels(orders, ORDER_METRICS, LEVELS)
    assert got.columns == ["level", "metric_time", "order_status", "payment_method", *ORDER_METRICS]
    have = {}
    for r in got.collect():
        have.setdefault(r.level, []).append(r)
    assert set(have) == {"day", "week:payment_method", "month:order_status", "all"}
    for level in LEVELS:
        want = query_metrics(orders, ORDER_METRICS, list(level.by), level.grain)
        assert sorted(map(repr, ([r[c] for c in want.columns] for r in have[level.label]))) == sorted(
            map(repr, (list(r) for r in want.collect())))
        assert want.schema["revenue"].dataType == got.schema["revenue"].dataType


def test_levels_by_hand(spark):
    orders, rows = _orders(spark)
    by_method = {r.payment_method: r for r in query_metric_levels(orders, ORDER_METRICS, [Level(None, ("payment_method",))]).collect()}
    for method in ("paypal", None):
        own = [r for r in rows if r[4] == method]
        r = by_method[method]
        assert (r.orders, r.revenue, r.unique_customers) == (
            len(own), sum(x[6] for x in own if x[6] is not None), len({x[1] for x in own} - {None}))


def test_levels_approximate(spark):
    many = spark.range(0, 60000, 1, 6).selectExpr(
        "id AS order_id", "id % 20000 AS customer_id", "timestampadd(HOUR, int(id % 2000), TIMESTAMP_NTZ'2024-01-01') AS order_date",
        "concat('s', id % 3) AS order_status", "'paypal' AS payment_method", "'x' AS payment_status", "CAST(1 AS decimal(12,2)) AS order_total_dollars")
    levels = [Level("month"), Level(None, ("order_status",)), Level()]
    exact, near = ({(r.level, r.metric_time, r.order_status): (r.orders, r.unique_customers) for r in
                    query_metric_levels(many, ["orders", "unique_customers"], levels, approximate=a).collect()} for a in (False, True))
    assert exact.keys() == near.keys() and exact[("all", None, None)] == (60000, 20000)
    for k, (orders, customers) in exact.items():
        assert near[k][0] == orders and abs(near[k][1] - customers) <= 0.082 * customers


def test_levels_empty_and_refused(spark):
    none = spark.createDataFrame([], ORDER_COLUMNS)
    for approximate in (False, True):
        assert query_metric_levels(none, ORDER_METRICS, LEVELS, approximate).collect() == []
    for levels in ([], [Level("day"), Level("day")], [Level("hour")], [Level("day", ("channel",))]):
        with pytest.raises(ValueError):
            query_metric_levels(none, ORDER_METRICS, levels)


def test_levels_read_the_fact_once(spark, tmp_path):
    _orders(spark)[0].write.parquet(str(tmp_path / "orders"))
    plan = query_metric_levels(spark.read.parquet(str(tmp_path / "orders")), ["revenue", "orders"], LEVELS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 2 and "Expand" not in text
