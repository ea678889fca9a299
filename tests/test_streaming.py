import datetime as dt

from pyspark.sql import functions as F

from emporium.streaming import jobs

T = dt.datetime
PAY = "payment_id long, order_id long, amount_cents long, status string, created_at timestamp_ntz"
ORD = "order_id long, order_date timestamp_ntz, order_updated_at timestamp_ntz, status string"


def test_payments_append_sink_two_batches(spark, scratch):
    src, table, ckpt = f"{scratch}/in", f"{scratch}/fct_payments", f"{scratch}/ck"
    spark.createDataFrame([(1, 10, 500, "pending", T(2024, 1, 1))], PAY).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema(PAY).parquet(f"{src}/*")
    jobs.run_foreach_batch(stream, jobs.payments_append_sink(spark, table), ckpt)
    spark.createDataFrame([(1, 10, 500, "succeeded", T(2024, 1, 1)), (2, 11, 700, "pending", T(2024, 1, 2))],
                          PAY).write.parquet(f"{src}/b2")
    stream = spark.readStream.schema(PAY).parquet(f"{src}/*")
    jobs.run_foreach_batch(stream, jobs.payments_append_sink(spark, table), ckpt)
    got = sorted((r.payment_id, r.status) for r in spark.read.parquet(table).collect())
    assert got == [(1, "pending"), (2, "pending")]  # existing payment never changes


def test_orders_upsert_sink_two_batches(spark, scratch):
    src, table, ckpt = f"{scratch}/in", f"{scratch}/fct_orders", f"{scratch}/ck"
    spark.createDataFrame([(1, T(2024, 1, 1), T(2024, 1, 1), "pending"),
                           (2, T(2024, 1, 5), T(2024, 1, 5), "pending")], ORD).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema(ORD).parquet(f"{src}/*")
    jobs.run_foreach_batch(stream, jobs.orders_upsert_sink(spark, table, lambda b: b), ckpt)
    spark.createDataFrame([(2, T(2024, 1, 5), T(2024, 1, 6), "completed"),   # inside the 72 h lookback
                           (1, T(2024, 1, 1), T(2024, 1, 1, 1), "completed"),  # too old: ignored
                           (3, T(2024, 1, 7), T(2024, 1, 7), "pending")], ORD).write.parquet(f"{src}/b2")
    stream = spark.readStream.schema(ORD).parquet(f"{src}/*")
    jobs.run_foreach_batch(stream, jobs.orders_upsert_sink(spark, table, lambda b: b), ckpt)
    got = sorted((r.order_id, r.status) for r in spark.read.parquet(table).collect())
    assert got == [(1, "pending"), (2, "completed"), (3, "pending")]


def test_session_stream_drops_nothing_closed(spark, scratch):
    """Bounded run: every emitted session equals the batch gap-sessionization."""
    rows = [(i, T(2024, 1, 1) + dt.timedelta(minutes=m), 7, "view", 1.0, "{}")
            for i, m in enumerate([0, 10, 50, 55, 200, 3000])]
    folder = f"{scratch}/ev"
    spark.createDataFrame(rows, jobs.DRIVER_EVENTS_SCHEMA).write.parquet(folder)
    from emporium.sources.testdata import TestdataSource

    raw = spark.readStream.schema(jobs.DRIVER_EVENTS_SCHEMA).parquet(folder)
    out = f"{scratch}/out"
    jobs.run_to_parquet(jobs.sessionized_events(TestdataSource(spark, folder).visitor_events(raw)),
                        out, f"{scratch}/ck")
    got = sorted((r.session_start, r.event_count) for r in spark.read.parquet(out).collect())
    # watermark = last event - 24 h: the session at minute 3000 is still open
    assert got == [(T(2024, 1, 1, 0, 0), 2), (T(2024, 1, 1, 0, 50), 2), (T(2024, 1, 1, 3, 20), 1)]


def test_session_stream_drops_rows_behind_the_watermark(spark, scratch):
    """A second micro-batch brings an event older than the 24 h watermark of
    the first: it is dropped, as the lateness bound says."""
    from emporium.sources.testdata import TestdataSource

    folder, out, ck = f"{scratch}/ev", f"{scratch}/out", f"{scratch}/ck"
    day = [(1, T(2024, 1, 1, 10), 5, "view", 1.0, "{}"), (2, T(2024, 1, 3, 10), 5, "purchase", 1.0, "{}")]
    spark.createDataFrame(day, jobs.DRIVER_EVENTS_SCHEMA).write.parquet(f"{folder}/a")
    src = TestdataSource(spark, folder)

    def run():
        raw = spark.readStream.schema(jobs.DRIVER_EVENTS_SCHEMA).parquet(f"{folder}/*")
        jobs.run_to_parquet(jobs.sessionized_events(src.visitor_events(raw)), out, ck)

    run()
    late = [(3, T(2024, 1, 1, 10, 5), 5, "purchase", 1.0, "{}"),   # far behind the watermark
            (4, T(2024, 1, 9, 10), 5, "view", 1.0, "{}")]          # moves the watermark on
    spark.createDataFrame(late, jobs.DRIVER_EVENTS_SCHEMA).write.parquet(f"{folder}/b")
    run()
    got = sorted((r.session_start, r.event_count, r.converted) for r in spark.read.parquet(out).collect())
    assert got == [(T(2024, 1, 1, 10), 1, False), (T(2024, 1, 3, 10), 1, True)]
