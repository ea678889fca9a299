"""Structured Streaming versions of the late-data requirements.

* ST1 ``sessionized_events``: de-duplicate events by id within the watermark,
  group each visitor's events into 30-minute-gap sessions, conditional
  counts as in the session fact; append mode emits a session once the
  24 h watermark has passed its end.
* ST2 ``orders_upsert_sink``: every micro-batch of orders is merged into the
  order fact with delete+insert and the 72 h lookback.
* ST3 ``payments_append_sink``: every micro-batch of payments is appended
  where the payment id is absent - replays add nothing.
* ST4 ``daily_revenue_stream``: completed orders per tumbling day with a 72 h
  watermark; a day is emitted once the watermark passes its end.

Event time must be a zoned ``timestamp`` for watermarks, so the wall-clock
``timestamp_ntz`` columns are mapped to the instant with the same UTC reading
on the way in and back on the way out - independent of the session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.functions.macros import cents_to_dollars, instant_wall_clock, wall_clock_instant
from emporium.operators.incremental import already_written, append_absent_table, upsert_table
from emporium.operators.table_state import table_exists
from emporium.sources.testdata import DRIVER_SCHEMAS

# Fixed values of the streaming jobs.
SESSION_GAP = "30 minutes"
EVENT_WATERMARK = "24 hours"
ORDER_WATERMARK = "72 hours"
ORDER_LOOKBACK = "72 HOURS"

DRIVER_EVENTS_SCHEMA = DRIVER_SCHEMAS["events"]   # DDL strings
DRIVER_ORDERS_SCHEMA = DRIVER_SCHEMAS["orders"]


def file_stream(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(folder)


def sessionized_events(visitor_events: DataFrame, gap: str = SESSION_GAP,
                       watermark: str = EVENT_WATERMARK) -> DataFrame:  # ST1
    """A visitor's sessions are merged inside each input partition before the
    shuffle, so a hot visitor sends few rows. Sessions still open when the
    watermark stops (the end of a bounded run) are not emitted."""
    visitor_events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    e = (visitor_events.withColumn("event_time", wall_clock_instant("ts"))
         .withWatermark("event_time", watermark)
         .dropDuplicatesWithinWatermark(["event_id"]))
    et = F.lower(F.col("mapped_type"))
    agg = e.groupBy(F.session_window("event_time", gap).alias("w"), "visitor_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count(F.when(et == "page_view", F.lit(1))).alias("page_view_count"),
        F.count(F.when(et == "purchase", F.lit(1))).alias("purchase_count"))
    return agg.select(
        "visitor_id", instant_wall_clock("w.start").alias("session_start"),
        instant_wall_clock("w.end").alias("session_end"), "event_count",
        "page_view_count", "purchase_count", (F.col("purchase_count") > 0).alias("converted"))


def daily_revenue_stream(shop_orders: DataFrame, watermark: str = ORDER_WATERMARK) -> DataFrame:  # ST4
    o = (shop_orders.where(F.lower("status") == "completed")
         .withColumn("order_time", wall_clock_instant("order_date"))
         .withWatermark("order_time", watermark))
    agg = o.groupBy(F.window("order_time", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(cents_to_dollars("total_amount_cents")).cast("decimal(18,2)").alias("gross_revenue_dollars"))
    return agg.select(instant_wall_clock("w.start").cast("date").alias("revenue_date"),
                      "order_count", "gross_revenue_dollars")


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available now into a Parquet folder and stop."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _stamp(batch: DataFrame, batch_id: int, stream: str | None) -> tuple[str, int] | None:
    """Name of the stream (its query id, which a restart from the same checkpoint keeps) and number of the micro-batch."""
    name = stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return (name, batch_id) if name else None


def orders_upsert_sink(spark: SparkSession, table_path: str, to_fact, stream: str | None = None):  # ST2
    """``foreachBatch`` handler: ``to_fact(batch_df)`` builds order-fact rows
    from the micro-batch; they are upserted with the lookback.

    The table's state records the last micro-batch of each stream in the same
    save that completes its write. A batch replayed after that is skipped
    without a look at the batch or the table; one replayed after a crash
    before it rewrites the same partitions with the same rows."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        stamp = _stamp(batch, batch_id, stream)
        if stamp is not None and already_written(spark, table_path, stamp):
            return
        fact = to_fact(batch)
        if not table_exists(spark, table_path) and fact.isEmpty():
            return  # an empty table would take no rows later: there is no newest order to look back from
        upsert_table(spark, table_path, fact, "order_id", "order_updated_at", ORDER_LOOKBACK,
                     "order_month", F.date_format("order_date", "yyyy-MM"), stamp=stamp)
    return handle


def payments_append_sink(spark: SparkSession, table_path: str, stream: str | None = None):  # ST3
    """``foreachBatch`` handler: payments whose id is absent are appended; replayed micro-batches as in :func:`orders_upsert_sink`."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        stamp = _stamp(batch, batch_id, stream)
        if stamp is not None and already_written(spark, table_path, stamp):
            return
        append_absent_table(spark, table_path, batch, "payment_id", "created_month",
                            F.date_format("created_at", "yyyy-MM"), stamp=stamp)
    return handle


def run_foreach_batch(df: DataFrame, handler, checkpoint: str) -> None:
    q = (df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
