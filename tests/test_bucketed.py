"""Bucketed order tables, and micro-batches that are written once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emporium.operators import table_state
from emporium.operators.bucketed import read_bucketed, write_bucketed
from emporium.operators.table_state import read_table, table_exists
from emporium.streaming import jobs

T = dt.datetime


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_order_fact_needs_no_exchange(spark, scratch, no_broadcast):
    """Joins and the item summary run inside the buckets; the rows are those of the shuffled plan."""
    from emporium.plans.build import land_order_tables
    from emporium.plans.checks import assert_no_orphaned_order_items
    from emporium.queries import warehouse

    w = warehouse(spark, SF_SMALL)
    shuffled = w.fct_orders
    land_order_tables(w, f"{scratch}/landed", 8)
    plan = w.fct_orders._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "Exchange" in shuffled._jdf.queryExecution().executedPlan().toString()
    orphans = assert_no_orphaned_order_items(w.stg["order_items"], w.stg["orders"])
    assert "Exchange" not in orphans._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, w.fct_orders.collect())) == sorted(map(str, shuffled.collect()))


def test_build_with_buckets_gives_the_same_tables(spark, scratch):
    from emporium.plans.build import build
    from emporium.queries import warehouse

    results = [build(spark, warehouse(spark, SF_SMALL), f"{scratch}/{n}", buckets=n or None, now="2024-06-16 12:00:00") for n in (0, 4)]
    assert results[0] == results[1]
    for name in ("fct_orders", "fct_payments", "rpt_daily_revenue", "fct_attribution"):
        a, b = (sorted(map(str, read_table(spark, f"{scratch}/{n}/{name}").collect())) for n in (0, 4))
        assert a == b


def test_rewrites_nulls_and_failures(spark, scratch):
    path = f"{scratch}/t"
    rows = lambda *r: spark.createDataFrame(r, "k long, v string, at timestamp_ntz, d decimal(10,2)")
    bad = rows((1, "x", None, None)).withColumn("v", F.raise_error(F.lit("broken row")).cast("string"))
    with pytest.raises(Exception, match="broken row"):
        write_bucketed(bad, path, "k", 4)
    assert not table_exists(spark, path)
    write_bucketed(rows((1, "a", T(2024, 1, 1), None), (None, "b", None, None), (None, "c", None, None)), path, "k", 4)
    old = read_bucketed(spark, path)
    with pytest.raises(Exception, match="broken row"):
        write_bucketed(bad, path, "k", 4)
    assert sorted((r.k or 0, r.v) for r in old.collect()) == [(0, "b"), (0, "c"), (1, "a")]
    write_bucketed(rows((7, "z", None, None)), path, "k", 4)
    assert [(r.k, r.v) for r in read_bucketed(spark, path).collect()] == [(7, "z")]
    write_bucketed(rows().limit(0), path, "k", 4)
    assert read_bucketed(spark, path).count() == 0 and read_bucketed(spark, path).columns == ["k", "v", "at", "d"]
    spark.range(3).write.parquet(f"{scratch}/plain")
    with pytest.raises(ValueError):
        read_bucketed(spark, f"{scratch}/plain")


def test_another_session_knows_the_buckets(spark, scratch, no_broadcast):
    """The state is enough: a catalog that has never heard of the tables plans them without an exchange."""
    for name in ("a", "b"):
        write_bucketed(spark.range(100).withColumnRenamed("id", "k"), f"{scratch}/{name}", "k", 4)
        spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.startswith('bucketed_')][0]}")
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    j = read_bucketed(other, f"{scratch}/a").join(read_bucketed(other, f"{scratch}/b"), "k")
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString() and j.count() == 100


# --- micro-batches -------------------------------------------------------------------

ORD = "order_id long, order_date timestamp_ntz, order_updated_at timestamp_ntz, status string"
PAY = "payment_id long, status string, created_at timestamp_ntz"


def sinks(spark, path):
    order = lambda *r: spark.createDataFrame([(i, T(2024, 1, d), T(2024, 1, d), s) for i, d, s in r], ORD)
    pay = lambda *r: spark.createDataFrame([(i, s, T(2024, 1, d)) for i, d, s in r], PAY)
    return {"orders": (lambda name="q": jobs.orders_upsert_sink(spark, path, lambda b: b, name), order),
            "payments": (lambda name="q": jobs.payments_append_sink(spark, path, name), pay)}


@pytest.mark.parametrize("kind", ["orders", "payments"])
def test_a_replayed_batch_is_skipped(spark, scratch, kind):
    path = f"{scratch}/t"
    sink, rows = sinks(spark, path)[kind]
    handle = sink()
    handle(rows((1, 1, "a")), 0)
    handle(rows((2, 2, "b")), 1)
    got = lambda: sorted((r[0], r.status) for r in read_table(spark, path).collect())
    before = got()
    # neither the batch nor the table is looked at: the batch raises if it is
    handle(rows((9, 3, "z")).withColumn("status", F.raise_error(F.lit("looked at")).cast("string")), 1)
    handle(rows((9, 3, "z")), 0)
    assert got() == before == [(1, "a"), (2, "b")]
    handle(rows(), 2)  # an empty one counts too
    handle(rows((9, 3, "z")), 2)
    sink("other")(rows((3, 3, "c")), 0)  # streams are told apart
    assert got() == [(1, "a"), (2, "b"), (3, "c")]
    assert table_state.load(spark, path).batches == {"q": 2, "other": 0}


@pytest.mark.parametrize("kind", ["orders", "payments"])
@pytest.mark.parametrize("dies_at", [1, 2])
def test_a_batch_replayed_after_a_crash_is_written_once(spark, scratch, kind, dies_at, monkeypatch):
    """Dying before the data or between data and state: the replay finishes the batch, the next replay does nothing."""
    path = f"{scratch}/t"
    sink, rows = sinks(spark, path)[kind]
    handle, batch = sink(), rows((1, 2, "x"), (2, 3, "b"))
    handle(rows((1, 1, "a")), 0)
    save, calls = table_state.save, []

    def dies(*a):
        calls.append(1)
        if len(calls) == dies_at:
            raise OSError("gone")
        save(*a)
    monkeypatch.setattr(table_state, "save", dies)
    with pytest.raises(OSError):
        handle(batch, 1)
    monkeypatch.setattr(table_state, "save", save)
    assert table_state.load(spark, path).batches == {"q": 0}
    handle(batch, 1)
    want = [(1, "x"), (2, "b")] if kind == "orders" else [(1, "a"), (2, "b")]
    assert sorted((r[0], r.status) for r in read_table(spark, path).collect()) == want
    state = table_state.load(spark, path)
    # a payments batch whose rows are all there writes nothing, so the dead run's note stays until a batch writes
    assert state.batches == {"q": 1} or (kind, dies_at, state.pending is not None) == ("payments", 2, True)
    handle(batch, 1)
    assert sorted((r[0], r.status) for r in read_table(spark, path).collect()) == want


def test_streams_name_themselves(spark, scratch):
    """A running query's id is the stream's name; a restart from its checkpoint goes on with it."""
    src, path = f"{scratch}/in", f"{scratch}/t"
    for k in (1, 2):
        spark.createDataFrame([(k, "s", T(2024, 1, k))], PAY).write.mode("append").parquet(src)
        stream = spark.readStream.schema(PAY).parquet(src)
        jobs.run_foreach_batch(stream, jobs.payments_append_sink(spark, path), f"{scratch}/ck")
        assert list(table_state.load(spark, path).batches.values()) == [k - 1]
    assert read_table(spark, path).count() == 2
