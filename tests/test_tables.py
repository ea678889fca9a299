"""Table writers: schema changes, empty tables, reruns and runs that die half way."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporium.operators import incremental, table_state
from emporium.operators.incremental import append_absent_table, upsert_table
from emporium.operators.snapshot import read_snapshot, snapshot_table
from emporium.operators.table_state import read_table

T = dt.datetime


def month():
    return F.date_format("ts", "yyyy-MM")


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "id long, v string, ts timestamp_ntz" + extra)


def upsert(spark, path, df, lookback="30 DAYS"):
    return upsert_table(spark, path, df, "id", "ts", lookback, "month", month())


def test_three_runs_with_a_new_column(spark, scratch):
    path = f"{scratch}/t"
    upsert(spark, path, frame(spark, [(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 2))]))
    upsert(spark, path, frame(spark, [(3, "c", T(2024, 1, 3), 9)], ", added long"))
    upsert(spark, path, frame(spark, [(4, "d", T(2024, 1, 4), 8)], ", added long"))
    assert {(r.id, r.added) for r in read_table(spark, path).collect()} == {(1, None), (2, None), (3, 9), (4, 8)}


def test_a_column_that_goes_does_not_come_back_with_old_values(spark, scratch):
    path = f"{scratch}/t"
    upsert(spark, path, frame(spark, [(1, "a", T(2024, 1, 1), 5)], ", n long"))
    upsert(spark, path, frame(spark, [(2, "b", T(2024, 1, 20))]))
    assert "n" not in read_table(spark, path).columns
    upsert(spark, path, frame(spark, [(3, "c", T(2024, 2, 1), "x")], ", n string"))
    assert {(r.id, r.n) for r in read_table(spark, path).collect()} == {(1, None), (2, None), (3, "x")}


def test_empty_first_runs(spark, scratch):
    none = frame(spark, [])
    upsert(spark, f"{scratch}/u", none)
    upsert(spark, f"{scratch}/u", frame(spark, [(1, "a", T(2024, 1, 1))]))  # no newest row to look back from: nothing enters
    assert read_table(spark, f"{scratch}/u").count() == 0
    for rows in ([], [(1, "a", T(2024, 1, 1))], [(1, "b", T(2024, 1, 1)), (2, "c", T(2024, 2, 1))]):
        append_absent_table(spark, f"{scratch}/a", frame(spark, rows), "id", "month", month())
        snapshot_table(spark, f"{scratch}/s", frame(spark, rows), "id", "ts", "2024-03-01 00:00:00", f"r{len(rows)}")
    assert {(r.id, r.v) for r in read_table(spark, f"{scratch}/a").collect()} == {(1, "a"), (2, "c")}
    assert {(r.id, r.v, r.valid_to) for r in read_snapshot(spark, f"{scratch}/s").collect()} == {(1, "a", None), (2, "c", None)}


def test_keys_move_between_partitions_and_state_prunes(spark, scratch):
    path = f"{scratch}/t"
    upsert(spark, path, frame(spark, [(k, "a", T(2024, 1 + k // 10, 1)) for k in range(40)]))
    info = upsert(spark, path, frame(spark, [(35, "b", T(2024, 5, 1)), (41, "c", T(2024, 5, 2))]))
    assert info["touched"] == ["2024-04", "2024-05"]  # months whose key range does not meet the batch are not looked at
    got = {r.id: (r.v, r.month) for r in read_table(spark, path).collect()}
    assert got[35] == ("b", "2024-05") and len(got) == 41
    state = table_state.load(spark, path)
    assert state.newest() == "2024-05-02 00:00:00" and state.partitions["2024-01"][1:] == ["0", "9"]


def test_a_run_that_dies_after_writing_is_made_good(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    upsert(spark, path, frame(spark, [(1, "a", T(2024, 1, 1)), (2, "a", T(2024, 1, 2))]))
    batch = frame(spark, [(1, "b", T(2024, 1, 3)), (3, "b", T(2024, 9, 1))])
    save = table_state.save
    calls = []

    def dies(*a):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("gone")
        save(*a)
    monkeypatch.setattr(table_state, "save", dies)
    with pytest.raises(OSError):
        upsert(spark, path, batch)
    monkeypatch.setattr(table_state, "save", save)
    # as if only the newest partition had been committed: the older one is still as before
    old = frame(spark, [(1, "a", T(2024, 1, 1)), (2, "a", T(2024, 1, 2))]).withColumn("month", month())
    old.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    upsert(spark, path, batch)
    assert {(r.id, r.v) for r in read_table(spark, path).collect()} == {(1, "b"), (2, "a"), (3, "b")}
    assert table_state.load(spark, path).pending is None


def test_snapshot_same_run_id_with_a_newer_source(spark, scratch):
    path = f"{scratch}/s"
    take = lambda rows: snapshot_table(spark, path, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00", "day1")
    snapshot_table(spark, path, frame(spark, [(1, "a", T(2024, 1, 1)), (2, "a", T(2024, 1, 1))]), "id", "ts", "2024-01-02 00:00:00", "day0")
    take([(1, "b", T(2024, 2, 1)), (2, "a", T(2024, 1, 1))])
    take([(1, "b", T(2024, 2, 1)), (2, "b", T(2024, 3, 1))])
    assert sorted((r.id, r.v, str(r.valid_to)) for r in read_snapshot(spark, path).collect()) == [
        (1, "a", "2024-02-01 00:00:00"), (1, "b", "None"), (2, "a", "2024-03-01 00:00:00"), (2, "b", "None")]


def test_snapshot_takes_a_new_column(spark, scratch):
    path = f"{scratch}/s"
    snapshot_table(spark, path, frame(spark, [(1, "a", T(2024, 1, 1))]), "id", "ts", "2024-01-02 00:00:00", "r1")
    snapshot_table(spark, path, frame(spark, [(1, "b", T(2024, 2, 1), 7)], ", n long"), "id", "ts", "2024-02-02 00:00:00", "r2")
    assert {(r.v, r.n) for r in read_snapshot(spark, path).collect()} == {("a", None), ("b", 7)}


def test_snapshot_that_dies_between_closed_and_open(spark, scratch, monkeypatch):
    from emporium.operators import snapshot

    path = f"{scratch}/s"
    snapshot_table(spark, path, frame(spark, [(1, "a", T(2024, 1, 1)), (2, "a", T(2024, 1, 1))]), "id", "ts", "2024-01-02 00:00:00", "r1")
    before = spark.read.parquet(path).where("scd_part = 'current'").collect()
    newer = frame(spark, [(1, "b", T(2024, 2, 1)), (2, "a", T(2024, 1, 1))])
    snapshot_table(spark, path, newer, "id", "ts", "2024-02-02 00:00:00", "r2")
    # put the open rows back as they were: only the closed ones had been written
    spark.createDataFrame(before, spark.read.parquet(path).schema).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("scd_part").parquet(path)
    assert read_snapshot(spark, path).where("id = 1").count() == 1
    snapshot_table(spark, path, newer, "id", "ts", "2024-02-02 00:00:00", "r2")
    got = sorted((r.id, r.v, str(r.valid_to)) for r in read_snapshot(spark, path).collect())
    assert got == [(1, "a", "2024-02-01 00:00:00"), (1, "b", "None"), (2, "a", "None")]
    assert snapshot.PART == "scd_part"


def test_a_failing_model_leaves_an_error_row(spark, scratch):
    from conftest import SF_SMALL
    from emporium.plans.build import build
    from emporium.queries import warehouse

    w = warehouse(spark, SF_SMALL)
    w.__dict__["dim_products"] = spark.range(1).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        build(spark, w, f"{scratch}/wh")
    rows = read_table(spark, f"{scratch}/wh/run_audit").collect()
    assert [(r.status, r.model_count) for r in rows] == [("error", 4)]


def test_streams_skip_empty_first_batches(spark, scratch):
    from emporium.streaming.jobs import orders_upsert_sink

    sink = orders_upsert_sink(spark, f"{scratch}/t", lambda b: b)
    schema = "order_id long, order_date timestamp_ntz, order_updated_at timestamp_ntz"
    sink(spark.createDataFrame([], schema), 0)
    sink(spark.createDataFrame([(1, T(2024, 1, 1), T(2024, 1, 1))], schema), 1)
    assert read_table(spark, f"{scratch}/t").count() == 1
    assert incremental.upsert_table is upsert_table


def test_a_report_leaves_caches_alone(spark):
    from emporium.operators.quality import Check, quality_report

    df = spark.createDataFrame([(1,), (None,)], "k long").persist()
    df.count()
    quality_report({"m": df}, [Check("m", "k", "not_null")]).collect()
    assert df.storageLevel.useMemory
    df.unpersist()


def test_anonymous_sessions_spread(spark):
    """Half of the sessions are anonymous; no task of the join gets them all."""
    from emporium.plans.intermediate import int_sessions_mapped_to_users

    s = spark.range(4000).select(
        F.col("id").cast("string").alias("session_id"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("user_id"),
        *[F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")],
        *[F.lit("x").alias(c) for c in ("device_type", "channel", "landing_page")])
    u = spark.range(50).select(F.col("id").alias("user_id"), *[F.lit("u").alias(c) for c in ("full_name", "email", "tier")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = int_sessions_mapped_to_users(s, u)
        sizes = [r.n for r in out.select("is_anonymous", "user_name", F.spark_partition_id().alias("p")).groupBy("p").agg(
            F.sum((F.col("is_anonymous") & F.col("user_name").isNull()).cast("int")).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 800
    assert out.where("user_id is not null and user_name is null").count() == 0


def test_rows_without_a_date_are_found_again(spark, scratch):
    """The partition of null dates is looked in, kept when other rows of it change, and left when a row gets its date."""
    pay = lambda rows: spark.createDataFrame(rows, "id long, v string, at timestamp_ntz")
    for _ in range(3):
        append_absent_table(spark, f"{scratch}/a", pay([(1, "a", None), (2, "b", T(2024, 1, 1))]), "id", "month", F.date_format("at", "yyyy-MM"))
    assert sorted(r.id for r in read_table(spark, f"{scratch}/a").collect()) == [1, 2]

    def run(rows):
        df = spark.createDataFrame(rows, "id long, v string, at timestamp_ntz, ts timestamp_ntz")
        upsert_table(spark, f"{scratch}/u", df, "id", "ts", "30 DAYS", "month", F.date_format("at", "yyyy-MM"))
        return sorted((r.id, r.v) for r in read_table(spark, f"{scratch}/u").collect())
    run([(1, "a", None, T(2024, 1, 1)), (2, "a", None, T(2024, 1, 1)), (3, "a", T(2024, 1, 1), T(2024, 1, 1))])
    assert run([(2, "b", None, T(2024, 1, 2))]) == [(1, "a"), (2, "b"), (3, "a")]
    assert run([(1, "c", T(2024, 2, 1), T(2024, 1, 3))]) == [(1, "c"), (2, "b"), (3, "a")]
    assert run([(2, "d", T(2024, 2, 1), T(2024, 1, 4))]) == [(1, "c"), (2, "d"), (3, "a")]
    assert table_state.NULL_PARTITION not in table_state.load(spark, f"{scratch}/u").partitions


def test_a_state_with_the_old_name_of_nulls_is_measured_anew(spark, scratch):
    path, rows = f"{scratch}/a", [(1, "a", None), (2, "b", T(2024, 1, 1))]
    again = lambda: append_absent_table(spark, path, frame(spark, rows), "id", "month", month())
    again()
    state = table_state.load(spark, path)
    state.partitions["None"] = state.partitions.pop(table_state.NULL_PARTITION)
    table_state.save(spark, path, state)
    again()
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 2]


@pytest.mark.parametrize("kind, keys", [("string", ["9", "10", "100", "x"]), ("decimal(10,2)", ["0.50", "9.00", "10.25", "11.00"])])
def test_keys_that_are_not_integers_are_found_again(spark, scratch, kind, keys):
    def months(picked):
        df = spark.createDataFrame([(keys[k], "a", T(2024, m, 1)) for k, m in picked], "id string, v string, ts timestamp_ntz")
        return df.withColumn("id", F.col("id").cast(kind))
    for _ in range(2):
        append_absent_table(spark, f"{scratch}/a", months([(0, 1), (1, 1), (2, 1), (3, 2)]), "id", "month", month())
        append_absent_table(spark, f"{scratch}/a", months([(1, 3), (2, 3)]), "id", "month", month())
    assert sorted(str(r.id) for r in read_table(spark, f"{scratch}/a").collect()) == sorted(keys)
    for picked in ([(0, 1), (1, 1), (2, 2), (3, 2)], [(1, 3), (2, 3)]):
        upsert_table(spark, f"{scratch}/u", months(picked), "id", "ts", "90 DAYS", "month", month())
    assert sorted((str(r.id), r.month) for r in read_table(spark, f"{scratch}/u").collect()) == sorted(zip(keys, ["2024-01", "2024-03", "2024-03", "2024-02"]))
