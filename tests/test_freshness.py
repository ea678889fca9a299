"""Freshness of landed tables from the footers of their files."""

import datetime as dt

from emporium.operators.freshness import LOADED_MICROS, landed_freshness, newest_landed, source_freshness, with_loaded_micros

T = dt.datetime


def test_the_newest_load_time_comes_from_footers(spark, scratch):
    times = {"orders": [T(2024, 1, 1), T(2024, 3, 5, 6, 7, 8, 9), None], "users": [T(1965, 5, 5, 1)], "events": [], "payments": [None]}
    raw = {t: spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id long, _etl_loaded_at timestamp_ntz") for t, xs in times.items()}
    paths = {t: f"{scratch}/{t}" for t in raw}
    for t, df in raw.items():
        with_loaded_micros(df).repartition(3).write.parquet(paths[t])
    plan = newest_landed(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"PushedAggregation: [MAX({LOADED_MICROS})]") == len(paths)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false" and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    for now in ("2024-03-05 12:07:08", "2024-03-05 12:07:09", "2024-03-06 12:00:00"):
        got, want = (sorted(map(str, f.collect())) for f in (landed_freshness(spark, paths, now), source_freshness(raw, now)))
        assert got == want and any("status='error'" in r for r in got)


def test_the_clock_of_the_session_does_not_matter(spark, scratch):
    raw = {"orders": spark.createDataFrame([(1, T(2024, 3, 10, 2, 30))], "id long, _etl_loaded_at timestamp_ntz")}
    with_loaded_micros(raw["orders"]).write.parquet(f"{scratch}/orders")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = landed_freshness(spark, {"orders": f"{scratch}/orders"}, "2024-03-10 08:30:00").collect()
        assert got == source_freshness(raw, "2024-03-10 08:30:00").collect() and got[0].status == "pass"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
