import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from emporium.functions.macros import cents_to_dollars, date_spine, seconds_between, surrogate_key


def test_cents_to_dollars(spark):
    df = spark.createDataFrame([(0,), (-500,), (2999,), (999999999999,), (None,)], "c long")
    got = [r[0] for r in df.select(cents_to_dollars("c")).collect()]
    assert got == [Decimal("0.00"), Decimal("-5.00"), Decimal("29.99"), Decimal("9999999999.99"), None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("1", None, "7001", "shopify")], "a string, b string, c string, d string")
    r = df.select(surrogate_key("a").alias("k1"), surrogate_key("b").alias("k2"),
                  surrogate_key("c", "d").alias("k3"),
                  F.md5(F.lit("1")).alias("e1"), F.md5(F.lit("__NULL__")).alias("e2"),
                  F.md5(F.lit("7001|shopify")).alias("e3")).first()
    assert (r.k1, r.k2, r.k3) == (r.e1, r.e2, r.e3)
    assert r.k1 == "c4ca4238a0b923820dcc509a6f75849b"


def test_date_spine(spark):
    assert date_spine(spark, "2023-01-01", "2025-12-31").count() == 1096
    assert date_spine(spark, "2024-05-05", "2024-05-05").count() == 1
    days = [r[0] for r in date_spine(spark, "2024-02-28", "2024-03-01").orderBy("date_day").collect()]
    assert days == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]


def test_seconds_between(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11, 0, 0, 500000))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between("a", "b")).first()[0] == 3600.5
