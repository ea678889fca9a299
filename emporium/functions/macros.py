"""Reusable column and DataFrame helpers (the warehouse's macros).

All of them are JVM-side expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must match the warehouse for identical keys.
SURROGATE_SEPARATOR = "|"
SURROGATE_NULL = "__NULL__"

MONEY = T.DecimalType(12, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents_to_dollars(c: str | Column) -> Column:
    """Integer cents -> decimal(12,2) dollars; null stays null."""
    return (_col(c) / F.lit(100.0)).cast(MONEY)


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the columns cast to string, nulls replaced by a sentinel,
    joined with a separator."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed seconds (double, microsecond precision) between two timestamps."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1e6)


def date_spine(spark: SparkSession, start: str | dt.date | Column,
               end: str | dt.date | Column, name: str = "date_day") -> DataFrame:
    """One row per day, both ends inclusive.

    Generated inside one ``explode`` of a ``sequence``: the spine is bounded by
    its date range (1,096 rows for three years), not by data volume.
    """
    def as_date(x):
        if isinstance(x, Column):
            return x.cast("date")
        return F.lit(str(x)).cast("date")

    return (spark.range(1)
            .select(F.explode(F.sequence(as_date(start), as_date(end),
                                         F.expr("INTERVAL 1 DAY"))).alias(name)))


def date_spine_between(bounds: DataFrame, lo: str, hi: str, name: str = "date_day") -> DataFrame:
    """Spine whose ends come from a one-row DataFrame (no driver round trip)."""
    return bounds.select(F.explode(F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias(name))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def wall_clock_instant(c: str | Column) -> Column:
    """Wall-clock ``timestamp_ntz`` -> ``timestamp`` at the same reading in UTC,
    independent of the session time zone (watermarks and windows need a
    zoned type; daily windows then align with wall-clock days)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _col(c))
    return F.timestamp_micros(micros)


def instant_wall_clock(c: str | Column) -> Column:
    """Inverse of ``wall_clock_instant``: zoned instant -> UTC wall clock (ntz)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
