"""Ordered-neighbour lookups that survive hot groups.

A plain ``lead() over (partition by key order by ts)`` sends every row of a
key to one task; if one key holds a third of the data, so does that task. We
split each key's timeline into time buckets, take the neighbour inside the
bucket with a window over (key, bucket), and resolve bucket edges from a
per-bucket aggregate that is tiny (one row per key and bucket).

Splitting costs a write of the rows, so by default the rows of the most
frequent key are counted first, from the key columns alone; where one task
can sort them, the plain window is the plan, and nothing else is run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of one key that are left to one task; a sort of that many spills at worst. A key with more is split.
GROUP_ROWS = 2_000_000

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}


def _width_seconds(width: str) -> int:
    n, unit = width.split()
    return int(n) * _UNITS[unit.lower().rstrip("s")]


def time_bucket(ts: str | Column, width: str) -> Column:
    """Number of the fixed-width time bucket holding ``ts`` (e.g. '1 hour').

    Zone-free: microseconds since the epoch of the wall-clock value.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             c.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(_width_seconds(width) * 1_000_000))


def _bucket_id(ts: str, width: str) -> Column:
    return time_bucket(ts, width)


def largest_group(keys: DataFrame) -> int:
    """Rows of the most frequent value of ``keys``: reads these columns only, and counts before it shuffles."""
    return keys.groupBy(*keys.columns).count().agg(F.max("count")).first()[0] or 0


def next_in_group(df: DataFrame, keys: list[str], ts: str, tie: str,
                  bucket: str = "1 hour", out: str = "next_ts", strategy: str = "auto",
                  num_buckets: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``out`` = the ``ts`` of the next row of the same ``keys`` ordered by
    (ts, tie); null for the last row.

    ``strategy="range"`` takes buckets from a range partitioning on
    (keys, ts, tie), frozen by a reliable checkpoint: every (key, bucket)
    group is at most one partition's share, however the key's rows spread in
    time. ``strategy="time"`` uses fixed-width time buckets instead.
    ``strategy="auto"`` (default) is ``"range"`` if some key has more than
    ``group_rows`` rows and a plain window otherwise.
    """
    b = "__bucket"
    if strategy == "auto":
        if largest_group(df.select(*keys)) <= group_rows:
            return df.withColumn(out, F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts, tie)))
        strategy = "range"
    if strategy == "time":
        d = df.withColumn(b, _bucket_id(ts, bucket))
    elif strategy == "range":
        from emporium.session import ensure_checkpoint_dir

        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        d = (df.repartitionByRange(n, *keys, ts, tie)
             .withColumn(b, F.spark_partition_id().cast("long")).checkpoint())
    else:
        raise ValueError(strategy)
    w = Window.partitionBy(*keys, b).orderBy(F.col(ts), F.col(tie))
    inner = d.withColumn(out, F.lead(ts).over(w))
    firsts = d.groupBy(*keys, b).agg(F.min(ts).alias("__first"))
    wb = Window.partitionBy(*keys).orderBy(b)
    edges = firsts.select(*keys, b, F.lead("__first").over(wb).alias("__next_bucket_first"))
    return (inner.join(edges, [*keys, b], "left")
            .withColumn(out, F.coalesce(F.col(out), F.col("__next_bucket_first")))
            .drop(b, "__next_bucket_first"))
