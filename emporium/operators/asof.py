"""As-of ("latest match at or before") join without emitting all pairs.

For every left row we want the right row of the same key with the greatest
(right_ts, tie) such that right_ts <= left_ts. Joining on the key and
filtering by time would emit left x right pairs per key, which explodes for
a heavy key. Instead both sides are unioned onto one timeline and scanned:

1. Each row gets a time bucket; within (key, bucket) a running maximum of the
   right payload, ordered by time (right rows sort before left rows at equal
   time, so "at" counts as "before"), answers the left rows that have a match
   in their own bucket.
2. A per-(key, bucket) aggregate - one row per key and bucket, tiny - gives
   the best right row of each bucket; a running maximum over earlier buckets
   answers left rows whose own bucket holds no earlier right row.

Buckets come from one of three strategies:

* ``"auto"`` (default): rows of the most frequent key are counted first, from
  the key columns alone. Where one task can sort them, a key is one bucket:
  one shuffle of the timeline, no checkpoint, and step 2 falls away. Else it
  is ``"range"``.
* ``"range"``: the unioned rows are range-partitioned on
  (key, time, side, tie) and the partition number is the bucket. Range
  boundaries are drawn from a sample, so every (key, bucket) group holds at
  most about one partition's share of the rows - a key holding a third of the
  data spans about a third of the partitions, whatever its time profile. The
  partition number is frozen with a reliable ``checkpoint()`` so both uses
  of it see the same buckets.
* ``"time"``: fixed-width time buckets (no extra shuffle or checkpoint);
  splits a hot key only as far as its rows spread over time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.operators.sequence import GROUP_ROWS, largest_group, time_bucket
from emporium.session import ensure_checkpoint_dir


def asof_latest(left: DataFrame, right: DataFrame, left_key: str, left_ts: str,
                right_key: str, right_ts: str, right_tie: str, payload: list[str],
                prefix: str = "", bucket: str = "7 days", strategy: str = "auto",
                num_buckets: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Left rows plus ``payload`` columns (renamed ``prefix + name``) of the
    latest right row with right_ts <= left_ts and equal key; nulls if none.

    Ties on right_ts go to the greatest ``right_tie``. Left rows with a null
    key keep nulls. Right rows with a null key or time never match.
    """
    lcols = left.columns
    fields = [right_ts, right_tie] + [c for c in payload if c not in (right_ts, right_tie)]
    r = right.where(F.col(right_key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(right_key).alias("__k"), F.col(right_ts).alias("__t"), F.lit(0).alias("__side"),
        F.struct(*[F.col(c).alias(c) for c in fields]).alias("__pay"),
        F.lit(None).alias("__left"))
    pay_type = r.schema["__pay"].dataType
    left_struct = F.struct(*[F.col(c) for c in lcols])
    l = left.select(
        F.col(left_key).alias("__k"), F.col(left_ts).alias("__t"), F.lit(1).alias("__side"),
        F.lit(None).cast(pay_type).alias("__pay"), left_struct.alias("__left"))
    r = r.withColumn("__left", F.lit(None).cast(l.schema["__left"].dataType))
    u = r.unionByName(l)
    best_of = lambda rows, best: rows.select(
        *[F.col(f"__left.{c}").alias(c) for c in lcols], *[best.getField(c).alias(prefix + c) for c in payload])
    if strategy == "auto":
        keys = u.select("__k").where(F.col("__k").isNotNull())
        strategy = "whole" if largest_group(keys) <= group_rows else "range"
    if strategy == "whole":
        # left rows without a key match nothing; a hash spreads them over the tasks
        spread = F.when(F.col("__k").isNull(), F.xxhash64("__left")).otherwise(F.lit(0))
        w = (Window.partitionBy("__k", "__b").orderBy("__t", "__side")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return best_of(u.withColumn("__b", spread).withColumn("__in", F.max("__pay").over(w)).where(F.col("__side") == 1), F.col("__in"))
    if strategy == "time":
        u = u.withColumn("__b", time_bucket("__t", bucket))
    elif strategy == "range":
        spark = left.sparkSession
        ensure_checkpoint_dir(spark)
        n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # tie columns let the range boundaries split rows with equal (key, time)
        u = (u.withColumn("__tr", F.when(F.col("__side") == 0, F.col("__pay").getField(right_tie).cast("string")))
             .withColumn("__tl", F.when(F.col("__side") == 1, F.xxhash64("__left")))
             .repartitionByRange(n, "__k", "__t", "__side", "__tr", "__tl")
             .withColumn("__b", F.spark_partition_id().cast("long"))
             .drop("__tr", "__tl")
             .checkpoint())
    else:
        raise ValueError(strategy)

    w_in = (Window.partitionBy("__k", "__b").orderBy("__t", "__side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = u.withColumn("__in", F.max("__pay").over(w_in)).where(F.col("__side") == 1)

    per_bucket = (u.where(F.col("__k").isNotNull())
                  .groupBy("__k", "__b").agg(F.max("__pay").alias("__bmax")))
    w_prev = (Window.partitionBy("__k").orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_bucket.select("__k", "__b", F.max("__bmax").over(w_prev).alias("__prev"))

    return best_of(scanned.join(carry, ["__k", "__b"], "left"), F.coalesce(F.col("__in"), F.col("__prev")))
