"""Source freshness (F1): age of the newest ``_etl_loaded_at`` per table
against warn/error limits per source. ``now`` is a parameter so that the
check is reproducible; pass ``F.current_timestamp()`` in production. The
limits say "after", so a table warns or errors once it is strictly older.

Landed tables carry the load time as a number as well (``LOADED_MICROS``).
Parquet's footers hold the largest number of every file, so
:func:`landed_freshness` reads no row of them, however large they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.sources.schemas import SOURCE_OF

# Fixed values: (warn_after_hours, error_after_hours) per source.
FRESHNESS_LIMITS = {"app_db": (12, 24), "shopify": (6, 12), "stripe": (6, 12), "web_analytics": (3, 6)}


def source_freshness(raw: dict[str, DataFrame], now: Column | str,
                     loaded_at: str = "_etl_loaded_at") -> DataFrame:
    """One row per raw table: max loaded time, age in hours, pass/warn/error.

    Each table contributes a one-row global aggregate that reads only the
    load-time column (column pruning, partial max per task); the union is as
    many rows as tables.
    """
    out = None
    for table in raw:
        part = raw[table].agg(F.max(loaded_at).alias("max_loaded_at")).select(
            F.lit(SOURCE_OF[table]).alias("source_name"), F.lit(table).alias("table_name"), "max_loaded_at")
        out = part if out is None else out.unionByName(part)
    return _judged(out, now, list(raw))


def _judged(newest: DataFrame, now: Column | str, tables: list[str]) -> DataFrame:
    """Age and status of each table's newest load time, by the limits of its source."""
    now_c = F.lit(now).cast("timestamp_ntz") if isinstance(now, str) else now.cast("timestamp_ntz")
    warn = err = F.lit(None).cast("int")
    for source in {SOURCE_OF[t] for t in tables}:
        here = F.col("source_name") == source
        warn, err = (F.when(here, F.lit(hours)).otherwise(other) for hours, other in zip(FRESHNESS_LIMITS[source], (warn, err)))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now_c) / F.lit(3600.0)
    return newest.select("source_name", "table_name", "max_loaded_at", age.alias("age_hours"),
                         F.when(F.col("max_loaded_at").isNull() | (age > err), "error").when(age > warn, "warn").otherwise("pass").alias("status"))


#: Column of landed tables: microseconds since 1970 on the clock that the load time was read from.
LOADED_MICROS = "_etl_loaded_us"
EPOCH = "1970-01-01 00:00:00"
#: Stands for a null load time: footers have no bounds of a column that is all null.
NEVER = -(1 << 63)


def with_loaded_micros(df: DataFrame, loaded_at: str = "_etl_loaded_at") -> DataFrame:
    """The rows with their load time as a number too, for landing. It is the first column: Spark finds a column's
    statistics in the footers by its place, and the first keeps its place when columns are added."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(loaded_at))
    return df.select(F.coalesce(micros, F.lit(NEVER)).alias(LOADED_MICROS), "*")


def newest_landed(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_name`` and the largest ``LOADED_MICROS`` of each folder of Parquet files, as an aggregate of their footers.

    Spark answers it from the footers only through its newer file reader, so
    the plan belongs to a session of its own with that reader switched on;
    the caller's settings stay as they are.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = None
    for table, path in paths.items():
        part = own.read.schema(f"{LOADED_MICROS} bigint").parquet(path).agg(F.max(LOADED_MICROS).alias("us")).select(F.lit(table).alias("table_name"), "us")
        out = part if out is None else out.unionByName(part)
    return out


def landed_freshness(spark: SparkSession, paths: dict[str, str], now: Column | str) -> DataFrame:
    """:func:`source_freshness` of landed tables, by name the folder of each; a table without rows is an error."""
    found = [(SOURCE_OF[r.table_name], r.table_name, None if r.us == NEVER else r.us) for r in newest_landed(spark, paths).collect()]  # a row a table
    newest = spark.createDataFrame(found, "source_name string, table_name string, us long")
    at = F.timestamp_add("MICROSECOND", F.col("us"), F.lit(EPOCH).cast("timestamp_ntz"))
    return _judged(newest.withColumn("max_loaded_at", at), now, list(paths))
