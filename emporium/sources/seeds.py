"""CSV seed loading and the raw landing table.

A seed is a header CSV whose empty fields are nulls. Batches land by primary
key: the newest ``_etl_loaded_at`` wins (ties: the row ordering columns given).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.sources.schemas import PRIMARY_KEYS, RAW_SCHEMAS, SOURCE_OF

# Seed file stems per raw table (initial/incremental suffix is appended).
SEED_STEMS = {t: t for t in RAW_SCHEMAS}


def read_seed(spark: SparkSession, seed_dir: str, table: str, batch: str = "initial") -> DataFrame:
    """Read one seed CSV with its declared schema (header row, empty = null)."""
    path = os.path.join(seed_dir, SOURCE_OF[table], f"{SEED_STEMS[table]}_{batch}.csv")
    return (spark.read.schema(RAW_SCHEMAS[table])
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path))


def land(batches: list[DataFrame], key: str, tie_breakers: list[str] | None = None) -> DataFrame:
    """Upsert batches by key: per key keep the row with the newest
    ``_etl_loaded_at``; ties fall to ``tie_breakers`` in ascending order.

    Latest-per-key is a plain aggregate (``min`` over an ordering struct), so
    Spark combines it map-side before the shuffle and a hot key cannot pile
    up in one task.
    """
    df = batches[0]
    for b in batches[1:]:
        df = df.unionByName(b)
    cols = df.columns
    tb = tie_breakers or [c for c in cols if c not in (key, "_etl_loaded_at")]
    # min over (-loaded_at, tie breakers, the rest) == newest load, then smallest tie-breakers; the row is read off the ordering
    rest = [*tb, *[c for c in cols if c not in tb and c != key]]
    order = F.struct(
        F.timestamp_diff("MICROSECOND", F.col("_etl_loaded_at"),
                        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("__neg_loaded"),
        *[F.col(c).alias(f"__c{i}") for i, c in enumerate(rest)])
    named = {key: F.col(key)} | {c: F.col(f"__best.__c{i}") for i, c in enumerate(rest)}
    return df.groupBy(key).agg(F.min(order).alias("__best")).select(*[named[c].alias(c) for c in cols])


def load_seed_tables(spark: SparkSession, seed_dir: str, batches=("initial",)) -> dict[str, DataFrame]:
    """All raw tables from seeds, landing the given batches in order."""
    out = {}
    for t in RAW_SCHEMAS:
        dfs = [read_seed(spark, seed_dir, t, b) for b in batches]
        out[t] = dfs[0] if len(dfs) == 1 else land(dfs, PRIMARY_KEYS[t])
    return out
