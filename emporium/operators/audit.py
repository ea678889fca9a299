"""Run audit (A1): one row appended per build to a Parquet audit table."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("invocation_id", T.StringType()),
    T.StructField("run_started_at", T.TimestampNTZType()),
    T.StructField("run_completed_at", T.TimestampNTZType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("model_count", T.IntegerType()),
    T.StructField("test_count", T.IntegerType()),
    T.StructField("status", T.StringType()),
])


def audit_row(spark: SparkSession, started: dt.datetime, target_name: str, results: list[dict],
              invocation_id: str | None = None, completed: dt.datetime | None = None) -> DataFrame:
    """``results``: one dict per executed node with ``resource_type``
    ('model'/'test') and ``status`` ('success'/'pass'/'fail'/'error')."""
    models = sum(1 for r in results if r["resource_type"] == "model")
    tests = sum(1 for r in results if r["resource_type"] == "test")
    failed = any(r["status"] in ("error", "fail") for r in results)
    row = (invocation_id or str(uuid.uuid4()), started,
           completed or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           target_name, models, tests, "error" if failed else "success")
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def log_run(spark: SparkSession, path: str, row: DataFrame) -> None:
    row.write.mode("append").parquet(path)
