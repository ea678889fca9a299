"""Tables kept in hash buckets of a key, so that joins and aggregates on it need no shuffle.

Spark's Parquet files do not say how their rows are bucketed; its catalog
does. The state file of a table written here names the key and the number of
buckets, and :func:`read_bucketed` declares the files to the session's
catalog from it, so any session can use them. Tables that are bucketed alike
meet bucket by bucket: each task reads the same bucket of every one, and no
exchange is left in the plan. Files are sorted by the key as well, so the
sorts that Spark keeps before a merge join find rows already in order.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from emporium.operators import table_state
from emporium.operators.fs import delete_paths

#: Buckets are about the size of one task's input; a table's number of them should not change once others join it.
BUCKETS = 64


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Replace the table by ``df``, in ``buckets`` files sorted by ``key``.

    One shuffle, so that each bucket is one file. Rows with a null key share
    a bucket. As with every rebuild the rows go to a fresh version folder
    and the saved state makes them the table; a write that fails leaves the
    old rows, or no table.
    """
    spark, version = df.sparkSession, table_state.new_version()
    state = table_state.TableState(table_state.schema_of(df), key=key, version=version, buckets=buckets)
    files, name = table_state.location(path, state), _name(path, state)
    try:
        (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", files).saveAsTable(name))
        table_state.save(spark, path, state)
    except Exception:
        now = table_state.load(spark, path)
        if now is None or now.version != version:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_paths(spark, [files])
        raise
    table_state.drop_other_versions(spark, path, version)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table, with its buckets known to the planner."""
    state = table_state.load(spark, path)
    if state is None or not state.buckets:
        raise ValueError(f"{path} is not a bucketed table")
    name = _name(path, state)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.struct.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{table_state.location(path, state)}' "
              f"CLUSTERED BY (`{state.key}`) SORTED BY (`{state.key}`) INTO {state.buckets} BUCKETS")
    return spark.table(name)


def _name(path: str, state: table_state.TableState) -> str:
    """Catalog name of one version of a table: the same in every session, and never that of another version."""
    return "bucketed_" + hashlib.md5(table_state.location(path, state).encode()).hexdigest()[:20]
