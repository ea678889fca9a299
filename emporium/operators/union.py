"""union_sources (U1): stack every relation that matches a schema/table
pattern, tagging each row with the schema it came from."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class NoRelationsFound(ValueError):
    pass


def union_relations(relations: dict[str, DataFrame], source_col: str = "_source_schema",
                    dedupe_key: str | None = None, order_col: str | None = None) -> DataFrame:
    """UNION ALL by column name (missing columns become null) plus the
    source tag. Optional de-duplication by key keeps the row with the
    greatest ``order_col`` (an aggregate, so a hot key is combined map-side)."""
    if not relations:
        raise NoRelationsFound("no relations to union")
    out = None
    for schema, df in relations.items():
        part = df.withColumn(source_col, F.lit(schema))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if dedupe_key:
        from emporium.operators.latest import latest_per_key
        out = latest_per_key(out, [dedupe_key], [order_col] if order_col else [source_col])
    return out


def discover_relations(spark: SparkSession, root: str, schema_pattern: str, table: str) -> dict[str, str]:
    """Find ``root/<schema>/<table>`` folders whose schema matches the
    glob pattern, through the cluster file system. Returns schema -> path."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    statuses = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{schema_pattern}/{table}")) or []
    for st in statuses:
        p = st.getPath()
        schema = p.getParent().getName()
        if fnmatch.fnmatch(schema, schema_pattern):
            found[schema] = p.toString()
    return dict(sorted(found.items()))


def union_sources(spark: SparkSession, root: str, schema_pattern: str, table: str,
                  fmt: str = "parquet") -> DataFrame:
    paths = discover_relations(spark, root, schema_pattern, table)
    if not paths:
        raise NoRelationsFound(f"nothing to union under {root}: no schema like {schema_pattern!r} holds a table {table!r}")
    return union_relations({s: spark.read.format(fmt).load(p) for s, p in paths.items()})
