"""Which partitions of a written table may hold a key, for keys whose ranges say nothing (text, decimals, days, times).

Beside the state file lies a narrow Parquet table: one row for each partition
name and 64-bit fingerprint of a key in it. A run joins its batch's
fingerprints with it and looks for existing keys only in the partitions that
come out. It is a filter, not the truth: two keys may share a fingerprint, and
a key that has left a partition keeps its entry until the next rebuild. Either
costs a look into a partition in vain; the exact join on the keys decides.

A fingerprint takes eight bytes a key where a Bloom filter would take three or
four. For that a batch may be of any size: a Bloom filter's false hits grow
with the batch, until some key of it hits every partition.

Entries are added before the rows they stand for, and none is ever taken
away, so a run that dies in between leaves an index that is still complete.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators import table_state
from emporium.operators.fs import child_names, delete_paths

#: Files of an index after which it is written anew, in one go and without repeated entries.
FILES = 512
ENTRY = "name string, print long"


def key_type(struct: T.StructType, key: str) -> T.DataType | None:
    return {f.name.lower(): f.dataType for f in struct.fields}.get(key.lower())


def indexed(kind: T.DataType | None) -> bool:
    """Whether keys of this type are indexed: those whose equality is equality of the stored value, less integers, which have ranges."""
    return kind == T.StringType() or isinstance(kind, (T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType))


def _folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/_state/{name}"


def entries(df: DataFrame, partition_col: str, key: str) -> DataFrame:
    """Partition name and fingerprint of every key; null keys equal no other and have none."""
    return df.where(F.col(key).isNotNull()).select(table_state.partition_name(partition_col).alias("name"), F.xxhash64(key).alias("print")).distinct()


def create(spark: SparkSession, path: str, df: DataFrame, partition_col: str, key: str) -> str:
    """Write an index of all rows of ``df`` into a fresh folder; its name is for the state."""
    name = f"keys-{uuid.uuid4().hex}"
    entries(df, partition_col, key).write.parquet(_folder(path, name))
    return name


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(_folder(path, name))


def hits(spark: SparkSession, path: str, name: str, keys: DataFrame, key: str) -> DataFrame:
    """The index's entries with a fingerprint of ``keys``, frozen: one narrow scan of the index."""
    wanted = keys.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("print")).distinct()
    return read(spark, path, name).join(wanted, "print", "left_semi").select("name", "print").distinct().checkpoint()


def add(spark: SparkSession, path: str, name: str, new: DataFrame, known: DataFrame) -> str:
    """Add the entries of ``new`` that are not among ``known``. Returns the index's name, another one if it was written anew."""
    new.join(known, ["name", "print"], "left_anti").write.mode("append").parquet(_folder(path, name))
    if sum(n.endswith(".parquet") for n in child_names(spark, _folder(path, name))) <= FILES:
        return name
    fresh = f"keys-{uuid.uuid4().hex}"
    read(spark, path, name).distinct().write.parquet(_folder(path, fresh))
    return fresh


def drop_others(spark: SparkSession, path: str, name: str | None) -> None:
    """Delete indexes that the saved state does not name."""
    old = [n for n in child_names(spark, f"{path.rstrip('/')}/_state") if n.startswith("keys-") and n != name]
    delete_paths(spark, [_folder(path, n) for n in old])
