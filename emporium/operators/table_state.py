"""State of a written Parquet table, kept beside its files in ``_state/table.json``.

* ``schema``: the table's columns. Readers state it, so a table without files
  can be read, a column added later is null in older files, and partition
  values keep the type they were written with.
* ``partitions``: for each partition its newest timestamp and, if keys are
  integers, its smallest and largest key. An incremental run takes its cutoff
  from here instead of scanning the table, and looks for existing keys only
  where they can be. The partition of null values has the name of its folder.
* ``version``: the folder that holds the table's files. A rebuild writes a
  fresh one and then saves the state, which is what makes it the table; until
  then readers see the rows as they were, or no table. Tables without it have
  their files in the table's folder itself.
* ``pending``: what a run is about to change. It is written before the data;
  if a run dies in between, the next one measures those partitions anew and
  goes back to the dead run's cutoff.
* ``buckets``: into how many hash buckets of ``key`` the files are dealt.
* ``watermark``: newest load time that a run by change capture has taken in.
* ``deltas``, ``closing`` and ``rows``: a snapshot's parts of newer open rows,
  its parts of closed rows whose versions may still lie among the open ones
  (None: any), and the rows of each part of open rows.
* ``batches``: the last micro-batch of each streaming query that was written.
* ``index``: the folder of the index of keys (``key_index.py``), for keys that
  have no range here but can be indexed.

The file is small: one short entry a partition.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators.fs import child_names, delete_paths, path_exists, read_text, write_text


#: Folder, and name in the state, of the partition whose value is null (or empty text, which Spark writes as null).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class TableState:
    schema: str
    partition_col: str | None = None
    key: str | None = None
    ts_col: str | None = None
    partitions: dict = field(default_factory=dict)   # value -> [newest ts, least key, largest key], as text
    pending: dict | None = None                      # {"cutoff": text or None, "partitions": [...]}
    version: str | None = None
    buckets: int | None = None                       # hash buckets of ``key``, for tables of operators/bucketed.py
    watermark: str | None = None
    deltas: list = field(default_factory=list)
    closing: list | None = None
    rows: dict = field(default_factory=dict)
    batches: dict = field(default_factory=dict)      # query id -> batch id
    index: str | None = None

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def newest(self) -> str | None:
        return max((p[0] for p in self.partitions.values() if p[0] is not None), default=None)

    def overlapping(self, least, largest) -> list[str]:
        """Partitions whose keys may lie between two keys: all, while a range is unknown or keys are not integers."""
        kinds = {f.name.lower(): f.dataType for f in self.struct.fields}
        if not (_integers(kinds.get(str(self.key).lower())) and isinstance(least, int) and isinstance(largest, int)):
            return list(self.partitions)
        return [name for name, (_, a, z) in self.partitions.items()
                if a is None or z is None or not (int(z) < least or int(a) > largest)]

    def widen(self, name: str, a: str | None, z: str | None) -> None:
        """Rows with keys from ``a`` to ``z`` (as :func:`measure` gives them) have come into a partition."""
        _, least, largest = self.partitions.get(name, [None, a, z])
        self.partitions[name] = [None, min((x for x in (a, least) if x is not None), key=int, default=None),
                                 max((x for x in (z, largest) if x is not None), key=int, default=None)]

    def names_nulls(self) -> bool:
        """Whether the null partition, if there is one, has its name: earlier states called it ``None``."""
        names = [*self.partitions, *(self.pending["partitions"] if self.pending else [])]
        return "None" not in names and None not in names


def _integers(kind: T.DataType | None) -> bool:
    return isinstance(kind, T.IntegralType)


def partition_name(partition_col: str) -> Column:
    """Name of a row's partition in the state, never null."""
    return F.coalesce(F.nullif(F.col(partition_col).cast("string"), F.lit("")), F.lit(NULL_PARTITION))


def in_partitions(partition_col: str, names: list[str]) -> Column:
    """Rows of the named partitions, the one of nulls among them."""
    return partition_name(partition_col).isin(names)


def _file(path: str) -> str:
    return f"{path.rstrip('/')}/_state/table.json"


def load(spark: SparkSession, path: str) -> TableState | None:
    text = read_text(spark, _file(path)) or read_text(spark, _file(path) + ".new")
    return TableState(**json.loads(text)) if text else None


def save(spark: SparkSession, path: str, state: TableState) -> None:
    write_text(spark, _file(path), json.dumps(asdict(state)))


def schema_of(df: DataFrame) -> str:
    return json.dumps(T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields]).jsonValue())


def measure(df: DataFrame, partition_col: str, key: str, ts_col: str | None) -> dict:
    """Newest timestamp and range of integer keys of each partition of ``df``: one row a partition."""
    ts = F.max(F.col(ts_col).cast("string")) if ts_col else F.lit(None).cast("string")
    known = _integers(df.select(key).schema[0].dataType)
    a, z = (f(key).cast("string") if known else F.lit(None).cast("string") for f in (F.min, F.max))
    rows = df.groupBy(partition_name(partition_col).alias("name")).agg(ts.alias("ts"), a.alias("a"), z.alias("z")).collect()
    return {r["name"]: [r.ts, r.a, r.z] for r in rows}


def location(path: str, state: TableState | None) -> str:
    """Folder of the table's files."""
    return path.rstrip("/") if state is None or state.version is None else f"{path.rstrip('/')}/{state.version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A written table with the columns its state names; without a state, what the files' merged schema says."""
    state = load(spark, path)
    if state is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(state.struct).parquet(location(path, state))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write of the table was ever finished: it has a state, or Spark's mark of success.

    A first build that failed leaves a folder with neither; that is no table.
    """
    return load(spark, path) is not None or path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def drop_other_versions(spark: SparkSession, path: str, version: str) -> None:
    """Delete files of a table that its state does not name any more."""
    old = [n for n in child_names(spark, path) if n != version and (n.startswith("v-") or "=" in n or n.endswith(".parquet") or n == "_SUCCESS")]
    delete_paths(spark, [f"{path.rstrip('/')}/{n}" for n in old])
