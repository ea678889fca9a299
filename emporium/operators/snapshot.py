"""Type 2 history (SCD2) with the timestamp strategy (O9; N1, N2).

First run: every source row is current from its ``updated_at``. Later runs
compare the current rows with the source by key:

* same or older ``updated_at``  -> unchanged;
* newer ``updated_at``         -> the current row closes at the new
  ``updated_at`` and a new current row opens there;
* key absent from the source   -> closed at the run time (hard delete),
  when ``invalidate_hard_deletes``;
* key new                      -> a new current row.

Duplicate keys in one source batch are reduced to one row first (newest
``updated_at``, ties to the smallest remaining columns) so history cannot
double. The comparison is one full outer join of current rows with the
source on the key - a shuffle of two dimension-sized inputs, no pairs.

A written history takes each run's changes as small parts of their own and
rewrites its open rows only when those parts have grown (``DELTA_SHARE``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.functions.macros import surrogate_key
from emporium.operators import table_state
from emporium.operators.fs import delete_paths

SCD_COLUMNS = ["scd_id", "scd_updated_at", "valid_from", "valid_to"]


def dedupe_source(source: DataFrame, key: str, updated_at: str) -> DataFrame:
    """One row a key: newest ``updated_at``, ties to the smallest other columns. The row is read off the ordering itself."""
    rest = [c for c in source.columns if c not in (key, updated_at)]
    neg = F.timestamp_diff("MICROSECOND", F.col(updated_at), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    order = F.struct(neg.alias("__neg"), *[F.col(c).alias(f"__r{i}") for i, c in enumerate(rest)], F.col(updated_at).alias("__at"))
    named = {key: F.col(key), updated_at: F.col("__b.__at")} | {c: F.col(f"__b.__r{i}") for i, c in enumerate(rest)}
    return (source.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("__b"))
            .select(*[named[c].alias(c) for c in source.columns]))


def _open_rows(src: DataFrame, key: str, updated_at: str) -> DataFrame:
    return src.select(*src.columns,
                      surrogate_key(key, updated_at).alias("scd_id"),
                      F.col(updated_at).alias("scd_updated_at"),
                      F.col(updated_at).alias("valid_from"),
                      F.lit(None).cast(src.schema[updated_at].dataType).alias("valid_to"))


def snapshot_frame(existing: DataFrame | None, source: DataFrame, key: str, updated_at: str,
                   run_ts: Column | str, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The whole history table after one snapshot run."""
    src = dedupe_source(source, key, updated_at)
    if existing is None:
        return _open_rows(src, key, updated_at)
    existing, src = _same_columns(existing, src)
    kept_or_closed, opened = _compared(existing.where(F.col("valid_to").isNull()), src, key, updated_at, run_ts, invalidate_hard_deletes)
    closed = existing.where(F.col("valid_to").isNotNull())
    return closed.select(*src.columns, *SCD_COLUMNS).unionByName(kept_or_closed).unionByName(opened)


def snapshot_changes(current: DataFrame, source: DataFrame, key: str, updated_at: str,
                     run_ts: Column | str, invalidate_hard_deletes: bool = True) -> DataFrame:
    """Only what one run changes: the open rows that close, with their ``valid_to``, and the rows it opens."""
    current, src = _same_columns(current, dedupe_source(source, key, updated_at))
    kept_or_closed, opened = _compared(current, src, key, updated_at, run_ts, invalidate_hard_deletes)
    return kept_or_closed.where(F.col("valid_to").isNotNull()).unionByName(opened)


def _same_columns(existing: DataFrame, src: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of either: new ones are null in older versions, gone ones in newer; types follow the source."""
    have = {f.name: f.dataType for f in src.schema.fields}
    for f in existing.schema.fields:
        if f.name not in have and f.name not in SCD_COLUMNS:
            src = src.withColumn(f.name, F.lit(None).cast(f.dataType))
    for name, kind in have.items():
        existing = existing.withColumn(name, F.col(name).cast(kind) if name in existing.columns else F.lit(None).cast(kind))
    return existing, src


def _compared(current: DataFrame, src: DataFrame, key: str, updated_at: str, run_ts: Column | str,
              invalidate_hard_deletes: bool) -> tuple[DataFrame, DataFrame]:
    """The open rows after the run, with the end of those that close, and the rows that open."""
    run = F.lit(run_ts).cast("timestamp_ntz") if isinstance(run_ts, str) else run_ts
    cols = src.columns
    s = src.select(*[F.col(c).alias(f"__s_{c}") for c in cols])
    j = current.join(s, current[key] == s[f"__s_{key}"], "full_outer")
    has_cur, has_src = F.col(key).isNotNull(), F.col(f"__s_{key}").isNotNull()
    changed = has_cur & has_src & (F.col(f"__s_{updated_at}") > F.col("scd_updated_at"))
    deleted = has_cur & ~has_src
    end = (F.when(changed, F.col(f"__s_{updated_at}"))
           .when(deleted & F.lit(invalidate_hard_deletes), run))
    kept_or_closed = j.where(has_cur).select(
        *cols, "scd_id", "scd_updated_at", "valid_from", end.alias("valid_to"))
    opened = _open_rows(
        j.where(has_src & (~has_cur | changed)).select(*[F.col(f"__s_{c}").alias(c) for c in cols]),
        key, updated_at)
    return kept_or_closed, opened


PART = "scd_part"
#: Rows opened since the open rows were last rewritten, as a share of these, above which a run rewrites them again.
DELTA_SHARE = 0.2


def snapshot_table(spark: SparkSession, path: str, source: DataFrame, key: str, updated_at: str,
                   run_ts: str, run_id: str, invalidate_hard_deletes: bool = True, delta_share: float = DELTA_SHARE) -> dict:
    """Apply one run to a Parquet history table partitioned by ``scd_part``.

    ``current`` holds the open rows as last rewritten, ``current-<run_id>``
    those that a run of this id opened since, ``closed-<run_id>`` those it
    closed. A version that is closed there may still lie among the open rows;
    readers take it as closed. So a run writes the rows it changes and no
    others, until the rows opened since make up more than ``delta_share`` of
    ``current`` (or a column changes its type); then it rewrites ``current``
    without what is closed, and the parts since are deleted.

    The state lists the parts of open rows, and names what a run is writing
    before it does. A run that dies leaves versions closed whose successors
    are not there yet, or copies of open rows, which readers drop; the next
    run, of this or another id, opens what is missing. A run repeated under
    its id adds to what it wrote before. Closed rows are never touched again.
    """
    if not table_state.table_exists(spark, path):
        first = snapshot_frame(None, source, key, updated_at, run_ts, invalidate_hard_deletes).withColumn(PART, F.lit("current"))
        first.write.mode("overwrite").partitionBy(PART).parquet(path)
        state = table_state.TableState(table_state.schema_of(first), PART, closing=[])
        state.rows = {"current": spark.read.schema(state.struct).parquet(path).count()}
        table_state.save(spark, path, state)
        return {"mode": "first"}
    state = table_state.load(spark, path) or table_state.TableState(table_state.schema_of(table_state.read_table(spark, path)), PART)
    table = table_state.read_table(spark, path)
    closed_part, open_part = f"closed-{run_id}", f"current-{run_id}"
    current = _open(table, state)
    out = snapshot_changes(current.drop(PART), source, key, updated_at, run_ts, invalidate_hard_deletes).checkpoint()
    counts = {r.open: r.n for r in out.groupBy(F.col("valid_to").isNull().alias("open")).agg(F.count("*").alias("n")).collect()}
    closes, opens = counts.get(False, 0), counts.get(True, 0)
    before = {f.name: f.dataType for f in state.struct.fields}
    retyped = any(before.get(f.name, f.dataType) != f.dataType for f in out.schema.fields)
    base, since = state.rows.get("current"), sum(n for part, n in state.rows.items() if part != "current") + opens
    rewrite = base is None or retyped or since > delta_share * base
    state.schema = table_state.schema_of(out.withColumn(PART, F.lit("")))  # names every old column too, so both versions can be read with it
    if not closes and not opens and not retyped and not state.pending:
        table_state.save(spark, path, state)
        return {"mode": "incremental", "written": 0}
    if state.closing is not None:
        state.closing = sorted({*state.closing, closed_part, *(state.pending["partitions"] if state.pending else [])})
    state.pending = {"cutoff": None, "partitions": [closed_part]}
    closed_now = out.where(F.col("valid_to").isNotNull())
    own_closed = table.where(F.col(PART) == closed_part).drop(PART)
    gone = closed_now.select("scd_id")
    if rewrite:
        kept = _same_columns(current.drop(PART), source)[0].join(gone, "scd_id", "left_anti").unionByName(
            out.where(F.col("valid_to").isNull()), allowMissingColumns=True)
        parts = [(closed_part, own_closed.unionByName(closed_now, allowMissingColumns=True), closes),
                 ("current", kept, 1)]
    else:
        own_open = current.where(F.col(PART) == open_part).drop(PART).join(gone, "scd_id", "left_anti")
        parts = [(closed_part, own_closed.unionByName(closed_now, allowMissingColumns=True), closes),
                 (open_part, own_open.unionByName(out.where(F.col("valid_to").isNull()), allowMissingColumns=True), opens)]
    # both are computed before either is written: each is read from files that the other replaces
    parts = [(part, rows.select(*out.columns).withColumn(PART, F.lit(part)).checkpoint()) for part, rows, changed in parts if changed]
    table_state.save(spark, path, state)
    for part, rows in parts:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
        if part != closed_part:
            state.rows[part] = rows.count()
    if rewrite:
        if not state.rows["current"]:
            delete_paths(spark, [f"{path}/{PART}=current"])
        delete_paths(spark, [f"{path}/{PART}={p}" for p in state.deltas])
        state.rows, state.deltas, state.closing = {"current": state.rows["current"]}, [], [closed_part]
    elif opens:
        state.deltas = sorted({*state.deltas, open_part})
    state.pending = None
    table_state.save(spark, path, state)
    return {"mode": "rewrite" if rewrite else "incremental", "written": closes + opens}


def _open(table: DataFrame, state: table_state.TableState | None) -> DataFrame:
    """Open rows: those of the listed parts whose version is not closed elsewhere, each once."""
    deltas = state.deltas if state else []
    rows = table.where(F.col(PART).isin(["current", *deltas]))
    closed = table.where(F.col("valid_to").isNotNull() & F.col(PART).startswith("closed-"))
    if state is not None and state.closing is not None:
        closed = closed.where(F.col(PART).isin([*state.closing, *(state.pending["partitions"] if state.pending else [])]))
    rows = rows.join(closed.select("scd_id").distinct(), "scd_id", "left_anti")
    return rows.dropDuplicates(["scd_id"]) if state is not None and state.pending else rows


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    state, table = table_state.load(spark, path), table_state.read_table(spark, path)
    columns = [c for c in table.columns if c != PART]
    return table.where(F.col(PART).startswith("closed-")).select(columns).unionByName(_open(table, state).select(columns))
