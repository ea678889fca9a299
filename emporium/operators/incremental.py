"""Incremental materialisation: delete+insert with lookback (O7/O10),
append-if-absent (O8), schema sync (O6) and full refresh (O3/O4).

Two layers:

* frame functions (``lookback_batch``, ``upsert_frame``, ``append_absent_frame``)
  are lazy and side-effect free - the registered queries use them;
* table functions (``upsert_table``, ``append_absent_table``) apply them to a
  Parquet table partitioned by a creation period and rewrite only the
  partitions the batch touches.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporium.operators import key_index, table_state
from emporium.operators.fs import delete_paths


def sync_columns(target: DataFrame, like: DataFrame) -> DataFrame:
    """Reshape ``target`` to the columns of ``like`` (O6, sync all columns):
    columns new in ``like`` appear as nulls, columns gone from it are dropped."""
    have = set(target.columns)
    return target.select(*[
        F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in like.schema.fields])


def lookback_cutoff(target: DataFrame, ts_col: str, lookback: str) -> DataFrame:
    """One row: ``max(target.ts) - lookback`` (null when the target is empty)."""
    return target.agg((F.max(ts_col) - F.expr(f"INTERVAL {lookback}")).alias("__cutoff"))


def lookback_batch(source: DataFrame, target: DataFrame, ts_col: str, lookback: str,
                   max_ts: Column | None = None) -> DataFrame:
    """Source rows with ``ts >= max(target.ts) - lookback``.

    The cutoff is a one-row aggregate joined in (a one-row broadcast is
    bounded by construction), never collected. An empty target gives a null
    cutoff and therefore an empty batch, as the warehouse does. ``max_ts``
    optionally ignores target rows beyond a sanity horizon (default off).
    """
    t = target if max_ts is None else target.where(F.col(ts_col) <= max_ts)
    cut = lookback_cutoff(t, ts_col, lookback)
    return (source.join(F.broadcast(cut), F.col(ts_col) >= F.col("__cutoff"), "inner")
            .drop("__cutoff"))


def upsert_frame(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """delete+insert: target rows whose key is in the batch are replaced by
    the batch rows (a duplicate key in the batch keeps all its rows)."""
    kept = sync_columns(target, batch).join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch)


def append_absent_frame(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``target`` (existing rows never change)."""
    return source.join(target.select(key), key, "left_anti")


def incremental_model(target: DataFrame | None, source: DataFrame, key: str, ts_col: str,
                      lookback: str) -> DataFrame:
    """The whole model after one run: full build when there is no target."""
    if target is None:
        return source
    return upsert_frame(target, lookback_batch(source, target, ts_col, lookback), key)


# ------------------------------------------------------------------ tables
def full_refresh_table(df: DataFrame, path: str, partition_col: str | None = None,
                       partition_expr: Column | None = None, key: str | None = None,
                       ts_col: str | None = None, stamp: tuple[str, int] | None = None) -> None:
    """O3/O4: rebuild the table from scratch and describe it in its state file.

    The rows go to a fresh version folder; saving the state, which names that
    folder, is what replaces the table. A rebuild that fails before leaves
    the old rows as they were, and a first build that fails leaves no table.
    The folders of older versions are deleted after the switch, so a reader
    that planned on one of them before has to plan again, as after any
    overwrite. A table of no rows is a table too: its state has the schema.
    ``stamp`` is the stream and micro-batch that the rows come from.
    """
    if partition_col is not None and partition_col not in df.columns:
        df = df.withColumn(partition_col, partition_expr.cast("string"))
    spark, version = df.sparkSession, table_state.new_version()
    state = table_state.TableState(table_state.schema_of(df), partition_col, key, ts_col, version=version)
    _stamp(state, stamp)
    files = table_state.location(path, state)
    try:
        (df.write.partitionBy(partition_col) if partition_col else df.write).parquet(files)
        if partition_col and key:
            rows = spark.read.schema(state.struct).parquet(files)
            state.partitions = table_state.measure(rows, partition_col, key, ts_col)
            if key_index.indexed(key_index.key_type(state.struct, key)):
                state.index = key_index.create(spark, path, rows, partition_col, key)
        table_state.save(spark, path, state)
    except Exception:
        now = table_state.load(spark, path)
        if now is None or now.version != version:  # unless the state was saved after all
            delete_paths(spark, [files])
            key_index.drop_others(spark, path, now.index if now else None)
        raise
    table_state.drop_other_versions(spark, path, version)
    key_index.drop_others(spark, path, state.index)


def _stamp(state: table_state.TableState, stamp: tuple[str, int] | None) -> None:
    """Note a micro-batch as written; saved with the state that completes the write."""
    if stamp is not None:
        state.batches = {**state.batches, stamp[0]: stamp[1]}


def already_written(spark: SparkSession, path: str, stamp: tuple[str, int]) -> bool:
    """Whether the table holds this micro-batch, or a later one, of the stream: one look at the state, none at the data."""
    state = table_state.load(spark, path)
    return state is not None and state.batches.get(stamp[0], -1) >= stamp[1]


def _opened(spark: SparkSession, path: str, key: str, ts_col: str | None, partition_col: str) -> table_state.TableState:
    """State of a table to be changed; what is missing in it, or was being changed by a run that died, is measured."""
    state = table_state.load(spark, path)
    target = table_state.read_table(spark, path)
    if state is None:
        target = target.withColumn(partition_col, F.col(partition_col).cast("string"))
        state = table_state.TableState(table_state.schema_of(target), partition_col, key, ts_col)
        state.partitions = table_state.measure(target, partition_col, key, ts_col)
    elif state.key != key or state.ts_col != ts_col or not state.names_nulls():
        state.index = state.index if state.key == key else None
        state.key, state.ts_col = key, ts_col
        state.partitions = table_state.measure(target, partition_col, key, ts_col)
    elif state.pending:
        dirty = state.pending["partitions"]
        found = table_state.measure(target.where(table_state.in_partitions(partition_col, dirty)), partition_col, key, ts_col)
        state.partitions = {k: v for k, v in state.partitions.items() if k not in dirty} | found
    if state.index is None and key_index.indexed(key_index.key_type(state.struct, key)):
        state.index = key_index.create(spark, path, target, partition_col, key)
        table_state.save(spark, path, state)
        key_index.drop_others(spark, path, state.index)
    return state


def _may_hold(spark: SparkSession, path: str, state: table_state.TableState, rows: DataFrame, key: str) -> tuple[list[str], DataFrame | None]:
    """Partitions that may hold keys of ``rows``, by the range of integers or the index of other keys; and the index's entries met."""
    if state.index is not None and key_index.key_type(rows.schema, key) == key_index.key_type(state.struct, key):
        known = key_index.hits(spark, path, state.index, rows, key)
        return [r[0] for r in known.select("name").distinct().collect() if r[0] in state.partitions], known
    return state.overlapping(*rows.agg(F.min(key), F.max(key)).first()), None


def _index_rows(spark: SparkSession, path: str, state: table_state.TableState, rows: DataFrame, key: str, partition_col: str,
                known: DataFrame | None) -> None:
    """Add rows that are about to be written to the index; one of keys of another type is given up, and built anew by the next run."""
    if state.index is None:
        return
    if key_index.key_type(rows.schema, key) != key_index.key_type(state.struct, key):
        state.index = None
        return
    known = known if known is not None else key_index.hits(spark, path, state.index, rows, key)
    state.index = key_index.add(spark, path, state.index, key_index.entries(rows, partition_col, key), known)


def _same_layout(old: T.StructType, new: DataFrame) -> bool:
    """Whether old files can be read as ``new``: no column gone, none of another type."""
    types = {f.name: f.dataType for f in new.schema.fields}
    return all(types.get(f.name) == f.dataType for f in old.fields)


def upsert_table(spark: SparkSession, path: str, source: DataFrame | Callable[[str | None], DataFrame], key: str, ts_col: str,
                 lookback: str, partition_col: str, partition_expr: Column, stamp: tuple[str, int] | None = None) -> dict:
    """Apply one delete+insert run to a partitioned Parquet table.

    ``source`` is the model, or a function of the cutoff (text) that builds
    the model from it, so that the filter can reach the scans below joins.

    1. The cutoff is the newest timestamp in the table's state less the
       lookback; no scan. An empty table has none and gets no rows.
    2. The batch is checkpointed (reliable, in the shared folder), so retries
       after a lost executor re-read it.
    3. Rows to be replaced can only lie in partitions whose key range meets
       the batch's, or, unless keys are integers, for which the index of keys
       knows one of the batch (``key_index.py``); their keys are semi-joined.
       The touched partitions are a short list.
    4. The touched partitions, less the batch's keys, plus the batch, are
       checkpointed and written with dynamic partition overwrite; partitions
       that end up empty are deleted, because dynamic overwrite leaves them.
       The state file notes the run before it changes data and is brought up
       to date after, so a run that died in between is made good by the next.

    Columns follow the batch (O6): new ones are null in older rows, and if
    one is gone or changes its type every partition is rewritten without it,
    so that its old values cannot come back later.
    """
    whole = source if callable(source) else (lambda cutoff: source if cutoff is None else source.where(F.col(ts_col) >= F.lit(cutoff).cast("timestamp_ntz")))
    if not table_state.table_exists(spark, path):
        full_refresh_table(whole(None), path, partition_col, partition_expr, key, ts_col, stamp)
        return {"mode": "full", "touched": None}
    state = _opened(spark, path, key, ts_col, partition_col)
    _stamp(state, stamp)
    newest = state.newest()
    if newest is None and not state.pending:
        if stamp is not None:
            table_state.save(spark, path, state)
        return {"mode": "incremental", "touched": [], "cutoff": None}
    cutoff = None
    if newest is not None:
        one = spark.range(1).select((F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {lookback}")).cast("string")).first()
        cutoff = one[0]
    if state.pending and state.pending["cutoff"] is not None:
        cutoff = min(x for x in (cutoff, state.pending["cutoff"]) if x is not None)
    batch = whole(cutoff).where(F.col(ts_col) >= F.lit(cutoff).cast("timestamp_ntz"))
    done = _merge(spark, path, state, batch, key, ts_col, partition_col, partition_expr, cutoff)
    return {"mode": "incremental", "cutoff": cutoff} | done


def _before(spark: SparkSession, path: str, state: table_state.TableState, pending: dict) -> None:
    """Note what a run is about to change, with the micro-batches that are complete by now and not the one being written."""
    done = table_state.load(spark, path)
    state.pending = pending
    table_state.save(spark, path, dataclasses.replace(state, batches=done.batches if done else {}))


def _merge(spark: SparkSession, path: str, state: table_state.TableState, batch: DataFrame, key: str, ts_col: str | None,
           partition_col: str, partition_expr: Column, cutoff: str | None) -> dict:
    """Steps 2 to 4 of :func:`upsert_table`: replace the rows of the batch's keys by the batch."""
    batch = batch.withColumn(partition_col, partition_expr.cast("string")).checkpoint()
    if batch.isEmpty():
        if not state.pending:
            table_state.save(spark, path, state)
        return {"touched": []}
    target = table_state.read_table(spark, path)
    name, searched, known = table_state.partition_name(partition_col), sorted(state.partitions), None
    if _same_layout(state.struct, batch):
        searched, known = _may_hold(spark, path, state, batch, key)
        near = target.where(table_state.in_partitions(partition_col, searched))
        moved_from = near.select(key, partition_col).join(batch.select(key), key, "left_semi").select(name)
        touched = [r[0] for r in batch.select(name).union(moved_from).distinct().collect()]
    else:
        touched = sorted(set(state.partitions) | {r[0] for r in batch.select(name).distinct().collect()})
    rewritten = (sync_columns(target.where(table_state.in_partitions(partition_col, touched)), batch)
                 .join(batch.select(key), key, "left_anti")
                 .unionByName(batch)).checkpoint()
    _index_rows(spark, path, state, batch, key, partition_col, known)
    _before(spark, path, state, {"cutoff": cutoff, "partitions": touched})
    files = table_state.location(path, state)
    (rewritten.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(files))
    present = table_state.measure(rewritten, partition_col, key, ts_col)
    emptied = [p for p in touched if p not in present]
    delete_paths(spark, [f"{files}/{partition_col}={p}" for p in emptied])
    state.partitions = {k: v for k, v in state.partitions.items() if k not in touched} | present
    state.schema, state.pending = table_state.schema_of(batch), None
    table_state.save(spark, path, state)
    key_index.drop_others(spark, path, state.index)
    return {"touched": sorted(map(str, touched)), "emptied": emptied, "searched": sorted(searched)}


def capture_table(spark: SparkSession, path: str, changed: Callable[[str | None], DataFrame], loaded_until: str, key: str, ts_col: str,
                  partition_col: str, partition_expr: Column) -> dict:
    """Delete+insert by change capture: rows whose inputs were loaded since the last run replace those of the same key.

    ``changed`` builds the rows (whole rows of the model) that anything
    loaded after a watermark, given as text, has a part in; with None it
    builds them all. ``loaded_until`` is the newest load time of the inputs;
    it becomes the watermark once the rows are written, so a run that dies is
    made good by the next, from the same watermark.
    """
    state = table_state.load(spark, path)
    if state is None or state.watermark is None:
        full_refresh_table(changed(None), path, partition_col, partition_expr, key, ts_col)
        state = table_state.load(spark, path)
        done = {"mode": "full", "touched": None}
    else:
        state = _opened(spark, path, key, ts_col, partition_col)
        if loaded_until <= state.watermark and not state.pending:
            return {"mode": "incremental", "touched": []}
        done = {"mode": "incremental"} | _merge(spark, path, state, changed(state.watermark), key, ts_col, partition_col, partition_expr, None)
    state.watermark = max(loaded_until, state.watermark or loaded_until)
    table_state.save(spark, path, state)
    return done


def append_absent_table(spark: SparkSession, path: str, source: DataFrame, key: str,
                        partition_col: str, partition_expr: Column, stamp: tuple[str, int] | None = None) -> dict:
    """O8: append source rows whose key is absent; existing rows never change.

    Keys are looked up only in partitions whose key range meets the source's,
    or, unless keys are integers, for which the index of keys knows one of them.
    The new rows are checkpointed before the append, so a retried write sees
    the same rows; a rerun finds them present and appends nothing.
    """
    if not table_state.table_exists(spark, path):
        full_refresh_table(source, path, partition_col, partition_expr, key, stamp=stamp)
        return {"mode": "full"}
    state = _opened(spark, path, key, None, partition_col)
    _stamp(state, stamp)
    target = table_state.read_table(spark, path)
    searched, known = _may_hold(spark, path, state, source, key)
    near = target.where(table_state.in_partitions(partition_col, searched))
    new = (append_absent_frame(near, source, key)
           .withColumn(partition_col, partition_expr.cast("string")))
    # columns the table does not have yet stay null in its older rows; columns it has and the source lacks are null in the new
    added = [f for f in new.schema.fields if f.name not in state.struct.names]
    columns = [F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in state.struct.fields]
    new = new.select(*columns, *[F.col(f.name) for f in added]).checkpoint()
    found = table_state.measure(new, partition_col, key, None)
    if not found:
        if stamp is not None and not state.pending:
            table_state.save(spark, path, state)
        return {"mode": "incremental", "searched": sorted(searched)}
    _index_rows(spark, path, state, new, key, partition_col, known)
    if added:
        state.schema = table_state.schema_of(new)
    _before(spark, path, state, {"cutoff": None, "partitions": sorted(found)})
    new.write.mode("append").partitionBy(partition_col).parquet(table_state.location(path, state))
    for name, (_, a, z) in found.items():
        state.widen(name, a, z)
    state.pending = None
    table_state.save(spark, path, state)
    key_index.drop_others(spark, path, state.index)
    return {"mode": "incremental", "searched": sorted(searched)}
