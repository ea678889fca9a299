"""Existing keys are looked for only in the partitions that the index of keys names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporium.operators import key_index, table_state
from emporium.operators.incremental import append_absent_table, full_refresh_table, upsert_table
from emporium.operators.table_state import read_table

T = dt.datetime
MONTH = "date_format(ts, 'yyyy-MM')"


def frame(spark, rows, kind="string"):
    return spark.createDataFrame(rows, "id string, v string, ts timestamp_ntz").withColumn("id", F.col("id").cast(kind))


def append(spark, path, df):
    return append_absent_table(spark, path, df, "id", "month", F.expr(MONTH))


def upsert(spark, path, df, lookback="900 DAYS"):
    return upsert_table(spark, path, df, "id", "ts", lookback, "month", F.expr(MONTH))


def got(spark, path):
    return sorted((str(r.id), r.v, r.month) for r in read_table(spark, path).collect())


def year(n=12, each=5):
    """Keys whose order says nothing about their month."""
    return [(str((m * 7 + k * 31) % 97 + k / 4), "a", T(2024, m + 1, 1 + k)) for m in range(n) for k in range(each)]


@pytest.mark.parametrize("kind", ["string", "decimal(10,2)"])
def test_only_partitions_with_a_key_are_searched(spark, scratch, kind):
    rows, path = year(), f"{scratch}/t"
    append(spark, path, frame(spark, rows, kind))
    again = append(spark, path, frame(spark, [rows[0], (rows[1][0], "b", T(2025, 3, 3)), ("1000.75", "n", T(2025, 1, 1))], kind))
    assert again["searched"] == ["2024-01"]
    assert append(spark, path, frame(spark, [("1000.75", "x", T(2025, 2, 1))], kind))["searched"] == ["2025-01"]
    assert append(spark, path, frame(spark, [("2000.75", "x", T(2025, 2, 1))], kind))["searched"] == []
    want = sorted((str(r.id), "a", f"{r.ts:%Y-%m}") for r in frame(spark, rows, kind).collect())
    assert got(spark, path) == sorted(want + [("1000.75", "n", "2025-01"), ("2000.75", "x", "2025-02")])


def test_an_upsert_finds_rows_in_far_partitions(spark, scratch):
    rows, path = year(), f"{scratch}/t"
    upsert(spark, path, frame(spark, rows))
    key, month = rows[7][0], f"{rows[7][2]:%Y-%m}"
    done = upsert(spark, path, frame(spark, [(key, "moved", T(2025, 1, 1))]))
    assert done["searched"] == [month] and done["touched"] == [month, "2025-01"]
    # its entry of the old month stays: a look in vain, and the same rows
    done = upsert(spark, path, frame(spark, [(key, "again", T(2025, 2, 1))]))
    assert done["searched"] == [month, "2025-01"] and done["touched"] == ["2025-01", "2025-02"]
    kept = [(k, v, f"{t:%Y-%m}") for k, v, t in rows if k != key]
    assert got(spark, path) == sorted(kept + [(key, "again", "2025-02")])


def test_a_shared_fingerprint_costs_only_a_look(spark, scratch, monkeypatch):
    """All keys with one fingerprint: every partition is searched and the result is the same."""
    rows, path = year(4), f"{scratch}/t"
    real = F.xxhash64
    monkeypatch.setattr(key_index.F, "xxhash64", lambda *c: real(*c) * 0)
    append(spark, path, frame(spark, rows))
    done = append(spark, path, frame(spark, [rows[0], ("new", "n", T(2024, 1, 9))]))
    assert done["searched"] == [f"2024-0{m}" for m in range(1, 5)]
    assert got(spark, path) == sorted([(k, v, f"{t:%Y-%m}") for k, v, t in rows] + [("new", "n", "2024-01")])


def test_null_keys_and_null_partitions(spark, scratch):
    path = f"{scratch}/t"
    append(spark, path, frame(spark, [("a", "1", None), (None, "2", T(2024, 1, 1))]))
    done = append(spark, path, frame(spark, [("a", "3", T(2024, 1, 1)), (None, "4", T(2024, 1, 1))]))
    assert done["searched"] == [table_state.NULL_PARTITION]
    assert [v for _, v, _ in got(spark, path)] == ["2", "4", "1"]  # a null key equals no other


def test_runs_that_die_leave_a_complete_index(spark, scratch, monkeypatch):
    """Entries come before rows: after a crash between the two the rows are written by the next run, once."""
    path, rows = f"{scratch}/t", year(2)
    append(spark, path, frame(spark, rows))
    new = [("x", "n", T(2024, 5, 1))]
    with monkeypatch.context() as m:
        m.setattr("emporium.operators.incremental._before", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            append(spark, path, frame(spark, new))
    for _ in range(2):
        append(spark, path, frame(spark, new))
    assert got(spark, path) == sorted([(k, v, f"{t:%Y-%m}") for k, v, t in rows] + [("x", "n", "2024-05")])


def test_the_index_is_rebuilt(spark, scratch, monkeypatch):
    """For tables from before, for keys of another type, after a refresh, and when it has many files."""
    path, rows = f"{scratch}/t", [("1", "a", T(2024, 1, 1)), ("2", "a", T(2024, 2, 1))]
    upsert(spark, path, frame(spark, rows))
    state = table_state.load(spark, path)
    state.index = None
    table_state.save(spark, path, state)
    assert upsert(spark, path, frame(spark, [("2", "b", T(2024, 2, 2))]))["searched"] == ["2024-02"]
    upsert(spark, path, frame(spark, [("1", "c", T(2024, 3, 1))], "decimal(5,0)"))
    assert table_state.load(spark, path).index is None
    assert upsert(spark, path, frame(spark, [("1", "d", T(2024, 3, 2))], "decimal(5,0)"))["searched"] == ["2024-03"]
    full_refresh_table(frame(spark, rows), path, "month", F.expr(MONTH), "id", "ts")
    monkeypatch.setattr(key_index, "FILES", 0)
    before = table_state.load(spark, path).index
    append_absent_table(spark, path, frame(spark, [("2", "z", T(2024, 9, 1)), ("3", "a", T(2024, 4, 1))]), "id", "month", F.expr(MONTH))
    after = table_state.load(spark, path).index
    assert after != before and key_index.child_names(spark, f"{path}/_state").count(before) == 0
    assert key_index.read(spark, path, after).count() == 3
    assert got(spark, path) == [("1", "a", "2024-01"), ("2", "a", "2024-02"), ("3", "a", "2024-04")]
