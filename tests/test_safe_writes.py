"""Rebuilds that fail, snapshots by changed parts, and session facts from what was loaded since."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from emporium.operators import incremental, table_state
from emporium.operators.incremental import append_absent_table, capture_table, full_refresh_table, upsert_table
from emporium.operators.snapshot import PART, read_snapshot, snapshot_frame, snapshot_table
from emporium.operators.table_state import read_table, table_exists

T = dt.datetime


def month():
    return F.date_format("ts", "yyyy-MM")


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "id long, v string, ts timestamp_ntz" + extra)


def failing(spark, rows):
    """Rows of which the last raises when it is computed."""
    df = frame(spark, rows)
    return df.withColumn("v", F.when(F.col("id") == rows[-1][0], F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))


ROWS = [(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 2, 1))]


def runs(spark, path):
    """Each way to write a table, from a frame."""
    return {"upsert": lambda df: upsert_table(spark, path, df, "id", "ts", "60 DAYS", "month", month()),
            "append": lambda df: append_absent_table(spark, path, df, "id", "month", month()),
            "refresh": lambda df: full_refresh_table(df, path, "month", month(), "id", "ts"),
            "plain": lambda df: full_refresh_table(df, path),
            "capture": lambda df: capture_table(spark, path, lambda _: df, "2024-03-01", "id", "ts", "month", month()),
            "snapshot": lambda df: snapshot_table(spark, path, df, "id", "ts", "2024-06-01 00:00:00", "r1")}


@pytest.mark.parametrize("kind", ["upsert", "append", "refresh", "plain", "capture", "snapshot"])
def test_a_first_build_that_fails_leaves_no_table(spark, scratch, kind):
    path = f"{scratch}/t"
    run = runs(spark, path)[kind]
    with pytest.raises(Exception, match="broken row"):
        run(failing(spark, ROWS))
    assert not table_exists(spark, path)
    run(frame(spark, ROWS))
    got = read_snapshot(spark, path) if kind == "snapshot" else read_table(spark, path)
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("kind", ["refresh", "plain"])
def test_a_refresh_that_fails_leaves_the_old_rows(spark, scratch, kind, monkeypatch):
    path = f"{scratch}/t"
    run = runs(spark, path)[kind]
    run(frame(spark, ROWS))
    with pytest.raises(Exception, match="broken row"):
        run(failing(spark, [(7, "x", T(2024, 1, 1)), (8, "y", T(2024, 9, 1))]))
    old = lambda: sorted((r.id, r.v) for r in read_table(spark, path).collect())
    assert old() == [(1, "a"), (2, "b")]
    # all rows are written, but the state that would name them is not
    monkeypatch.setattr(table_state, "save", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        run(frame(spark, [(9, "z", T(2024, 9, 1))]))
    monkeypatch.undo()
    assert old() == [(1, "a"), (2, "b")]
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 1
    run(frame(spark, [(9, "z", T(2024, 9, 1))]))
    assert old() == [(9, "z")] and len([n for n in os.listdir(path) if n.startswith("v-")]) == 1


@pytest.mark.parametrize("kind", ["upsert", "append"])
def test_an_incremental_run_that_fails_changes_nothing(spark, scratch, kind):
    path = f"{scratch}/t"
    run = runs(spark, path)[kind]
    run(frame(spark, ROWS))
    with pytest.raises(Exception, match="broken row"):
        run(failing(spark, [(3, "c", T(2024, 2, 2)), (4, "d", T(2024, 2, 3))]))
    assert sorted((r.id, r.v) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b")]
    run(frame(spark, [(3, "c", T(2024, 2, 2))]))
    assert sorted((r.id, r.v) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b"), (3, "c")]


def test_a_refresh_replaces_tables_of_the_old_layout(spark, scratch):
    """Files in the table's own folder, with and without a state, give way to the first version."""
    path = f"{scratch}/t"
    frame(spark, ROWS).withColumn("month", month()).write.partitionBy("month").parquet(path)
    assert table_exists(spark, path) and read_table(spark, path).count() == 2
    upsert_table(spark, path, frame(spark, [(2, "c", T(2024, 2, 2))]), "id", "ts", "60 DAYS", "month", month())
    assert sorted((r.id, r.v) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "c")]
    full_refresh_table(frame(spark, [(5, "e", T(2024, 5, 1))]), path, "month", month(), "id", "ts")
    assert [(r.id, r.v) for r in read_table(spark, path).collect()] == [(5, "e")]
    assert spark.read.parquet(path).count() == 1


# --- snapshots ------------------------------------------------------------------

def history(spark, path):
    return sorted((r.id, r.v, str(r.valid_from), str(r.valid_to)) for r in read_snapshot(spark, path).collect())


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_ino for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def days(n, changed=(), gone=(), day=1, extra=0):
    """Rows 0 to n + extra, of which some changed on a day."""
    return [(i, f"d{day}" if i in changed or i >= n else "d0", T(2024, 1, 1) + dt.timedelta(days=day if i in changed or i >= n else 0))
            for i in range(n + extra) if i not in gone]


def test_runs_write_only_what_they_change(spark, scratch):
    """One percent of the keys change each day: no file of the open rows is written again, and the history equals whole runs."""
    path, want = f"{scratch}/s", None
    source = [days(1000)]
    for day in range(1, 6):
        rows = {r[0]: r for r in source[-1]} | {r[0]: r for r in days(1000, range(day * 10, day * 10 + 10), day=day) if r[1] != "d0"}
        rows.pop(500 + day)
        rows[2000 + day] = (2000 + day, "new", T(2024, 1, 1) + dt.timedelta(days=day))
        source.append(sorted(rows.values()))
    for day, rows in enumerate(source):
        at, before = f"2024-02-{day + 1:02d} 00:00:00", files(path)
        done = snapshot_table(spark, path, frame(spark, rows).repartition(8), "id", "ts", at, f"run{day}")
        want = snapshot_frame(want, frame(spark, rows), "id", "ts", at).checkpoint()
        assert history(spark, path) == sorted((r.id, r.v, str(r.valid_from), str(r.valid_to)) for r in want.collect())
        if day:
            after = files(path)
            assert done == {"mode": "incremental", "written": 22} and all(after.get(f) == inode for f, inode in before.items())
    assert len(table_state.load(spark, path).deltas) == 5
    assert snapshot_table(spark, path, frame(spark, source[-1]), "id", "ts", "2024-03-01 00:00:00", "again") == {"mode": "incremental", "written": 0}


def test_open_rows_are_rewritten_once_much_has_changed(spark, scratch):
    path = f"{scratch}/s"
    take = lambda rows, run: snapshot_table(spark, path, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00", run)
    take(days(40), "r0")
    assert [take(days(40, range(4), day=1), "r1")["mode"], take(days(40, range(8), day=2), "r2")["mode"]] == ["incremental", "rewrite"]
    state = table_state.load(spark, path)
    assert state.deltas == [] and state.rows == {"current": 40} and state.pending is None
    assert not os.path.exists(f"{path}/{PART}=current-r1")
    assert take(days(40, range(9), day=3), "r3")["mode"] == "rewrite"
    got = history(spark, path)
    assert sum(r[3] == "None" for r in got) == 40 and len(got) == 40 + 4 + 8 + 9


def test_a_run_repeated_under_its_id_adds_to_its_parts(spark, scratch):
    path, want = f"{scratch}/s", None
    for run, rows in (("r0", days(50)), ("r1", days(50, [1], day=1)), ("r1", days(50, [1], day=1)), ("r1", days(50, [1, 2], day=2)),
                      ("r2", days(50, [1, 2], [3], day=2)), ("r2", days(50, [1, 2], [3, 4], day=2))):
        snapshot_table(spark, path, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00", run)
        want = snapshot_frame(want, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00").checkpoint()
    assert history(spark, path) == sorted((r.id, r.v, str(r.valid_from), str(r.valid_to)) for r in want.collect())


@pytest.mark.parametrize("share", [0.5, 0.0])
@pytest.mark.parametrize("dies_at", [1, 2])
@pytest.mark.parametrize("next_run", ["r1", "r2"])
def test_a_snapshot_run_that_dies_is_made_good(spark, scratch, monkeypatch, share, dies_at, next_run):
    """Dying before or after the parts are written, appending or rewriting: readers see each version once, the next run the rest."""
    path, save, calls = f"{scratch}/s", table_state.save, []
    take = lambda rows, run: snapshot_table(spark, path, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00", run, delta_share=share)
    take(days(30), "r0")
    take(days(30, [5], day=1), "r0b")

    def dies(*a):
        calls.append(1)
        if len(calls) == dies_at:
            raise OSError("gone")
        save(*a)
    later = [r if r[0] != 5 else days(30, [5], day=1)[5] for r in days(30, [1, 2], [3], day=2)]
    monkeypatch.setattr(table_state, "save", dies)
    with pytest.raises(OSError):
        take(later, "r1")
    monkeypatch.setattr(table_state, "save", save)
    seen = history(spark, path)
    assert len(seen) == len(set(seen)) and len({r[:3] for r in seen}) == len(seen)
    take(later, next_run)
    take(later, "r3")
    want = None
    for rows in (days(30), days(30, [5], day=1), later):
        want = snapshot_frame(want, frame(spark, rows), "id", "ts", "2024-06-01 00:00:00").checkpoint()
    assert history(spark, path) == sorted((r.id, r.v, str(r.valid_from), str(r.valid_to)) for r in want.collect())


def test_a_snapshot_column_that_changes_its_type(spark, scratch):
    path = f"{scratch}/s"
    schema = "id long, v {}, ts timestamp_ntz"
    old = spark.createDataFrame([(i, 1, T(2024, 1, 1)) for i in range(20)], schema.format("int"))
    new = spark.createDataFrame([(i, 1, T(2024, 1, 1)) for i in range(20)], schema.format("long"))
    snapshot_table(spark, path, old, "id", "ts", "2024-02-01 00:00:00", "r0")
    assert snapshot_table(spark, path, new, "id", "ts", "2024-02-02 00:00:00", "r1")["mode"] == "rewrite"
    assert read_snapshot(spark, path).schema["v"].dataType.simpleString() == "bigint" and read_snapshot(spark, path).count() == 20


# --- sessions ---------------------------------------------------------------------

def shop(spark, sessions, events):
    """Raw sessions and events with load days, and their staged and mapped forms."""
    from emporium.plans.intermediate import int_sessions_mapped_to_users

    raw = {"sessions": spark.createDataFrame([(s, u, T(2024, 1, d), T(2024, 1, d, 1), "x", "y", "z", T(2024, 2, loaded)) for s, u, d, loaded in sessions],
                                             "session_id string, user_id long, session_start timestamp_ntz, session_end timestamp_ntz, device_type string,"
                                             "channel string, landing_page string, _etl_loaded_at timestamp_ntz"),
           "events": spark.createDataFrame([(s, e, T(2024, 2, loaded)) for s, e, loaded in events],
                                           "session_id string, event_type string, _etl_loaded_at timestamp_ntz")}
    users = spark.createDataFrame([(1, "n", "e", "t")], "user_id long, full_name string, email string, tier string")
    return raw, int_sessions_mapped_to_users(raw["sessions"], users)


def test_late_events_reach_old_sessions(spark, scratch):
    """A session is counted again when an event of it is loaded late, however old it is; others are not looked at."""
    from emporium.plans.marketing import fct_sessions_changed, fct_sessions_full

    path = f"{scratch}/t"
    sessions = [("a", 1, 1, 1), ("b", None, 2, 1), ("c", 1, 20, 1)]
    events = [("a", "page_view", 1), ("b", "page_view", 1), ("c", "purchase", 1)]
    seen = []
    for day, more_sessions, more_events in ((1, [], []), (2, [("d", 1, 21, 2)], [("a", "purchase", 2), ("d", "page_view", 2)]), (3, [], [("b", "checkout", 3)])):
        sessions, events = sessions + more_sessions, events + more_events
        raw, mapped = shop(spark, sessions, events)

        def changed(watermark, raw=raw, mapped=mapped):
            batch = fct_sessions_changed(raw, raw, mapped, watermark)
            seen.append(sorted(r.session_id for r in batch.collect()))
            return batch
        capture_table(spark, path, changed, f"2024-02-{day:02d} 00:00:00", "session_id", "session_start", "day", F.date_format("session_start", "yyyy-MM-dd"))
        full = fct_sessions_full(mapped, raw["events"])
        assert sorted(map(str, read_table(spark, path).drop("day").collect())) == sorted(map(str, full.collect()))
    assert seen == [["a", "b", "c"], ["a", "d"], ["b"]]
    assert incremental.capture_table(spark, path, lambda w: pytest.fail("nothing new"), "2024-02-03 00:00:00", "session_id", "session_start", "day",
                                     F.date_format("session_start", "yyyy-MM-dd"))["touched"] == []


def test_session_batches_read_events_by_filter(spark, scratch):
    """Over landed tables the load time and the start of sessions are filters of the scans."""
    from emporium.plans.marketing import fct_sessions_changed, fct_sessions_since

    raw, _ = shop(spark, [("a", 1, 1, 1)], [("a", "page_view", 1)])
    landed = {}
    for name, df in raw.items():
        df.write.parquet(f"{scratch}/{name}")
        landed[name] = spark.read.parquet(f"{scratch}/{name}")
    from emporium.plans.intermediate import int_sessions_mapped_to_users
    users = spark.createDataFrame([(1, "n", "e", "t")], "user_id long, full_name string, email string, tier string")
    mapped = int_sessions_mapped_to_users(landed["sessions"], users)
    plan = fct_sessions_changed(landed, landed, mapped, "2024-02-01 00:00:00")._jdf.queryExecution().toString()
    assert plan.count("GreaterThan(_etl_loaded_at,2024-02-01T00:00)") >= 2
    plan = fct_sessions_since(landed, mapped, "2024-01-05 00:00:00")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(session_start,2024-01-05T00:00)" in plan and "LeftSemi" in plan and "NestedLoop" not in plan
