"""Event-time windows and keyed state as streams: against batch forms, with late rows, restarts and failures."""

import datetime as dt
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.streaming import state, windows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def write_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def bag(rows):
    return sorted(map(repr, rows))


def run_windows(spark, base, **window):
    q = windows.start_windows(spark, f"{base}/src", schema(spark), f"{base}/out", f"{base}/ck", "ts", "event_id", "10 minutes", **window)
    q.awaitTermination()
    return q


@pytest.mark.parametrize("window", [dict(width="30 minutes"), dict(width="1 hour", slide="15 minutes"), dict(gap="7 minutes")])
def test_windows_over_several_triggers_equal_the_batch(spark, tmp_out, window):
    r = random.Random(8)
    files = [[(100 * k + i, at(60 * k + r.randrange(60)), r.randrange(3), "x", r.randrange(1000) / 100) for i in range(40)]
             for k in range(4)]
    files[2] += files[2][:5]  # repeated events count once
    files[1].append((9000, None, 1, "x", 1.0))
    for rows in files:
        write_file(spark, f"{tmp_out}/src", rows)
    windows.end_stream(spark, f"{tmp_out}/src", schema(spark), "ts")
    q = run_windows(spark, tmp_out, by=["user_id"], value="value", **window)
    assert windows.late_rows(q) == 0 and len(q.recentProgress) >= 5
    whole = spark.createDataFrame([x for f in files for x in f], SCHEMA).dropDuplicates()
    want = windows.windowed(whole.where("ts IS NOT NULL"), "ts", by=["user_id"], value="value", **window)
    out = spark.read.parquet(f"{tmp_out}/out").select(*want.columns)
    assert bag(tuple(x) for x in out.collect()) == bag(tuple(x) for x in want.collect())


def test_late_rows_are_dropped_and_counted_and_a_stream_goes_on(spark, tmp_out):
    write_file(spark, f"{tmp_out}/src", [(1, at(0), 1, "x", 1.0), (2, at(100), 1, "x", 1.0)])
    write_file(spark, f"{tmp_out}/src", [(3, at(200), 1, "x", 1.0)])
    q = run_windows(spark, tmp_out, width="30 minutes")
    assert windows.late_rows(q) == 0
    closed = {r.window_start: r.n for r in spark.read.parquet(f"{tmp_out}/out").collect()}
    assert closed == {at(0): 1, at(90): 1}  # the watermark is at 190 minutes
    # another run: one row too late, one behind the latest time but ahead of the watermark
    write_file(spark, f"{tmp_out}/src", [(4, at(20), 1, "x", 1.0), (5, at(195), 1, "x", 1.0)])
    windows.end_stream(spark, f"{tmp_out}/src", schema(spark), "ts")
    q = run_windows(spark, tmp_out, width="30 minutes")
    assert windows.late_rows(q) == 1
    closed = {r.window_start: r.n for r in spark.read.parquet(f"{tmp_out}/out").collect()}
    assert closed == {at(0): 1, at(90): 1, at(180): 2}


# keyed state

EXPIRY = 30


def brute_lives(events):
    out = []
    for user in {e[2] for e in events if e[2] is not None}:
        own = sorted((e[1], e[0], e[3], round((e[4] or 0) * 100)) for e in events if e[2] == user and e[1] is not None)
        runs = []
        for e in own:
            if runs and e[0] - runs[-1][-1][0] <= dt.timedelta(minutes=EXPIRY):
                runs[-1].append(e)
            else:
                runs.append([e])
        us = lambda t: int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
        out += [(user, us(r[0][0]), us(r[-1][0]), r[-1][1], r[-1][2], len(r), sum(x[3] for x in r)) for r in runs]
    return out


def run_lives(spark, base):
    state.start_lives(spark, f"{base}/src", schema(spark), f"{base}/out", f"{base}/ck", entity="user_id", ts="ts", event_id="event_id",
                      kind="event_type", value="value", expiry_seconds=EXPIRY * 60, delay="20 minutes").awaitTermination()
    return state.lives(spark, f"{base}/out")


def some_files(n=5):
    r = random.Random(5)
    return [[(100 * k + i, at(60 * k + r.randrange(60) - r.choice([0, 0, 0, 15])), r.choice([1, 1, 1, 2, 3, 4, None]),
              r.choice("ab"), None if r.random() < 0.1 else r.randrange(1000) / 100) for i in range(14)] for k in range(n)]


def test_state_equals_the_batch_after_a_restart(spark, tmp_out):
    """Rows up to the delay out of order, a restart after two files, a run that only ends the stream."""
    files = some_files()
    for rows in files[:2]:
        write_file(spark, f"{tmp_out}/src", rows)
    half = run_lives(spark, tmp_out).select("entity", "first", "last", "last_id", "last_type", "n", "cents").collect()
    assert bag(map(tuple, half)) == bag(brute_lives([e for f in files[:2] for e in f]))
    for rows in files[2:]:
        write_file(spark, f"{tmp_out}/src", rows)
    run_lives(spark, tmp_out)
    windows.end_stream(spark, f"{tmp_out}/src", schema(spark), "ts")
    out = run_lives(spark, tmp_out)
    got = out.select("entity", "first", "last", "last_id", "last_type", "n", "cents").collect()
    assert bag(map(tuple, got)) == bag(brute_lives([e for f in files for e in f]))
    assert out.where("NOT closed").count() == 0


def test_state_survives_a_trigger_that_fails(spark, tmp_out, monkeypatch):
    files = some_files(3)
    for rows in files:
        write_file(spark, f"{tmp_out}/src", rows)
    from pyspark.sql.readwriter import DataFrameWriter
    plain, calls = DataFrameWriter.parquet, []

    def parquet(self, path, *a, **k):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    with pytest.raises(Exception):
        run_lives(spark, tmp_out)
    monkeypatch.undo()
    got = run_lives(spark, tmp_out).select("entity", "first", "last", "last_id", "last_type", "n", "cents").collect()
    assert bag(map(tuple, got)) == bag(brute_lives([e for f in files for e in f]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200)), min_size=1, max_size=40), st.integers(1, 10), st.randoms())
def test_runs_of_parts_make_the_lives_of_the_whole(events, parts, rnd):
    ev = pd.DataFrame([(e, t, i, "t", 1) for i, (e, t) in enumerate(events)], columns=["entity", "at", "id", "type", "cents"])
    own = [rnd.randrange(parts) for _ in events]
    runs = pd.concat([state.combine_runs(ev[[x == k for x in own]], 20) for k in range(parts) if k in own])
    got = []
    for e, f in runs.groupby("entity"):
        ended, life = state.fold(None, [tuple(r) for r in f.drop(columns="entity").itertuples(index=False, name=None)], 20)
        got += [(int(e), int(x[0]), int(x[1]), int(x[2]), int(x[4])) for x in [*ended, life]]
    want = []
    for e in sorted({x for x, _ in events}):
        run = []
        for t, i in sorted((t, i) for i, (x, t) in enumerate(events) if x == e):
            if run and t - run[-1][0] > 20:
                want.append((e, run[0][0], run[-1][0], run[-1][1], len(run)))
                run = []
            run.append((t, i))
        want.append((e, run[0][0], run[-1][0], run[-1][1], len(run)))
    assert sorted(got) == sorted(want)


def test_a_hot_entity_sends_a_row_a_batch(spark):
    ev = spark.range(5000).select(F.col("id").alias("event_id"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
                                  F.lit(1).alias("user_id"), F.lit("x").alias("event_type"), F.lit(1.0).alias("value"))
    runs = state._runs(ev, "user_id", "ts", "event_id", "event_type", "value", 60 * 10**6)
    assert runs.count() <= ev.rdd.getNumPartitions() * 2 and runs.agg(F.sum("n")).first()[0] == 5000


def test_many_entities_share_an_entry_of_the_store(spark, tmp_out):
    """The store's entries, and with them the calls of Python, grow with the buckets and not with the entities."""
    r = random.Random(6)
    files = [[(1000 * k + i, at(60 * k + r.randrange(60)), r.randrange(80), r.choice("ab"), r.randrange(1000) / 100) for i in range(120)]
             for k in range(4)]
    for rows in files:
        write_file(spark, f"{tmp_out}/src", rows)
    windows.end_stream(spark, f"{tmp_out}/src", schema(spark), "ts")
    q = state.start_lives(spark, f"{tmp_out}/src", schema(spark), f"{tmp_out}/out", f"{tmp_out}/ck", entity="user_id", ts="ts",
                          event_id="event_id", kind="event_type", value="value", expiry_seconds=EXPIRY * 60, delay="20 minutes",
                          buckets=3)
    q.awaitTermination()
    held = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert 1 <= max(held) <= 3 and held[-1] == 0
    out = state.lives(spark, f"{tmp_out}/out")
    got = out.select("entity", "first", "last", "last_id", "last_type", "n", "cents").collect()
    assert bag(map(tuple, got)) == bag(brute_lives([e for f in files for e in f]))
    assert out.where("NOT closed").count() == 0
