"""As-of and interval overlap joins: brute force on hard cases, plans, and hot keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import intervals
from strata.operators.asof import asof_join, last_of_each
from strata.operators.intervals import interval_join

from .conftest import SF_SMALL


def bag(rows):
    return sorted(map(repr, rows))


def asof(left, right, forward, strict, tol):
    """left (k, t, id), right (k, t, v): the match (t, v) of each left row."""
    out = []
    for k, t, i in left:
        best = None
        for k2, t2, v in right:
            if None in (k, t, k2, t2) or k != k2:
                continue
            d = t2 - t if forward else t - t2
            if d < 0 or strict and d == 0 or tol is not None and d > tol:
                continue
            if best is None or (-d, (v is not None, v)) > (-best[0], (best[2] is not None, best[2])):
                best = (d, t2, v)
        out.append((k, t, i, best and best[1], best and best[2]))
    return out


def series(seed, n, hot):
    r = random.Random(seed)
    return [(None if r.random() < 0.05 else 7 if r.random() < hot else r.randrange(6),
             None if r.random() < 0.05 else r.randrange(40), None if r.random() < 0.1 else r.randrange(100)) for _ in range(n)]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tol", [None, 3])
def test_asof_matches_brute_force(spark, forward, strict, tol):
    left = series(1, 150, 0.4) + [(7, 5, 1)] * 30 + [(99, 1, 1)]
    right = series(2, 60, 0.4) + [(7, 5, 1), (7, 5, 9), (98, 1, 1)]
    lf = spark.createDataFrame(left, "k long, t long, id long").repartition(4)
    rf = spark.createDataFrame(right, "k long, t2 long, v long").repartition(3)
    got = asof_join(lf, rf, ["k"], "t", "t2", direction="forward" if forward else "backward", strict=strict,
                    tolerance=None if tol is None else F.lit(tol), num_partitions=9).collect()
    assert bag(tuple(r) for r in got) == bag(asof(left, right, forward, strict, tol))


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(10,2)"])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof_on_other_types_and_without_keys(spark, kind, direction):
    def at(c):
        days = F.date_add(F.lit("2020-01-01").cast("date"), F.col(c))
        return F.col(c).cast(kind) / 4 if kind == "double" else F.col(c).cast(kind) if kind[:3] == "dec" else days.cast(kind)

    lf = spark.createDataFrame([(i,) for i in (1, 5, 9, 30)], "n int").select(at("n").alias("t"), "n")
    rf = spark.createDataFrame([(i,) for i in (2, 5, 20)], "m int").select(at("m").alias("t2"), "m")
    got = {r.n: r.m for r in asof_join(lf, rf, [], "t", "t2", direction=direction, num_partitions=3).collect()}
    assert got == ({1: None, 5: 5, 9: 5, 30: 20} if direction == "backward" else {1: 2, 5: 5, 9: 20, 30: None})


def test_asof_of_empty_sides(spark):
    one, none = spark.createDataFrame([(1, 2)], "k long, t long"), spark.createDataFrame([], "k long, u long, v string")
    assert [tuple(r) for r in asof_join(one, none, ["k"], "t", "u").collect()] == [(1, 2, None, None)]
    assert asof_join(one.limit(0), none, ["k"], "t", "u").collect() == []
    with pytest.raises(ValueError, match="both sides"):
        asof_join(one, one, ["k"], "t", "t")


def test_asof_cuts_a_hot_entity(spark):
    """One entity with most rows spans many slices, rows of one time too; only the carries are windowed by entity."""
    n = 4000
    left = spark.range(n).select(F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, 50).otherwise(F.col("id") % 100).alias("t"), "id")
    right = spark.range(0, 100, 10).select(F.lit(1).alias("k"), F.col("id").alias("u"), F.col("id").alias("v"))
    out = asof_join(left, right, ["k"], "t", "u", num_partitions=16)
    assert out.where("v = floor(t / 10) * 10").count() == n
    from strata.operators.ranking import sliced
    both = left.withColumn("s", F.xxhash64(F.spark_partition_id(), "id"))
    sizes = [r["count"] for r in sliced(both, [F.col("k"), F.col("t"), F.col("s")], 16).groupBy("__slice").count().collect()]
    assert len(sizes) > 8 and max(sizes) < n / 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [last" in x and "AS __m" in x]
    assert windows and all("__slice" in x for x in windows)


def test_last_of_each_breaks_ties_by_the_columns_named(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (None, 1, "n")], "k long, a long, b string")
    assert bag(tuple(r) for r in last_of_each(df, ["k"], ["a"]).collect()) == bag([(1, 5, "b"), (None, 1, "n")])
    assert bag(tuple(r) for r in last_of_each(df, ["k"], ["b"]).collect()) == bag([(1, 4, "z"), (None, 1, "n")])


def overlaps(left, right, closed):
    top = max(x for r in (*left, *right) for x in r[1:3] if x is not None)
    out = []
    for k, s, e, i in left:
        for k2, s2, e2, j in right:
            if None in (k, s, k2, s2) or k != k2:
                continue
            a, b = (top + 2 if e is None else e), (top + 2 if e2 is None else e2)
            if (s <= a and s2 <= b and s <= b and s2 <= a) if closed else (s < a and s2 < b and s < b and s2 < a):
                out.append((k, s, e, i, s2, e2, j))
    return out


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("salt_rows", [10, 200_000])
def test_interval_join_matches_brute_force(spark, monkeypatch, closed, salt_rows):
    monkeypatch.setattr(intervals, "SALT_ROWS", salt_rows)
    r = random.Random(4)

    def rows(n):
        out = []
        for i in range(n):
            s = r.randrange(-500, 500)
            e = s + r.choice([-3, 0, 0, 1, 2, 5, 40, 300])
            out.append((r.choice([1, 1, 1, 2, None]), s if r.random() > 0.05 else None, None if r.random() < 0.05 else e, i))
        return out

    left, right = rows(120) + [(1, 7, 9, 500)] * 3, rows(90) + [(1, -10**6, 10**6, 900), (1, 0, None, 901), (1, 7, 9, 902), (1, 7, 9, 902)]
    lf = spark.createDataFrame(left, "k long, s long, e long, i long").repartition(3)
    rf = spark.createDataFrame(right, "k long, s2 long, e2 long, j long").repartition(2)
    got = interval_join(lf, rf, ("s", "e"), ("s2", "e2"), by=["k"], closed=closed).collect()
    assert bag(tuple(x) for x in got) == bag(overlaps(left, right, closed))


def test_interval_join_of_timestamps_dates_and_points(spark):
    day = dt.date(2024, 1, 1)
    points = spark.createDataFrame([(day + dt.timedelta(i), i) for i in range(10)], "at date, p long")
    spans = spark.createDataFrame([(day, day + dt.timedelta(2), "a"), (day + dt.timedelta(8), None, "b")], "f date, u date, n string")
    got = interval_join(points, spans, ("at", "at"), ("f", "u"), closed=True).collect()
    assert {(r.p, r.n) for r in got} == {(0, "a"), (1, "a"), (2, "a"), (8, "b"), (9, "b")}
    for kind in ("timestamp", "timestamp_ntz"):
        ts = spans.select(F.col("f").cast(kind).alias("f"), F.col("u").cast(kind).alias("u"), "n")
        own = points.select(F.col("at").cast(kind).alias("at"), (F.col("at").cast(kind) + F.expr("INTERVAL 1 MICROSECOND")).alias("z"), "p")
        got = interval_join(own, ts, ("at", "z"), ("f", "u")).collect()
        assert {(r.p, r.n) for r in got} == {(0, "a"), (1, "a"), (8, "b"), (9, "b")}


def test_interval_join_of_empty_sides_and_clashing_names(spark):
    one = spark.createDataFrame([(1, 2)], "a long, b long")
    none = spark.createDataFrame([], "c long, d long")
    assert interval_join(one, none, ("a", "b"), ("c", "d")).collect() == []
    assert interval_join(none, one, ("c", "d"), ("a", "b")).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        interval_join(one, one, ("a", "b"), ("a", "b"))


def test_interval_join_has_no_nested_loop_and_few_candidates(spark):
    """One interval over everything: no nested loop, and its bin's visitors are cut by salts."""
    n = 20_000
    points = spark.range(n).select("id", F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    spans = spark.range(200).select(F.col("id").alias("j"), (F.col("id") * 100).alias("c"), (F.col("id") * 100 + 10).alias("d")).union(
        spark.range(1).select(F.lit(-1), F.lit(0), F.lit(n)))
    out = interval_join(points, spans, ("a", "b"), ("c", "d"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == n + 200 * 10


def test_time_keys_read_whole_tables(spark):
    from strata.plans.registry_time import SPARK

    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert SPARK["asof_last_purchase"](spark, SF_SMALL).count() == events
    assert SPARK["interval_incidents"](spark, SF_SMALL).where("incident_id = -1").first()["n_events"] == events


def odd_events(spark, folder, n=300):
    """Equal times, times a window apart, and missing ids, users and times; some ids stand for several errors."""
    r = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(r.choice([None, -1, i, i, i, i, i % 40]), None if r.random() < 0.05 else t0 + dt.timedelta(minutes=r.randrange(90)),
             None if r.random() < 0.1 else r.randrange(12), r.choice(["error", "error", "view"]), 1.0) for i in range(n)]
    rows += [(900, t0, 1, "error", 1.0)] * 2 + [(901, t0 - dt.timedelta(microseconds=1), 1, "error", 1.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").repartition(5) \
        .write.parquet(f"{folder}/events.parquet")


def test_incidents_of_odd_events_equal_the_sql(spark, tmp_out):
    import duckdb
    from strata.plans.registry_time import ORACLE, SPARK

    odd_events(spark, tmp_out)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_out}/events.parquet/*.parquet'")
    got = SPARK["interval_incidents"](spark, tmp_out)
    assert bag(tuple(x) for x in got.select("incident_id", "n_events", "n_users").collect()) == bag(con.execute(ORACLE["interval_incidents"]).fetchall())


def test_incidents_do_not_make_pairs_with_the_square_of_the_events(spark, tmp_out, monkeypatch):
    """600 errors within ten minutes: an incident has one pair, the one over all time one for each event."""
    from strata.plans import registry_time

    n, made = 600, []
    spark.range(n).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id",
                              "'error' AS event_type", "1.0D AS value").write.parquet(f"{tmp_out}/events.parquet")
    plain = registry_time.interval_join
    monkeypatch.setattr(registry_time, "interval_join", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    got = {r.incident_id: (r.n_events, r.n_users) for r in registry_time.SPARK["interval_incidents"](spark, tmp_out).collect()}
    assert got == {-1: (n, 7)} | {i: (n - i, min(7, n - i)) for i in range(n)}
    assert sum(d.count() for d in made) == 2 * n


def test_window_counts_match_brute_force(spark):
    from strata.operators.intervals import window_counts

    r = random.Random(12)
    rows = [(None if r.random() < 0.1 else r.randrange(5), None if r.random() < 0.05 else r.randrange(-60, 60)) for _ in range(150)]
    got = window_counts(spark.createDataFrame(rows, "e long, t long").repartition(4), "t", "e", 7).collect()
    found = {a: (x.n_rows, x.n_distinct) for x in got for a in range(x.since, x.until)}
    assert len(found) == sum(x.until - x.since for x in got)
    for a in range(-80, 80):
        inside = [e for e, t in rows if t is not None and a <= t < a + 7]
        assert found.get(a, (0, 0)) == (len(inside), len({e for e in inside if e is not None}))
    assert window_counts(spark.createDataFrame([], "e long, t long"), "t", "e", 7).collect() == []


def test_open_orders_read_the_lines_once(spark, monkeypatch):
    """Levels, counts of visitors and both joins read what has been written: the lines are joined to the orders once."""
    from strata.plans import registry_time

    read, plain = [], registry_time.read_table
    monkeypatch.setattr(registry_time, "read_table", lambda spark, sf, name, *a: read.append(name) or plain(spark, sf, name, *a))
    out = registry_time.SPARK["interval_open_orders"](spark, SF_SMALL)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert read.count("lineitem") == 1 and "lineitem.parquet" not in plan and "l_shipdate" not in plan
    assert out.count() == out.where("overlap_from <= overlap_until").count() > 0
