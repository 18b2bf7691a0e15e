"""Mergeable sketches, bitmap distinct counts, RANGE and GROUPS frames, hierarchies: brute force and bounds."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import bitmaps, frames, hierarchy, sketches


def bag(rows):
    return sorted(map(repr, rows))


# sketches

def test_merged_sketches_equal_the_whole_and_keep_the_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
                                    (F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("user"), (F.randn(3) * 1000).alias("v"))
    df = df.withColumn("v", F.when(F.col("id") % 97 == 0, None).otherwise(F.col("v"))) if "id" in df.columns else df
    df = df.checkpoint()
    daily = sketches.distinct_sketches(df, ["day", "g"], "user")
    merged = {r.g: r.e for r in sketches.merge_distinct(daily, ["g"]).select("g", sketches.distinct_estimate().alias("e")).collect()}
    halves = sketches.merge_distinct(sketches.distinct_sketches(df.withColumn("h", F.col("day") % 2), ["h", "g"], "user"), ["g"])
    assert merged == {r.g: r.e for r in halves.select("g", sketches.distinct_estimate().alias("e")).collect()}
    exact = {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("user").alias("n")).collect()}
    assert all(abs(merged[g] - n) <= sketches.distinct_bound() * n for g, n in exact.items())

    daily = sketches.quantile_sketches(df, ["day", "g"], "v")
    merged = sketches.merge_quantiles(daily, ["g"])
    whole = sketches.quantile_sketches(df, ["g"], "v")
    assert bag(map(tuple, merged.select("g", "sketch").collect())) == bag(map(tuple, whole.select("g", "sketch").collect()))
    values = {}
    for r in df.where("v IS NOT NULL").select("g", "v").collect():
        values.setdefault(r.g, []).append(r.v)
    qs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    for r in merged.select("g", *[sketches.quantile("sketch", q).alias(f"q{i}") for i, q in enumerate(qs)]).collect():
        own = sorted(values[r.g])
        for i, q in enumerate(qs):
            at = own[math.floor(q * (len(own) - 1))]
            assert abs(r[f"q{i}"] - at) <= (sketches.ERROR + 1e-9) * abs(at)


def test_sketches_of_hard_values(spark):
    rows = [("a", x) for x in (0.0, -0.0, 1e-300, -1e300, 5.0, 5.0, float("nan"), float("inf"), None)] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = sketches.quantile_sketches(df, ["g"], "v").select("g", *[sketches.quantile("sketch", q).alias(f"q{i}") for i, q in enumerate((0, 0.5, 1))]).collect()
    assert [r.g for r in got] == ["a"]
    assert got[0].q0 == pytest.approx(-1e300, rel=0.0101) and got[0].q1 == pytest.approx(1e-300, rel=0.0101) or got[0].q1 == 0.0
    assert got[0].q2 == pytest.approx(5.0, rel=0.0101)
    assert sketches.quantile_sketches(df.limit(0), ["g"], "v").collect() == []


# bitmaps

@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2), st.one_of(st.none(), st.integers(-130, 130))), max_size=40))
def test_distinct_counts_equal_grouping_sets(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int, u long")
    sets = bitmaps.cube_sets(["a", "b"])
    got = bitmaps.distinct_over_sets(df, ["a", "b"], "u", sets).collect()
    want = []
    for s in sets:
        groups = {}
        for a, b, u in rows:
            groups.setdefault((a if "a" in s else None, b if "b" in s else None), []).append(u)
        gid = (0 if "a" in s else 2) + (0 if "b" in s else 1)
        want += [(*k, gid, len(v), len({u for u in v if u is not None})) for k, v in groups.items()]
    assert bag(map(tuple, got)) == bag(want)


def test_raw_rows_are_not_copied_for_the_sets(spark):
    """The Generate that copies for each set stands above the aggregate of the raw rows; stored parts merge."""
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 640).alias("u"))
    out = bitmaps.distinct_over_sets(df, ["a", "b"], "u", bitmaps.rollup_sets(["a", "b"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.index("Generate explode") < plan.rindex("HashAggregate")
    assert bitmaps.words(df, [], "u").count() == 10
    parts = bitmaps.words(df.where("u < 300"), ["a"], "u").union(bitmaps.words(df.where("u >= 300"), ["a"], "u"))
    whole = bitmaps.distinct_over_sets(df, ["a"], "u", [["a"], []])
    assert bag(map(tuple, bitmaps.count_over_sets(parts, ["a"], [["a"], []]).collect())) == bag(map(tuple, whole.collect()))
    with pytest.raises(ValueError):
        bitmaps.distinct_over_sets(df, ["a"], "u", [["b"]])


# frames

def framed(rows, before, after, groups):
    out = []
    for k, t, v, i in rows:
        if t is None:
            own = []
        elif groups:
            seen = sorted({t2 for k2, t2, _, _ in rows if k2 == k and t2 is not None})
            at = seen.index(t)
            near = set(seen[max(0, at - before):at + after + 1])
            own = [v2 for k2, t2, v2, _ in rows if k2 == k and t2 in near]
        else:
            own = [v2 for k2, t2, v2, _ in rows if k2 == k and t2 is not None and t - before <= t2 <= t + after]
        own = [x for x in own if x is not None]
        out.append((k, t, v, i, sum(own) if own else None, len(own), min(own, default=None), max(own, default=None),
                    sum(own) / len(own) if own else None))
    return out


VALUES = {"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "m": ("avg", "v")}


@pytest.mark.parametrize("before,after", [(0, 0), (3, 0), (2, 5), (100, 100)])
@pytest.mark.parametrize("groups", [False, True])
def test_frames_match_brute_force(spark, before, after, groups):
    r = random.Random(6)
    rows = [(r.choice(["hot", "hot", "a", None]), r.choice([None, 7, 7, *range(-60, 60)]), r.choice([None, *range(9)]), i) for i in range(200)]
    rows += [("hot", 7, 1, 500)] * 20
    df = spark.createDataFrame(rows, "k string, t long, v long, i long").repartition(4)
    got = (frames.groups_frames(df, ["k"], "t", VALUES, before, after, num_partitions=7) if groups
           else frames.range_frames(df, ["k"], "t", VALUES, before, after)).collect()
    assert bag(map(tuple, got)) == bag(framed(rows, before, after, groups))


def test_frames_of_dates_timestamps_and_empty_tables(spark):
    df = spark.sql("SELECT date_add(DATE'2024-01-01', cast(id * id as int)) AS d, id AS v FROM range(6)")
    got = {r.v: r.s for r in frames.range_frames(df, [], "d", {"s": ("sum", "v")}, 3).collect()}
    assert got == {0: 0, 1: 1, 2: 3, 3: 3, 4: 4, 5: 5}
    ts = df.withColumn("d", F.col("d").cast("timestamp_ntz"))
    assert {r.v: r.s for r in frames.range_frames(ts, [], "d", {"s": ("sum", "v")}, 3 * 86_400_000_000).collect()} == got
    assert frames.range_frames(df.limit(0), [], "d", {"s": ("sum", "v")}, 3).collect() == []
    with pytest.raises(ValueError):
        frames.range_frames(df, [], "d", {"s": ("median", "v")}, 3)


def test_a_hot_entity_is_cut_into_cells(spark):
    """One entity has all rows: no window partition holds more than a few frames' worth of points."""
    n = 20_000
    df = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(1).alias("v"))
    points = frames._points(df, ["k"], "t", frames._parts({"s": ("sum", "v")})).withColumn("__at", F.col("t"))
    out = frames._framed(points, ["k"], {"__sum_v": ("sum", "v")}, 10, 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert any("hashpartitioning" in x and "__cell" in x for x in plan.splitlines())
    width = frames.CELL_FRAMES * 20
    assert points.groupBy(F.floor(F.col("__at") / width)).count().agg(F.max("count")).first()[0] == width
    assert out.agg(F.sum("__sum_v")).first()[0] == sum(min(n - 1, i + 10) - max(0, i - 10) + 1 for i in range(n))


# hierarchies

def closure(rows):
    nodes, value = {}, {}
    for n, p, v in rows:
        if n is None:
            continue
        if p is not None:
            nodes[n] = p if nodes.get(n) is None else min(p, nodes[n])
        nodes.setdefault(n, None)
        value[n] = (value.get(n) or 0) + v if v is not None else value.get(n)
    ups = {}
    for n in nodes:
        path, at = [], n
        while at is not None and at in nodes and at not in path:
            path.append(at)
            at = nodes[at]
        ups[n] = None if at is not None and at in path else path
    out = []
    for n in nodes:
        if ups[n] is None:
            out.append((n, None, None, None, None, True))
            continue
        below = [m for m in nodes if ups[m] is not None and n in ups[m]]
        held = [value[m] for m in below if value[m] is not None]
        out.append((n, ups[n][-1], len(ups[n]) - 1, len(below) - 1, sum(held) if held else None, False))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_closure_matches_brute_force(spark, seed):
    r = random.Random(seed)
    n = 30
    rows = [(i, r.choice([None, 99, i if r.random() < 0.1 else r.randrange(n), r.randrange(max(i, 1))]), r.choice([None, 1, 2, 5])) for i in range(n)]
    rows += [(3, 1, 7), (None, 2, 5), (40, 41, 1), (41, 42, 1), (42, 40, 1), (43, 40, 1)]
    got = hierarchy.closure_totals(spark.createDataFrame(rows, "n long, p long, v long").repartition(3), "n", "p", "v").collect()
    assert bag(map(tuple, got)) == bag(closure(rows))


def test_a_long_path_takes_a_logarithmic_number_of_rounds(spark, monkeypatch):
    n, rounds = 300, []
    from pyspark.sql.classic.dataframe import DataFrame
    plain = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, eager=True: rounds.append(1) or plain(self, eager))
    df = spark.range(n).select(F.col("id").alias("n"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.lit(1).alias("v"))
    got = {r.n: (r.root, r.depth, r.n_below, r.total) for r in hierarchy.closure_totals(df, "n", "p", "v").collect()}
    assert got == {i: (0, i, n - 1 - i, n - i) for i in range(n)}
    assert len(rounds) <= 2 + 2 * math.ceil(math.log2(n))


def test_closure_of_a_star_and_an_empty_table(spark):
    star = spark.range(1000).select(F.col("id").alias("n"), F.when(F.col("id") > 0, 0).alias("p"), F.lit(1).alias("v"))
    got = {r.n: (r.root, r.depth, r.n_below, r.total) for r in hierarchy.closure_totals(star, "n", "p", "v").collect()}
    assert got[0] == (0, 0, 999, 1000) and all(got[i] == (0, 1, 0, 1) for i in range(1, 1000))
    assert hierarchy.closure_totals(star.limit(0), "n", "p", "v").collect() == []


def test_a_task_of_a_hierarchy_has_bounded_rows(spark, monkeypatch):
    """Each round, and the numbering of the orders, shuffles into partitions by the number of rows; the session keeps its own."""
    from pyspark.sql.classic.dataframe import DataFrame
    from strata import session
    from strata.plans.registry_merge import SPARK

    from .conftest import SF_SMALL

    name, seen, plain = "spark.sql.shuffle.partitions", [], DataFrame.checkpoint
    before, n = spark.conf.get(name), spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    monkeypatch.setattr(session, "ROWS_A_TASK", n // 9)
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, eager=True: seen.append(int(spark.conf.get(name))) or plain(self, eager))
    assert SPARK["hierarchy_orders"](spark, SF_SMALL).count() == n
    assert len(seen) >= 6 and min(seen) >= 9 and spark.conf.get(name) == before
    seen.clear()
    df = spark.range(4000).select(F.col("id").alias("n"), (F.col("id") - 1).alias("p"), F.lit(1).alias("v"))
    assert hierarchy.closure_totals(df, "n", "p", "v").where("depth = n AND total = 4000 - n").count() == 4000
    assert min(seen[1:]) >= -(-4000 // (n // 9)) and spark.conf.get(name) == before
