"""Version differences and semi-structured rows: brute force, files read, malformed texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.sources import nested, versions

SCHEMA = "k long, p string, v long, t string"


def bag(rows):
    return sorted(map(repr, rows))


def except_all(old, new):
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    both = {r[0] for r in gone} & {r[0] for r in came}
    return ([(*r, "changed_from" if r[0] in both else "removed", n) for r, n in gone.items()]
            + [(*r, "changed_to" if r[0] in both else "added", n) for r, n in came.items()])


def some_rows(seed):
    r = random.Random(seed)
    return [(r.choice([None, *range(40)]), r.choice(["a", "b", "c d", "", None]), r.choice([None, 0, 1]), r.choice([None, "", "x"])) for _ in range(150)]


def write(spark, rows, path, **k):
    versions.write_version(spark.createDataFrame(rows, SCHEMA).repartition(3), path, ["k"], "p", **k)


def test_difference_equals_except_all_both_ways(spark, tmp_out):
    old = some_rows(1) + [(7, "a", 1, "x")] * 3
    new = [r for i, r in enumerate(old) if i % 11] + [(7, "a", 1, "x"), (100, "zz", 1, "x"), (7, "b", 5, "y")] + some_rows(2)[:9]
    write(spark, old, f"{tmp_out}/1")
    write(spark, new, f"{tmp_out}/2")
    got = versions.version_diff(spark, f"{tmp_out}/1", f"{tmp_out}/2", ["k"]).collect()
    assert bag(map(tuple, got)) == bag(except_all(old, new))
    back = versions.version_diff(spark, f"{tmp_out}/2", f"{tmp_out}/1", ["k"]).collect()
    assert bag(map(tuple, back)) == bag(except_all(new, old))


def test_equal_parts_are_not_read(spark, tmp_out, monkeypatch):
    old = [(i, "abcd"[i % 4], i, "x") for i in range(400)]
    new = [(k, p, v + (k == 41), t) for k, p, v, t in old]
    write(spark, old, f"{tmp_out}/1")
    write(spark, list(reversed(new)), f"{tmp_out}/2")
    assert len([f for f in spark.read.parquet(f"{tmp_out}/1/rows").inputFiles()]) >= 32
    parts = [tuple(r) for r in versions.unequal(spark, f"{tmp_out}/1", f"{tmp_out}/2").collect()]
    assert len(parts) == 1 and parts[0][0] == "vb"
    one = versions._rows(spark, f"{tmp_out}/1", parts)
    assert one.select(F.input_file_name()).distinct().count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    want = bag([(41, "b", 41, "x", "changed_from", 1), (41, "b", 42, "x", "changed_to", 1)])
    assert bag(map(tuple, versions.version_diff(spark, f"{tmp_out}/1", f"{tmp_out}/2", ["k"]).collect())) == want
    monkeypatch.setattr(versions, "FILTERED_PARTS", 0)  # many unequal parts are joined, not listed
    assert bag(map(tuple, versions.version_diff(spark, f"{tmp_out}/1", f"{tmp_out}/2", ["k"]).collect())) == want


def test_equal_versions_read_no_rows(spark, tmp_out):
    rows = some_rows(3)
    write(spark, rows, f"{tmp_out}/1")
    write(spark, rows[::-1], f"{tmp_out}/2")
    assert versions.unequal(spark, f"{tmp_out}/1", f"{tmp_out}/2") is None
    assert versions.version_diff(spark, f"{tmp_out}/1", f"{tmp_out}/2", ["k"]).collect() == []


def test_difference_with_a_new_column_and_swapped_values(spark, tmp_out):
    write(spark, [(1, "a", 1, "2"), (2, "a", 2, None)], f"{tmp_out}/1")
    df = spark.createDataFrame([(1, "a", 1, "2", "n"), (2, "a", 2, None, None)], SCHEMA + ", extra string")
    versions.write_version(df, f"{tmp_out}/2", ["k"], "p")
    got = versions.version_diff(spark, f"{tmp_out}/1", f"{tmp_out}/2", ["k"]).collect()
    assert bag((r.k, r.extra, r.change, r.times) for r in got) == bag([(1, None, "changed_from", 1), (1, "n", "changed_to", 1)])


# nested rows

TEXTS = ['{"a": 1, "b": {"c": "x", "d": {"e": 2}}}', '{"a": "1", "b": {"c": null}}', '{"a2": 7, "l": [1, 2]}', "[1, 2]", "5", "null", "",
         " ", None, '{"a": ', "not json", '{"a": 1.5, "b": "flat"}', '{"A": 3, "é": true}']


def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i long, text string").withColumn(
        "day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i").cast("int")))


def test_rows_are_parsed_and_malformed_ones_counted(spark):
    df = nested.parse_rows(frame(spark), "text")
    got = nested.extract(df, {"a": (["$.a", "$.a2"], "int"), "c": (["$.b.c"], "string"), "e": (["$.b.d.e"], "bigint")}).collect()
    assert {r.i for r in got if r.malformed} == {3, 4, 5, 6, 7, 8, 9, 10}
    assert {r.i: (r.a, r.c, r.e) for r in got if not r.malformed} == {
        0: (1, "x", 2), 1: (1, None, None), 2: (7, None, None), 11: (1, None, None), 12: (None, None, None)}
    assert all((r.a, r.c, r.e) == (None, None, None) for r in got if r.malformed)


def test_drift_is_reported_by_path_and_type(spark):
    got = {(r.path, r.type): (r.n_rows, r.first_day.day, r.last_day.day) for r in nested.drift_report(nested.parse_rows(frame(spark), "text"), "day").collect()}
    assert got == {("$.a", "BIGINT"): (1, 1, 1), ("$.a", "STRING"): (1, 2, 2), ("$.a", "DECIMAL"): (1, 12, 12), ("$.a2", "BIGINT"): (1, 3, 3),
                   ("$.b", "OBJECT"): (2, 1, 2), ("$.b", "STRING"): (1, 12, 12), ("$.b.c", "STRING"): (1, 1, 1), ("$.b.c", "VOID"): (1, 2, 2),
                   ("$.b.d", "OBJECT"): (1, 1, 1), ("$.b.d.e", "BIGINT"): (1, 1, 1), ("$.l", "ARRAY"): (1, 3, 3), ("$.A", "BIGINT"): (1, 13, 13),
                   ("$.é", "BOOLEAN"): (1, 13, 13)}
    assert nested.drift_report(nested.parse_rows(frame(spark).limit(0), "text"), "day").collect() == []
