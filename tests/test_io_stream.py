"""Sources, sinks, the suite runner and the streaming upsert."""

from pyspark.sql import functions as F

from strata.operators.stats import t_two_sided_p
from strata.plans.panel import panel
from strata.plans.suite import run_suite
from strata.sources import io
from strata.streaming.upsert import start_upsert_stream

from .conftest import SF_SMALL


def test_csv_roundtrip_and_corrupt_rows(spark, tmp_out):
    raw = panel(spark, SF_SMALL).raw.select(*[f.name for f in io.RAW_PANEL_SCHEMA.fields])
    io.write_panel(raw, f"{tmp_out}/csv", fmt="csv")
    back = io.read_panel_csv(spark, f"{tmp_out}/csv")
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    with open(f"{tmp_out}/bad.csv", "w") as fh:
        fh.write(",".join(f.name for f in io.RAW_PANEL_SCHEMA.fields) + "\n")
        fh.write("x,y\n")
    bad = io.read_panel_csv(spark, f"{tmp_out}/bad.csv", corrupt_column="_bad").collect()
    assert bad[0]["_bad"] == "x,y"


def test_star_tables_append_and_rebuild(spark, tmp_out):
    p = panel(spark, SF_SMALL)
    paths = io.create_star_tables(spark, p.fact, p.dim, f"{tmp_out}/star")
    got = [(f.name, f.dataType) for f in spark.read.parquet(paths["entities"]).schema.fields]
    assert got == [(f.name, f.dataType) for f in io.DIM_SCHEMA.fields]
    assert io.scan_table(spark, "panel_facts").count() == p.fact.count()
    stored = spark.read.parquet(paths["panel_facts"])
    assert stored.columns == [io.FACT_ID, *(f.name for f in io.FACT_SCHEMA.fields)] and "people_vaccinated" in stored.columns
    assert stored.select("fact_id").distinct().count() == stored.count() == stored.agg(F.max("fact_id")).first()[0]
    io.append_table(io.conform(p.fact.limit(3), io.FACT_TABLE_SCHEMA), paths["panel_facts"])
    assert spark.read.parquet(paths["panel_facts"]).count() == p.fact.count() + 3
    views = io.register_views(spark, p.fact, p.dim)
    assert "vw_latest_snapshot" in views and io.scan_table(spark, sql="SELECT\ncount(*)\nFROM vw_latest_snapshot").first()[0] == 25

    def failing():
        raise RuntimeError("build failed")
    first = io.full_rebuild(spark, lambda: (p.fact, p.dim), f"{tmp_out}/rb")
    try:
        io.full_rebuild(spark, failing, f"{tmp_out}/rb")
    except RuntimeError:
        pass
    for v in ("entities", "panel_facts"):
        spark.catalog.dropTempView(v)
    assert io.open_star_tables(spark, f"{tmp_out}/rb") == first  # the pointer outlives the session's views
    # the failed build left the views on the first version
    assert io.scan_table(spark, "entities").inputFiles()[0].find(first["entities"].split("/")[-2]) >= 0


def test_suite_records_failures(spark):
    status, samples = run_suite(spark, {"ok": lambda: spark.range(20), "bad": lambda: spark.sql("SELECT * FROM nope")})
    s = {r.name: r for r in status.collect()}
    assert s["ok"].ok and s["ok"].n_rows == 20 and len(samples["ok"]) == 15
    assert not s["bad"].ok and "nope" in s["bad"].error.lower()


def test_stream_upsert_latest_load_wins(spark, tmp_out):
    fact = panel(spark, SF_SMALL).fact.select("country_id", "report_date", "new_cases")
    month = F.date_format("report_date", "yyyy-MM").alias("part_month")
    src, table, ck = f"{tmp_out}/src", f"{tmp_out}/table", f"{tmp_out}/ck"
    fact.select("*", F.lit(1).alias("load_id"), month).write.parquet(f"{src}/a")
    schema = spark.read.parquet(f"{src}/a").schema
    # batch 1: the whole table
    q = start_upsert_stream(spark, f"{src}/a", schema, table, ["country_id", "report_date"], "load_id", "part_month", ck)
    q.awaitTermination()
    # batch 2: a restatement of one month, newer load
    (fact.where(F.date_format("report_date", "yyyy-MM") == "1996-03")
     .select("country_id", "report_date", (F.col("new_cases") + 1000).alias("new_cases"), F.lit(2).alias("load_id"), month)
     .write.mode("append").parquet(f"{src}/a"))
    q = start_upsert_stream(spark, f"{src}/a", schema, table, ["country_id", "report_date"], "load_id", "part_month", ck)
    q.awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == fact.count()
    changed = out.where("load_id = 2")
    assert changed.count() == fact.where(F.date_format("report_date", "yyyy-MM") == "1996-03").count()
    assert changed.where("new_cases < 1000").count() == 0


def test_upsert_batch_is_idempotent(spark, tmp_out):
    from strata.streaming.upsert import upsert_batch

    fact = panel(spark, SF_SMALL).fact.select("country_id", "report_date", "new_cases")
    month = F.date_format("report_date", "yyyy-MM").alias("part_month")
    base = fact.select("*", F.lit(1).alias("load_id"), month)
    delta = fact.where("report_date >= DATE'1996-03-01' AND report_date < DATE'1996-04-01'") \
        .select("country_id", "report_date", (F.col("new_cases") + 7).alias("new_cases"), F.lit(2).alias("load_id"), month)
    table = f"{tmp_out}/t"
    upsert_batch(spark, base, table, ["country_id", "report_date"], "load_id", "part_month")
    upsert_batch(spark, delta, table, ["country_id", "report_date"], "load_id", "part_month")
    once = spark.read.parquet(table).collect()
    upsert_batch(spark, delta, table, ["country_id", "report_date"], "load_id", "part_month")  # replayed batch
    twice = spark.read.parquet(table).collect()
    assert sorted(once) == sorted(twice) and len(once) == fact.count()


def test_partitioned_write_prunes(spark, tmp_out):
    fact = panel(spark, SF_SMALL).fact.withColumn("report_year", F.year("report_date"))
    io.write_panel(fact, f"{tmp_out}/py", partition_by=["report_year"])
    q = spark.read.parquet(f"{tmp_out}/py").where("report_year = 1996")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_year" in plan and "= 1996)" in plan
    assert q.count() == fact.where("report_year = 1996").count()


def test_t_p_value(spark):
    # exact values (closed forms for 1 and 2 degrees, high-precision quadrature for the others)
    cases = [(2.0, 10, 0.0733880347707404), (2.0, 23, 0.057444548992082685), (1.0, 1, 0.5), (0.0, 7, 1.0),
             (3.0, 2, 0.09546596626670911), (31.7, 49, 2.6053734809336387e-34)]
    df = spark.createDataFrame([(t, v) for t, v, _ in cases] + [(None, 5), (31.7, 5_000_000_000), (2.0, 5_000_000_000)],
                               "t double, v long")
    got = [r.p for r in df.select(t_two_sided_p(F.col("t"), F.col("v")).alias("p")).collect()]
    for (t, v, want), p in zip(cases, got):
        assert abs(p - want) <= 1e-10 * want, (want, p)
    assert got[-3] is None and 0 < got[-2] < 1e-200 and abs(got[-1] - 0.04550026389635842) < 1e-6


def test_shared_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from strata.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[3,2,1024]")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)))


def test_checkpoints_are_removed_after_use(spark):
    import gc
    import os
    import time

    from strata.operators.ranking import with_rank_variants

    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    df = with_rank_variants(spark.range(50).withColumn("v", F.col("id") % 7), ["v"], [F.col("v"), F.col("id")])
    assert df.count() == 50 and set(os.listdir(folder)) - before
    del df
    for _ in range(20):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
        if not set(os.listdir(folder)) - before:
            break
    assert not set(os.listdir(folder)) - before


def upsert_table(spark, base):
    from strata.streaming.upsert import read_current

    t = read_current(spark, base)
    return sorted((r.asDict() for r in t.collect()), key=lambda r: (r["k"], str(r["p"])))


def test_upsert_keeps_columns_that_the_delta_lacks(spark, tmp_out):
    from strata.streaming.upsert import upsert_batch

    base = f"{tmp_out}/t"
    rows = [(1, "p", 10, "keep", 1), (2, "p", 20, "keep", 1), (3, "q", 30, "other", 1)]
    upsert_batch(spark, spark.createDataFrame(rows, "k long, p string, v long, extra string, load_id int"), base, ["k"], "load_id", "p")
    delta = spark.createDataFrame([(1, "p", 11, 2), (4, "p", 40, 2), (3, "q", 31, 0)], "k long, p string, v long, load_id int")
    for _ in range(2):  # a batch that runs again changes nothing
        upsert_batch(spark, delta, base, ["k"], "load_id", "p")
        assert [(r["k"], r["v"], r["extra"], r["load_id"]) for r in upsert_table(spark, base)] == [
            (1, 11, "keep", 2), (2, 20, "keep", 1), (3, 30, "other", 1), (4, 40, None, 2)]


def test_upsert_takes_new_columns(spark, tmp_out):
    from strata.streaming.upsert import upsert_batch

    base = f"{tmp_out}/t"
    upsert_batch(spark, spark.createDataFrame([(1, "p", 1), (2, "q", 1)], "k long, p string, load_id int"), base, ["k"], "load_id", "p")
    upsert_batch(spark, spark.createDataFrame([(1, "p", 2, "new")], "k long, p string, load_id int, c string"), base, ["k"], "load_id", "p")
    assert [(r["k"], r["c"]) for r in upsert_table(spark, base)] == [(1, "new"), (2, None)]


def test_upsert_moves_keys_between_partitions(spark, tmp_out):
    """Also out of a partition that is then empty, and into and out of the NULL partition."""
    from strata.streaming.upsert import upsert_batch

    base, schema = f"{tmp_out}/t", "k long, p string, v long, load_id int"
    upsert_batch(spark, spark.createDataFrame([(1, "p", 1, 1), (2, "p", 2, 1), (3, "q", 3, 1), (5, None, 5, 1)], schema), base, ["k"], "load_id", "p")
    delta = spark.createDataFrame([(1, "q", 11, 2), (3, None, 33, 2), (5, "r s", 55, 2)], schema)
    for _ in range(2):
        upsert_batch(spark, delta, base, ["k"], "load_id", "p")
        assert [(r["k"], r["p"], r["v"]) for r in upsert_table(spark, base)] == [(1, "q", 11), (2, "p", 2), (3, None, 33), (5, "r s", 55)]
    upsert_batch(spark, spark.createDataFrame([(2, "q", 22, 3), (5, "q", 56, 3)], schema), base, ["k"], "load_id", "p")
    assert [(r["k"], r["p"], r["v"]) for r in upsert_table(spark, base)] == [(1, "q", 11), (2, "q", 22), (3, None, 33), (5, "q", 56)]
    # an older load of a key that has moved since does not bring it back
    upsert_batch(spark, spark.createDataFrame([(2, "p", 0, 1)], schema), base, ["k"], "load_id", "p")
    assert [(r["k"], r["p"], r["v"]) for r in upsert_table(spark, base)] == [(1, "q", 11), (2, "q", 22), (3, None, 33), (5, "q", 56)]


def test_shares_keep_rows_without_an_entity(spark):
    from strata.operators.features import share_of_entity_max, share_of_entity_total

    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 2.0), (None, 8.0), ("b", None)], "e string, v double")
    assert sorted(((r.e, r.s) for r in share_of_entity_max(df, "v", "s", "e").collect()), key=repr) == sorted(
        [("a", 0.25), ("a", 1.0), (None, 0.25), (None, 1.0), ("b", 0.0)], key=repr)
    assert sorted(((r.e, r.s) for r in share_of_entity_total(df, "v", "s", "e").collect()), key=repr) == sorted(
        [("a", 0.2), ("a", 0.8), (None, 0.2), (None, 0.8), ("b", None)], key=repr)


def test_rebuilds_are_found_when_the_clock_is_behind(spark, tmp_out, monkeypatch):
    p = panel(spark, SF_SMALL)
    io.create_star_tables(spark, p.fact, p.dim, f"{tmp_out}/star")
    monkeypatch.setattr(io.time, "time_ns", lambda: 5)
    paths = io.full_rebuild(spark, lambda: (p.fact, p.dim), f"{tmp_out}/star")
    assert io.open_star_tables(spark, f"{tmp_out}/star") == paths


def test_profile_distribution_matches_numpy(spark):
    import numpy as np

    from strata.operators.stats import profile_distribution

    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 200), rng.normal(size=200).round(4)
    df = spark.createDataFrame([(int(x), float(y) if i % 7 else None, "t") for i, (x, y) in enumerate(zip(a, b))], "a long, b double, c string")
    got = {r["column"]: r for r in profile_distribution(df).collect()}
    held = np.array([y for i, y in enumerate(b) if i % 7])
    assert set(got) == {"a", "b"} and got["a"]["n"] == 200 and got["b"]["n"] == len(held)
    for c, v in (("a", a), ("b", held)):
        assert got[c]["n_distinct"] == len(set(v.tolist())) and abs(got[c]["mean"] - v.mean()) < 2e-6
        for q in (1, 25, 50, 75, 99):
            assert abs(got[c][f"p{q:02d}"] - np.quantile(v, q / 100)) < 2e-6
