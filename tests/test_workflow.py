"""The raw-CSV workflow end to end on a small dirty extract (duplicates, casing, negatives, gaps)."""

import datetime as dt

from strata.operators.clean import assert_valid
from strata.plans import workflow as WF
from strata.sources import io

HEADER = [n for n, _ in WF.RAW_CSV_COLUMNS]


def row(country, day, new_cases, positive_rate="0.1", icu="3", continent="Europe"):
    d = (dt.date(2021, 1, 1) + dt.timedelta(days=day)).isoformat()
    vals = {"country": country, "continent": continent, "date": d, "population": "1000", "median_age": "40",
            "gdp_per_capita": "30000", "life_expectancy": "80", "total_cases": str(10 * (day + 1)),
            "new_cases": str(new_cases), "total_deaths": str(day), "new_deaths": "1", "total_recovered": "0",
            "active_cases": "0", "total_tests": str(100 * (day + 1)), "new_tests": "100",
            "positive_rate": positive_rate, "people_vaccinated": "0", "people_fully_vaccinated": str(day),
            "total_boosters": "0", "icu_patients": icu, "hosp_patients": "1", "reproduction_rate": "1.0",
            "stringency_index": "50"}
    return ",".join(vals[h] for h in HEADER)


def test_workflow_on_dirty_csv(spark, tmp_out):
    lines = [",".join(HEADER)]
    lines += [row("France", i, 10) for i in range(10)]
    lines += [row("Cote d'ivoire", i, 5, positive_rate="" if i == 3 else "0.05", icu="" if i < 2 else "4",
                  continent="Africa") for i in range(10)]
    lines += [row("FRANCE  ", 2, 999)]            # later copy of (France, day 2): dropped, first kept
    lines[4] = row("France", 3, -7)              # a negative flow: floored to 0
    path = f"{tmp_out}/raw.csv"
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")

    clean, report = WF.clean_raw(WF.read_raw_csv(spark, path))
    assert_valid(report)
    c = {(r.country, r.date.day): r for r in clean.collect()}      # keyed by day of January (index + 1)
    assert len(c) == 20 and {k[0] for k in c} == {"France", "Cote D'Ivoire"}
    assert c[("France", 3)].new_cases == 10 and c[("France", 4)].new_cases == 0
    assert c[("Cote D'Ivoire", 4)].positive_rate == 0.05            # null rate recomputed: 5 / 100
    assert c[("Cote D'Ivoire", 1)].icu_patients == 4                 # leading gap back-filled

    fact, dim = WF.build_star(clean)
    d = {r.country_name: r.country_id for r in dim.collect()}
    assert d == {"Cote D'Ivoire": 1, "France": 2}                    # ids in name order
    assert fact.count() == 20 and fact.where("country_id IS NULL").count() == 0

    io.create_star_tables(spark, fact, dim, f"{tmp_out}/star")
    io.register_views(spark, fact, dim)
    status, samples = WF.run_questions(spark, fact, dim, names3=("France",), one="France")
    st = {r.name: r for r in status.collect()}
    assert len(st) == 25 and all(r.ok for r in st.values()), [r for r in st.values() if not r.ok]
    assert st["q10"].n_rows == 2 and st["q20"].n_rows == 1


def test_files_of_different_size_reordered_header_and_bad_cells(spark, tmp_out):
    """Keep-first follows the file names, columns follow the header, and a cell of a wrong type is a violation."""
    import pytest

    first = [",".join(HEADER), row("France", 0, 1)]
    later = [",".join(HEADER), row("France", 0, 999)] + [row("France", i, 10) for i in range(1, 200)]
    for name, lines in (("a.csv", first), ("b.csv", later)):
        with open(f"{tmp_out}/{name}", "w") as fh:
            fh.write("\n".join(lines) + "\n")
    clean, report = WF.clean_raw(WF.read_raw_csv(spark, f"{tmp_out}/*.csv"))
    assert_valid(report)
    assert {r.date.day: r.new_cases for r in clean.where("date < '2021-01-03'").collect()} == {1: 1, 2: 10}

    turned = HEADER[::-1]
    cells = dict(zip(HEADER, row("France", 0, 7).split(",")))
    other = dict(zip(HEADER, row("France", 1, 8).split(","))) | {"new_cases": "12x"}
    with open(f"{tmp_out}/turned.txt", "w") as fh:
        fh.write("\n".join([",".join(turned)] + [",".join(c[h] for h in turned) for c in (cells, other)]) + "\n")
    clean, report = WF.clean_raw(WF.read_raw_csv(spark, f"{tmp_out}/turned.txt"))
    got = {r.date.day: (r.country, r.total_cases, r.total_deaths, r.new_cases) for r in clean.collect()}
    assert got == {1: ("France", 10, 0, 7), 2: ("France", 20, 1, None)}
    assert {r.check: r.violations for r in report.collect()} == {
        "null_date": 0, "negative_new_cases": 1, "deaths_exceed_cases": 0, "duplicate_key": 0, "bad_cells": 1}
    with pytest.raises(ValueError, match="bad_cells=1"):
        assert_valid(report)


def test_row_counts_of_the_steps(spark, tmp_out):
    with open(f"{tmp_out}/raw.csv", "w") as fh:
        fh.write("\n".join([",".join(HEADER)] + [row("France", i % 5, i) for i in range(12)]) + "\n")
    audit = []
    clean, _ = WF.clean_raw(WF.read_raw_csv(spark, f"{tmp_out}/raw.csv"), audit)
    assert clean.count() == 5
    assert [(step, seen.get["rows"]) for step, seen in audit] == [("input", 12), ("deduplicated", 5)]


def test_gap_fill_is_linear(spark):
    import time

    from pyspark.sql import functions as F
    from strata.operators.clean import fill_series_gaps

    df = spark.range(40_000).select(F.lit(1).alias("e"), F.col("id").alias("d"),
                                    F.when(F.col("id") > 39_000, F.col("id")).alias("x"))
    fill_series_gaps(df, ["x"], "e", "d").count()
    t = time.time()
    got = fill_series_gaps(df, ["x"], "e", "d").agg(F.sum("x")).first()[0]
    assert got == 39_001 * 39_001 + sum(range(39_001, 40_000)) and time.time() - t < 5
