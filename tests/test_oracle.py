"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from strata.sources.tables import TABLES
from tools.check import rows_of

from .conftest import SF_SMALL

# the corpus queries have tests of their own beside them
QUERIES = {k: f for r in entry._registries() for k, f in r.SPARK.items()}
ORACLE = {k: q for r in entry._registries() for k, q in r.ORACLE.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("missing", ["corpus_pipeline", "strata.llm", "strata.llm.registry", "public_tokenizers"])
def test_core_queries_stay_when_the_corpus_part_cannot_be_imported(monkeypatch, missing):
    import sys

    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("strata.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    monkeypatch.delattr("strata.llm", raising=False)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert len(rows) > 0
        return
    cur = duck.execute(ORACLE[key])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(rows, df.columns, True) == rows_of(drows, dcols, True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["continent", "total_cases", "total_deaths", "continent_cfr_pct", "population"]
    assert df.count() == 5


@pytest.mark.parametrize("key", ["rank_in_group", "pareto_quintiles", "rank_variants", "user_quintiles",
                                 "assign_surrogate_key", "global_running_total", "pareto_curve", "global_trend_7d"])
def test_result_does_not_depend_on_shuffle_partitions(spark, duck, key):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = QUERIES[key](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    cur = duck.execute(ORACLE[key])
    assert rows_of(rows, df.columns, True) == rows_of(cur.fetchall(), [d[0] for d in cur.description], True)
