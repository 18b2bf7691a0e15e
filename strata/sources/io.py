"""Sources and sinks (S1-S7): panel CSV/parquet, star tables, views, rebuilds.

Tables live as files under a base path (the cluster's shared folder or a
warehouse location); a pointer table beside them says which folders are
current, so another session finds them. They are exposed as temporary views.
A rebuild writes a new versioned folder and moves pointer and views last, so a
failed build leaves the previous version in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import snapshot as snap
from strata.operators.ranking import with_row_number
from strata.operators.star import FACT_COUNTS, FACT_ID, FACT_LAYOUT

L, D, S = T.LongType(), T.DoubleType(), T.StringType()

RAW_PANEL_SCHEMA = T.StructType([
    T.StructField("country_id", L), T.StructField("country", S), T.StructField("continent", S),
    T.StructField("date", T.DateType()), T.StructField("population", L), T.StructField("median_age", D),
    T.StructField("gdp_per_capita", D), T.StructField("life_expectancy", D), T.StructField("new_cases", L),
    T.StructField("new_deaths", L), T.StructField("new_tests", L), T.StructField("icu_patients", L),
    T.StructField("hosp_patients", L), T.StructField("positive_rate", D), T.StructField("stringency_index", D),
    T.StructField("total_cases", L), T.StructField("total_deaths", L), T.StructField("total_recovered", L),
    T.StructField("total_tests", L), T.StructField("people_vaccinated", L), T.StructField("people_fully_vaccinated", L),
    T.StructField("total_boosters", L),
    T.StructField("active_cases", L), T.StructField("reproduction_rate", D),
])

DIM_SCHEMA = T.StructType([
    T.StructField("country_id", L, False), T.StructField("country_name", S, False),
    T.StructField("continent", S, False), T.StructField("population", L, False),
    T.StructField("median_age", D), T.StructField("gdp_per_capita", D), T.StructField("life_expectancy", D),
])

FACT_SCHEMA = T.StructType([
    T.StructField(n, T.DateType() if n == "report_date" else D if kind == "measure" else L, kind == "measure")
    for n, kind in FACT_LAYOUT])
FACT_TABLE_SCHEMA = T.StructType([T.StructField(FACT_ID, L, False), *FACT_SCHEMA.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to a declared schema (the DDL of the star tables).

    A count that is absent or NULL takes its DEFAULT 0; another column that is absent is NULL.
    """
    out = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = F.coalesce(c, F.lit(0)) if f.name in FACT_COUNTS and f.dataType == L else c
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def with_fact_id(fact: DataFrame) -> DataFrame:
    """The fact with its surrogate key: 1..n in (entity, date) order, declared types and defaults."""
    numbered = with_row_number(conform(fact, FACT_SCHEMA), [F.col("country_id"), F.col("report_date")], FACT_ID)
    return conform(numbered, FACT_TABLE_SCHEMA)


BAD_CELLS = "_bad_cells"


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_PANEL_SCHEMA,
                   date_format: str = "yyyy-MM-dd", corrupt_column: str | None = None,
                   bad_cells: str | None = None, keep: tuple[Column, ...] = ()) -> DataFrame:
    """Headered CSV, its columns found by their names in the header, cast to ``schema`` (no inference).

    A file whose header differs from the first one's is refused by the reader. A column that the header lacks is
    NULL. A cell that is not of its type is NULL and counted in ``bad_cells`` (a column of that name; text
    is kept whole); a row with too few or too many cells is kept in ``corrupt_column``. ``keep`` are columns
    taken at the scan.
    """
    reader = spark.read.option("header", True)
    names = reader.csv(path).columns
    raw = T.StructType([T.StructField(n, S) for n in names] + ([T.StructField(corrupt_column, S)] if corrupt_column else []))
    reader = reader.option("enforceSchema", False).option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.schema(raw).csv(path)

    def typed(f: T.StructField) -> Column:
        if f.name not in names:
            return F.lit(None).cast(f.dataType)
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return F.try_to_timestamp(c, F.lit(date_format)).cast("date")
        return c.try_cast(f.dataType)

    cells = [(f, typed(f)) for f in schema.fields]
    bad = F.lit(0)
    for f, c in cells:
        if f.name in names:
            bad = bad + (F.col(f"`{f.name}`").isNotNull() & c.isNull()).cast("int")
    extra = ([bad.alias(bad_cells)] if bad_cells else []) + ([F.col(corrupt_column)] if corrupt_column else [])
    return df.select(*[c.alias(f.name) for f, c in cells], *extra, *keep)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Write the whole panel; executors write in parallel.

    With ``partition_by`` the rows are rebalanced by it first, so that a folder gets few files of the advised
    size (adaptive execution splits a large one) instead of one from every task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def create_star_tables(spark: SparkSession, fact: DataFrame, dim: DataFrame, base: str,
                       fact_name: str = "panel_facts", dim_name: str = "entities") -> dict[str, str]:
    """S3: write dimension and fact (with its fact_id, declared types and defaults), register them by name,
    and record their folders in the pointer of ``base``, from which ``open_star_tables`` finds them later."""
    paths = {dim_name: f"{base}/{dim_name}", fact_name: f"{base}/{fact_name}"}
    write_panel(conform(dim, DIM_SCHEMA), paths[dim_name])
    write_panel(with_fact_id(fact), paths[fact_name])
    _point(spark, base, paths)
    for name, p in paths.items():
        spark.read.parquet(p).createOrReplaceTempView(name)
    return paths


def _point(spark: SparkSession, base: str, paths: dict[str, str]) -> None:
    """Append a pointer (version, name, path); the largest version is current. A row is visible only when
    its job has committed, so readers see the old tables or the new ones. The version is the clock's time, or
    one more than the last where this machine's clock is behind the last writer's."""
    try:
        last = spark.read.parquet(f"{base}/_current").agg(F.max("version")).first()[0] or 0
    except AnalysisException:  # the first pointer of this folder
        last = 0
    version = max(time.time_ns(), last + 1)
    rows = [(version, n, p) for n, p in paths.items()]
    spark.createDataFrame(rows, "version long, name string, path string").coalesce(1).write.mode("append").parquet(f"{base}/_current")


def open_star_tables(spark: SparkSession, base: str) -> dict[str, str]:
    """Register the current tables of ``base`` in any session: name -> folder."""
    p = spark.read.parquet(f"{base}/_current")
    last = p.where(F.col("version") == p.select(F.max("version")).scalar())
    paths = {r["name"]: r["path"] for r in last.collect()}
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return paths


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows by column name to an existing table folder."""
    return write_panel(df, path, fmt, mode="append")


def scan_table(spark: SparkSession, name: str | None = None, sql: str | None = None) -> DataFrame:
    """A table or view by ``name``, or a ``sql`` text."""
    if (name is None) == (sql is None):
        raise ValueError("give a name or a SQL text")
    return spark.table(name) if name is not None else spark.sql(sql)


def register_views(spark: SparkSession, fact: DataFrame, dim: DataFrame,
                   fact_name: str = "panel_facts", dim_name: str = "entities") -> list[str]:
    """(re)create the tables' views and the three analytical views."""
    views = {
        fact_name: fact,
        dim_name: dim,
        "vw_latest_snapshot": snap.latest_snapshot(fact, dim),
        "vw_monthly_summary": snap.monthly_summary(fact, dim),
        "vw_group_daily": snap.group_daily(fact, dim),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def full_rebuild(spark: SparkSession, build: Callable[[], tuple[DataFrame, DataFrame]], base: str) -> dict[str, str]:
    """Build into a fresh version folder; pointer and views move only after both writes succeed.

    Version folders that the pointer has left are no longer read and may be removed by the owner of ``base``.
    """
    fact, dim = build()
    version = f"{base}/v-{uuid.uuid4().hex[:12]}"
    paths = {"entities": f"{version}/entities", "panel_facts": f"{version}/panel_facts"}
    write_panel(conform(dim, DIM_SCHEMA), paths["entities"])
    write_panel(with_fact_id(fact), paths["panel_facts"])
    _point(spark, base, paths)
    register_views(spark, spark.read.parquet(paths["panel_facts"]), spark.read.parquet(paths["entities"]))
    return paths
