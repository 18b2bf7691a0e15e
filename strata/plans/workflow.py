"""The whole batch workflow for a raw daily CSV: clean -> validate -> star tables -> views -> questions.

This is the path a user with a raw entity x day extract takes:

    raw = read_raw_csv(spark, "s3://.../raw/*.csv")
    clean, report = clean_raw(raw)
    clean = clean.persist()                   # validation, dimension and fact all read it
    assert_valid(validate_panel(clean, "country", "date"))   # the one step that raises
    fact, dim = build_star(clean)
    create_star_tables(spark, fact, dim, base); register_views(spark, fact, dim)
    status, samples = run_questions(spark, fact, dim)

Keep-first deduplication needs the file order. Spark orders file splits by size,
so it is taken at the scan as explicit columns: the file's path, the split's
start in it, and an id that increases with the rows of a split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import clean as C
from strata.operators import star as S
from strata.plans import questions as Q
from strata.plans.suite import run_suite
from strata.sources import io

L, D, STR = T.LongType(), T.DoubleType(), T.StringType()

# FIXED VALUES: column layout of the raw daily CSV, in file order.
RAW_CSV_COLUMNS = (
    ("country", STR), ("continent", STR), ("date", T.DateType()), ("population", L), ("median_age", D),
    ("gdp_per_capita", D), ("life_expectancy", D), ("total_cases", L), ("new_cases", L), ("total_deaths", L),
    ("new_deaths", L), ("total_recovered", L), ("active_cases", L), ("total_tests", L), ("new_tests", L),
    ("positive_rate", D), ("people_vaccinated", L), ("people_fully_vaccinated", L), ("total_boosters", L),
    ("icu_patients", D), ("hosp_patients", L), ("reproduction_rate", D), ("stringency_index", D),
)
RAW_CSV_SCHEMA = T.StructType([T.StructField(n, t) for n, t in RAW_CSV_COLUMNS])

INGEST = ("_ingest_file", "_ingest_block", "_ingest_row")
DIM_OUT = ("country_id", "country_name", "continent", "population", "median_age", "gdp_per_capita",
           "life_expectancy")


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_CSV_SCHEMA) -> DataFrame:
    """S1 for the raw layout: columns by header name, cells of a wrong type counted in ``io.BAD_CELLS``, and
    the file order captured as columns."""
    order = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return io.read_panel_csv(spark, path, schema, bad_cells=io.BAD_CELLS,
                             keep=tuple(c.alias(n) for c, n in zip(order, INGEST)))


def clean_raw(raw: DataFrame, audit: list | None = None) -> tuple[DataFrame, DataFrame]:
    """E26 on the raw layout (names, keep-first dedupe, floor, fills, derived columns) plus the E17 report.

    The report also counts the cells of the raw rows that are not of their type. ``audit`` collects the row
    counts of the steps (E18), to be read after the clean frame has run.
    """
    order = [c for c in INGEST if c in raw.columns]
    clean = C.clean_panel(raw, entity="country", date="date", names=True, dedupe_order=order or None, audit=audit)
    clean = clean.drop(*INGEST, io.BAD_CELLS)
    report = C.validate_panel(clean, entity="country", date="date")
    if io.BAD_CELLS in raw.columns:
        bad = raw.select(F.lit("bad_cells").alias("check"), io.BAD_CELLS).groupBy("check").agg(
            F.sum(io.BAD_CELLS).cast("bigint").alias("violations"))
        report = report.unionByName(bad)
    return clean, report


def build_star(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """E19 + E20 (ids in name order) for the dimension; E21 + E22 for the fact."""
    dim = S.assign_surrogate_key(S.extract_dimension(clean), ["country_name"], "country_id").select(*DIM_OUT)
    fact = S.project_rename(S.lookup_key(clean, dim, "country", "country_name", "country_id"))
    return fact, dim


# FIXED VALUES: the entities and years of the original questions.
NAMES3, WAVE_OF, SLICE_OF, YEARS = ("United States", "India", "Brazil"), "India", "Germany", (2021, 2022)


def run_questions(spark: SparkSession, fact: DataFrame, dim: DataFrame, out_dir: str | None = None,
                  names3=NAMES3, one=WAVE_OF, slice_of=SLICE_OF, years=YEARS, as_of: str | None = None):
    """S8 over the 25 questions with their default parameters (entity names and years of the
    original daily data set; pass others for other data)."""
    named = {
        "q01": lambda: Q.q01_top_per_million(fact, dim),
        "q02": lambda: Q.q02_global_running_total(fact),
        "q03": lambda: Q.q03_rank_in_group(fact, dim),
        "q04": lambda: Q.q04_pareto_quintiles(fact, dim),
        "q05": lambda: Q.q05_moving_avg_30(fact, dim, names3),
        "q06": lambda: Q.q06_avg_monthly_gain(fact, dim),
        "q07": lambda: Q.q07_snapshot_pairs(fact, dim, as_of),
        "q08": lambda: Q.q08_avg_growth_having(fact, dim, f"{years[0]}-01-01", f"{years[0]}-12-31"),
        "q09": lambda: Q.q09_monthly_global(fact),
        "q10": lambda: Q.q10_group_ratio_of_sums(fact, dim),
        "q11": lambda: Q.q11_below_threshold(fact, dim, 50.0, as_of),
        "q12": lambda: Q.q12_wave_direction(fact, dim, one),
        "q13": lambda: Q.q13_level_per_million(fact, dim),
        "q14": lambda: Q.q14_gdp_cohorts(fact, dim),
        "q15": lambda: Q.q15_age_cohorts(fact, dim),
        "q16": lambda: Q.q16_bottom_testing(fact, dim),
        "q17": lambda: Q.q17_peak_day(fact, dim),
        "q18": lambda: Q.q18_stringency_cohorts(fact),
        "q19": lambda: Q.q19_stock_ratio(fact, dim, as_of=as_of),
        "q20": lambda: Q.q20_year_pivot(fact, years),
        "q21": lambda: Q.q21_count_above(fact, dim, 1.2),
        "q22": lambda: Q.q22_recovery_rate(fact, dim),
        "q23": lambda: Q.q23_global_kpis(fact, dim),
        "q24": lambda: Q.q24_above_global_avg(fact, dim, 60.0, as_of),
        "q25": lambda: Q.q25_monthly_view_slice(fact, dim, slice_of),
    }
    return run_suite(spark, named, out_dir)
