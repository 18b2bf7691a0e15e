"""Star-schema operators (E19-E23): dimension extraction, keys, fact projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import with_row_number

# FIXED VALUES: the fact table's columns, in its order, with their types. "count" is a BIGINT that is NOT NULL
# DEFAULT 0; "key" is NOT NULL; "measure" is a nullable DOUBLE. Everything else on the fact derives from this.
FACT_LAYOUT = (
    ("country_id", "key"), ("report_date", "key"), ("total_cases", "count"), ("new_cases", "count"),
    ("total_deaths", "count"), ("new_deaths", "count"), ("total_recovered", "count"), ("active_cases", "count"),
    ("total_tests", "count"), ("new_tests", "count"), ("positive_rate", "measure"), ("people_vaccinated", "count"),
    ("people_fully_vaccinated", "count"), ("total_boosters", "count"), ("icu_patients", "count"),
    ("hosp_patients", "count"), ("reproduction_rate", "measure"), ("stringency_index", "measure"),
    ("case_fatality_rate", "measure"), ("cases_per_million", "measure"), ("deaths_per_million", "measure"),
    ("vaccination_rate_pct", "measure"), ("testing_rate_pct", "measure"), ("new_cases_7day_avg", "measure"),
    ("new_deaths_7day_avg", "measure"), ("case_growth_wow_pct", "measure"),
)
FACT_COLUMNS = tuple(n for n, _ in FACT_LAYOUT)
FACT_COUNTS = tuple(n for n, kind in FACT_LAYOUT if kind == "count")
FACT_NOT_NULL = tuple(n for n, kind in FACT_LAYOUT if kind != "measure")
FACT_ID = "fact_id"
# FIXED VALUES: the dimension's attributes and its NOT NULL columns.
DIM_ATTRS = ("continent", "population", "median_age", "gdp_per_capita", "life_expectancy")
DIM_NOT_NULL = ("country_name", "continent", "population")


def extract_dimension(panel: DataFrame, entity: str = "country", date: str = "date",
                      attrs: Sequence[str] = DIM_ATTRS, name_out: str = "country_name") -> DataFrame:
    """One row per entity with its attributes from the entity's first row in date order.

    ``min(struct(date, attrs...))`` aggregates map-side; no window over the entity.
    """
    first = F.min(F.struct(F.col(date), *[F.col(a) for a in attrs])).alias("__f")
    return panel.groupBy(entity).agg(first).select(
        F.col(entity).alias(name_out), *[F.col(f"__f.{a}").alias(a) for a in attrs])


def attribute_drift(panel: DataFrame, entity: str = "country", attrs: Sequence[str] = DIM_ATTRS) -> DataFrame:
    """E19 check: entities whose attributes are not constant over time."""
    return (panel.groupBy(entity).agg(F.count_distinct(F.struct(*attrs)).alias("n_versions"))
            .where(F.col("n_versions") > 1))


def assign_surrogate_key(df: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """Dense 1..n ids in ``order`` (a total order), without a single-partition window."""
    return with_row_number(df, [F.col(c) for c in order], out)


def lookup_key(fact: DataFrame, dim: DataFrame, name: str, dim_name: str, dim_id: str) -> DataFrame:
    """Attach the dimension id by name (left join; unmatched -> NULL id)."""
    d = dim.select(F.col(dim_name).alias("__name"), F.col(dim_id))
    return fact.join(d, F.col(name) == F.col("__name"), "left").drop("__name")


def unmatched_keys(fact: DataFrame, dim: DataFrame, name: str, dim_name: str) -> DataFrame:
    """E21 report: fact labels with no dimension row."""
    return fact.select(name).distinct().join(dim.select(F.col(dim_name).alias(name)), name, "left_anti")


def project_rename(panel: DataFrame, date: str = "date", out_date: str = "report_date",
                   columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """Rename the date and keep the fact columns in order."""
    return panel.withColumnRenamed(date, out_date).select(*columns)


def normalize_date(df: DataFrame, column: str, out: str | None = None, fmt: str = "yyyy-MM-dd",
                   as_text: bool = False) -> DataFrame:
    """Parse to DATE; ``as_text`` formats to ISO text (export only)."""
    d = F.to_date(F.col(column)) if dict(df.dtypes).get(column) == "string" else F.col(column).cast("date")
    return df.withColumn(out or column, F.date_format(d, fmt) if as_text else d)
