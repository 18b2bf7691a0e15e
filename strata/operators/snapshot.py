"""Views V1-V3: latest snapshot, monthly summary, group daily."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import month_key

DIM_COLUMNS = ("country_name", "continent", "population", "median_age", "gdp_per_capita", "life_expectancy")


def latest_rows(fact: DataFrame, entity: str = "country_id", date: str = "report_date",
                as_of: str | None = None) -> DataFrame:
    """Each entity's rows at its own latest date (ties kept, like the correlated subquery).

    ``rank() == 1`` lets Catalyst put a partial WindowGroupLimit before the
    shuffle, so each map task sends at most the latest rows of each entity.
    """
    f = fact if as_of is None else fact.where(F.col(date) <= F.lit(as_of).cast("date"))
    w = Window.partitionBy(entity).orderBy(F.col(date).desc())
    return f.withColumn("__rk", F.rank().over(w)).where(F.col("__rk") == 1).drop("__rk")


def latest_snapshot(fact: DataFrame, dim: DataFrame, entity: str = "country_id", date: str = "report_date",
                    as_of: str | None = None, columns: Sequence[str] | None = None,
                    dim_columns: Sequence[str] = DIM_COLUMNS) -> DataFrame:
    """V1: fact rows at each entity's max date, joined to the dimension.

    ``columns`` prunes the fact side before the window; ``as_of`` filters
    first (pushed to the scan). The dimension join is left to the planner:
    broadcast when its measured size is under the threshold, shuffle otherwise.
    """
    f = fact if columns is None else fact.select(*dict.fromkeys([entity, date, *columns]))
    latest = latest_rows(f, entity, date, as_of)
    return latest.join(dim.select(entity, *dim_columns), entity)


def monthly_summary(fact: DataFrame, dim: DataFrame, entity: str = "country_id",
                    date: str = "report_date") -> DataFrame:
    """V2: per entity and month: flow sums, ratio means, month-end stock.

    Means of ``positive_rate`` and ``stringency_index`` (4-decimal values) are
    exact decimal sums over the count, so the result does not depend on summation order.
    """
    j = fact.join(dim.select(entity, "country_name", "continent"), entity)
    pr = F.col("positive_rate").cast("decimal(18,4)")
    si = F.col("stringency_index").cast("decimal(18,4)")
    return j.groupBy("country_name", "continent", month_key(date).alias("report_month")).agg(
        F.sum("new_cases").alias("monthly_new_cases"),
        F.sum("new_deaths").alias("monthly_new_deaths"),
        (F.sum(pr).cast("double") / F.count(pr)).alias("avg_positive_rate"),
        (F.sum(si).cast("double") / F.count(si)).alias("avg_stringency_index"),
        F.max("people_fully_vaccinated").alias("end_of_month_fully_vaccinated"),
    )


def group_daily(fact: DataFrame, dim: DataFrame, entity: str = "country_id", date: str = "report_date",
                group: str = "continent") -> DataFrame:
    """V3: per group and date: sums of flows, stocks and population."""
    j = fact.join(dim.select(entity, group, "population"), entity)
    return j.groupBy(group, date).agg(
        F.sum("new_cases").alias("new_cases"),
        F.sum("new_deaths").alias("new_deaths"),
        F.sum("total_cases").alias("total_cases"),
        F.sum("total_deaths").alias("total_deaths"),
        F.sum("population").alias("population"),
    )
