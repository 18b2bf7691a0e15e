"""Chart feeds C1-C6: the data behind the reference's six charts (drawing is not built)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import functions as F

from strata.operators.features import calendar_rolling_mean
from strata.operators.ranking import with_running_sum
from strata.operators.snapshot import latest_snapshot, monthly_summary
from strata.plans.questions import q10_group_ratio_of_sums

E, D = "country_id", "report_date"


def c1_global_trend_7d(fact, k: int = 7):
    """Global daily sums with full-window k-day means (NULL until k days exist).

    The panel is dense (one row per entity and day), so the k-row frame of the
    daily series is the k-calendar-day frame computed by ``calendar_rolling_mean``.
    """
    daily = fact.groupBy(D).agg(F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths"))
    return calendar_rolling_mean(daily, D, {"cases_7d": "new_cases", "deaths_7d": "new_deaths"}, k) \
        .select(D, "new_cases", "new_deaths", "cases_7d", "deaths_7d")


def c2_pareto_curve(fact, dim, n: int = 15):
    """Entities by latest total, descending, with the cumulative share of the global total."""
    v = latest_snapshot(fact, dim, columns=["total_cases"]).select("country_name", "total_cases")
    order = [F.col("total_cases").desc(), F.col("country_name")]
    r = with_running_sum(v, order, "total_cases", "__cum", total_out="__tot")
    return (r.select("country_name", "total_cases",
                     (F.col("__cum") / F.when(F.col("__tot") != 0, F.col("__tot")) * F.lit(100.0)).alias("cum_pct"))
            .orderBy(*order).limit(n))


def c3_bubble_pairs(fact, dim, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["vaccination_rate_pct", "case_fatality_rate"])
    return v.select("country_name", "vaccination_rate_pct", "case_fatality_rate", "gdp_per_capita", "continent",
                    (F.col("gdp_per_capita") / F.lit(400.0)).alias("bubble_size"))


def c4_continent_bars(fact, dim):
    return q10_group_ratio_of_sums(fact, dim, digits=2, with_population=False)


def c5_rollout_lines(fact, dim, names: Sequence[str]):
    d = dim.where(F.col("country_name").isin(*names)).select(E, "country_name")
    return fact.select(E, D, "vaccination_rate_pct").join(d, E) \
        .select("country_name", D, "vaccination_rate_pct").orderBy(D, "country_name")


def c6_month_heatmap(fact, dim, names: Sequence[str]):
    """The entity x month matrix of monthly cases, a column for each month of the data (a calendar's length).

    Two values for one cell (a name with two groups) are refused, as a pivot must not add them up.
    """
    m = monthly_summary(fact, dim).where(F.col("country_name").isin(*names))
    span = fact.agg(F.min(D).alias("lo"), F.max(D).alias("hi")).first()
    months = []
    if span["lo"] is not None:
        y, mo = span["lo"].year, span["lo"].month
        while (y, mo) <= (span["hi"].year, span["hi"].month):
            months.append(f"{y:04d}-{mo:02d}")
            y, mo = (y, mo + 1) if mo < 12 else (y + 1, 1)
    cell = F.max("monthly_new_cases")
    once = F.when(F.count("report_month") > 1, F.raise_error(F.lit("two values for one cell")).cast("bigint")).otherwise(cell)
    return m.groupBy("country_name").pivot("report_month", months).agg(once)
