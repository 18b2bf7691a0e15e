"""The 25 panel questions (Q1-Q25) as DataFrame plans over (fact, dim).

Each takes the fact and dimension frames plus its parameters and returns a
lazy DataFrame. Ordered top-k results end their sort with the entity name so
ties under LIMIT resolve the same way every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import bucket, month_key, pct, year_key
from strata.operators.ranking import with_group_rank, with_ntile, with_running_sums
from strata.operators.snapshot import latest_snapshot, monthly_summary

E, D = "country_id", "report_date"

# FIXED VALUES: labels and default bucket edges of the questions.
TREND_LABELS = ("RISING", "FALLING", "FLAT")
STRINGENCY_EDGES = (40, 65)
STRINGENCY_LABELS = ("1. Low stringency", "2. Medium stringency", "3. High stringency")
GDP_EDGES = (5000, 20000, 50000)
AGE_EDGES = (25, 35, 42)
GDP_LABELS = ("1. Low GDP (<$5k)", "2. Mid GDP ($5k-$20k)", "3. High GDP ($20k-$50k)", "4. Very High GDP ($50k+)")
AGE_LABELS = ("1. Young (<25)", "2. Mid (25-35)", "3. Older (35-42)", "4. Oldest (42+)")


def _dec_avg(c: str, scale: int):
    """Mean of a ``scale``-decimal column as exact decimal sum / count."""
    x = F.col(c).cast(f"decimal(18,{scale})")
    return F.sum(x).cast("double") / F.count(x)


def q01_top_per_million(fact, dim, n=10):
    v = latest_snapshot(fact, dim, columns=["cases_per_million"])
    return (v.select("country_name", "continent", F.round("cases_per_million", 1).alias("cases_per_million"))
            .orderBy(F.col("cases_per_million").desc(), "country_name").limit(n))


def q02_global_running_total(fact, n=10):
    """Daily sums, then running totals along the date axis.

    The running sums use the two-phase global prefix (range slices + offsets),
    not ``SUM() OVER (ORDER BY date)``, which would put the series in one task.
    """
    daily = fact.groupBy(D).agg(F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths"))
    run = with_running_sums(daily, [F.col(D)], {"running_total_cases": "new_cases",
                                                "running_total_deaths": "new_deaths"})
    return run.select(D, "running_total_cases", "running_total_deaths").orderBy(F.col(D).desc()).limit(n)


def q03_rank_in_group(fact, dim, n=20):
    v = latest_snapshot(fact, dim, columns=["deaths_per_million"]).select("continent", "country_name", "deaths_per_million")
    r = with_group_rank(v, ["continent"], ["deaths_per_million"],
                        [F.col("deaths_per_million").desc(), F.col("country_name")], "continent_rank")
    return r.orderBy("continent", "continent_rank", "country_name").limit(n)


def q04_pareto_quintiles(fact, dim, k=5):
    v = latest_snapshot(fact, dim, columns=["total_cases"]).select("country_name", "total_cases")
    total = v.select(F.sum("total_cases")).scalar()
    t = with_ntile(v, [F.col("total_cases").desc(), F.col("country_name")], k, "quintile")
    return t.groupBy("quintile").agg(
        F.count(F.lit(1)).alias("n_countries"),
        F.sum("total_cases").alias("quintile_total_cases"),
        F.round(pct(F.sum("total_cases"), total), 1).alias("pct_of_global_cases"),
    ).orderBy("quintile")


def q05_moving_avg_30(fact, dim, names: Sequence[str], n=15, k=30):
    d = dim.where(F.col("country_name").isin(*names)).select(E, "country_name")
    f = fact.select(E, D, "new_cases").join(d, E)
    w = Window.partitionBy("country_name").orderBy(D).rowsBetween(-(k - 1), 0)
    return (f.select("country_name", D, F.avg("new_cases").over(w).alias("moving_avg_30d"))
            .orderBy("country_name", F.col(D).desc()).limit(n))


def q06_avg_monthly_gain(fact, dim, n=10):
    f = fact.select(E, D, "vaccination_rate_pct").join(dim.select(E, "country_name"), E)
    monthly = f.groupBy("country_name", month_key(D).alias("ym")).agg(
        F.max("vaccination_rate_pct").alias("month_end_vax_pct"))
    w = Window.partitionBy("country_name").orderBy("ym")
    x = F.col("month_end_vax_pct").cast("decimal(12,2)")
    deltas = monthly.withColumn("monthly_gain", x - F.lag(x).over(w))
    gain = F.sum("monthly_gain").cast("double") / F.count("monthly_gain")
    return (deltas.where(F.col("monthly_gain").isNotNull()).groupBy("country_name")
            .agg(F.round(gain, 2).alias("avg_monthly_vax_gain_pct"))
            .orderBy(F.col("avg_monthly_vax_gain_pct").desc(), "country_name").limit(n))


def q07_snapshot_pairs(fact, dim, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["vaccination_rate_pct", "case_fatality_rate"])
    return v.select("country_name", "vaccination_rate_pct", "case_fatality_rate", "gdp_per_capita", "median_age") \
        .orderBy(F.col("vaccination_rate_pct").desc(), "country_name")


def q08_avg_growth_having(fact, dim, start: str, end: str, n=10):
    f = fact.where(F.col(D).between(F.lit(start).cast("date"), F.lit(end).cast("date"))) \
        .select(E, "case_growth_wow_pct").join(dim.select(E, "country_name"), E)
    g = f.groupBy("country_name").agg(_dec_avg("case_growth_wow_pct", 2).alias("__avg"))
    return (g.where(F.col("__avg").isNotNull())
            .select("country_name", F.round("__avg", 2).alias("avg_wow_growth_pct"))
            .orderBy(F.col("avg_wow_growth_pct").desc(), "country_name").limit(n))


def q09_monthly_global(fact):
    return fact.groupBy(month_key(D).alias("month")).agg(
        F.sum("new_cases").alias("total_new_cases"), F.sum("new_deaths").alias("total_new_deaths")).orderBy("month")


def q10_group_ratio_of_sums(fact, dim, digits=3, with_population=True, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["total_cases", "total_deaths"])
    aggs = [F.sum("total_cases").alias("total_cases"), F.sum("total_deaths").alias("total_deaths"),
            F.round(pct(F.sum("total_deaths"), F.sum("total_cases")), digits).alias(
                "continent_cfr_pct" if with_population else "cfr")]
    if with_population:
        aggs.append(F.sum("population").alias("population"))
    return v.groupBy("continent").agg(*aggs).orderBy(F.col("total_cases").desc(), "continent")


def q11_below_threshold(fact, dim, threshold=50.0, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["vaccination_rate_pct"])
    return (v.where(F.col("vaccination_rate_pct") < threshold)
            .select("country_name", F.round("vaccination_rate_pct", 1).alias("vaccination_rate_pct"))
            .orderBy("vaccination_rate_pct", "country_name"))


def never_crossed(fact, dim, value="vaccination_rate_pct", threshold=50.0, as_of=None):
    """General form of Q11: entities whose maximum never reached the threshold."""
    f = fact if as_of is None else fact.where(F.col(D) <= F.lit(as_of).cast("date"))
    m = f.groupBy(E).agg(F.max(value).alias("max_value")).where(F.col("max_value") < threshold)
    return m.join(dim.select(E, "country_name"), E).select("country_name", "max_value")


def q12_wave_direction(fact, dim, name: str | None = None):
    """Monthly totals and the direction against the prior month, per entity."""
    d = dim.select(E, "country_name")
    if name is not None:
        d = d.where(F.col("country_name") == name)
    f = fact.select(E, D, "new_cases").join(d, E)
    m = f.groupBy("country_name", month_key(D).alias("ym")).agg(F.sum("new_cases").alias("monthly_cases"))
    prev = F.lag("monthly_cases").over(Window.partitionBy("country_name").orderBy("ym"))
    rising, falling, flat = TREND_LABELS
    trend = (F.when(F.col("monthly_cases") > prev, rising).when(F.col("monthly_cases") < prev, falling)
             .otherwise(flat))
    out = m.withColumn("trend_direction", trend)
    cols = ["ym", "monthly_cases", "trend_direction"] if name is not None else ["country_name", "ym", "monthly_cases", "trend_direction"]
    return out.select(*cols).orderBy(*cols[:-2])


def q13_level_per_million(fact, dim, n=5):
    v = latest_snapshot(fact, dim, columns=["icu_patients"])
    per = F.round(F.lit(1_000_000.0) * F.col("icu_patients") / F.when(F.col("population") != 0, F.col("population")), 2)
    return (v.select("country_name", "icu_patients", "population", per.alias("icu_per_million"))
            .orderBy(F.col("icu_per_million").desc_nulls_last(), "country_name").limit(n))


def cohort_summary(v: DataFrame, value: str, edges, labels, name: str, aggs) -> DataFrame:
    return v.groupBy(bucket(value, edges, labels).alias(name)).agg(*aggs).orderBy(name)


def q14_gdp_cohorts(fact, dim, edges=GDP_EDGES, labels=None, as_of=None):
    labels = labels or (GDP_LABELS if tuple(edges) == GDP_EDGES else _labels("GDP", edges))
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["vaccination_rate_pct", "case_fatality_rate"])
    return cohort_summary(v, "gdp_per_capita", edges, labels, "gdp_bucket", [
        F.count(F.lit(1)).alias("n_countries"),
        F.round(_dec_avg("vaccination_rate_pct", 2), 1).alias("avg_vaccination_rate_pct"),
        F.round(_dec_avg("case_fatality_rate", 3), 3).alias("avg_cfr")])


def q15_age_cohorts(fact, dim, edges=AGE_EDGES, labels=None, as_of=None):
    labels = labels or (AGE_LABELS if tuple(edges) == AGE_EDGES else _labels("Age", edges))
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["case_fatality_rate"])
    return cohort_summary(v, "median_age", edges, labels, "age_bucket", [
        F.count(F.lit(1)).alias("n_countries"),
        F.round(_dec_avg("case_fatality_rate", 3), 3).alias("avg_cfr"),
        F.round(_dec_avg("life_expectancy", 2), 1).alias("avg_life_expectancy")])


def _labels(what: str, edges) -> list[str]:
    e = [f"{x:g}" for x in edges]
    out = [f"1. {what} < {e[0]}"]
    out += [f"{i + 2}. {what} {a}-{b}" for i, (a, b) in enumerate(zip(e, e[1:]))]
    out.append(f"{len(e) + 1}. {what} {e[-1]}+")
    return out


def q16_bottom_testing(fact, dim, n=10):
    v = latest_snapshot(fact, dim, columns=["testing_rate_pct", "cases_per_million"])
    return (v.select("country_name", F.round("testing_rate_pct", 1).alias("testing_rate_pct"),
                     F.round("cases_per_million", 1).alias("cases_per_million"))
            .orderBy("testing_rate_pct", "country_name").limit(n))


def peak_rows(fact, dim, value="new_cases"):
    """Every row where ``value`` equals the entity's maximum (ties kept).

    The per-entity max is an aggregate (partial aggregation) joined back on
    (entity, max value) - Catalyst's own plan for the correlated subquery.
    """
    m = fact.groupBy(E).agg(F.max(value).alias("__peak"))
    j = fact.select(E, D, value).join(m, (fact[E] == m[E]) & (fact[value] == m["__peak"])).drop(m[E])
    return j.join(dim.select(E, "country_name"), E).select(
        "country_name", F.col(D).alias("peak_date"), F.col(value).alias("peak_new_cases"))


def q17_peak_day(fact, dim, n=10):
    return peak_rows(fact, dim).orderBy(F.col("peak_new_cases").desc(), "country_name", "peak_date").limit(n)


def q18_stringency_cohorts(fact, edges=STRINGENCY_EDGES, labels=STRINGENCY_LABELS, lead_days: int = 0):
    """Mean growth per stringency bucket over entity-days with known growth.

    ``lead_days=0`` is the reference's same-day comparison; ``lead_days=n``
    pairs each day's stringency with the growth ``n`` rows (days) later in the
    same entity's series (the "following month" the question asks about).
    """
    f = fact
    if lead_days:
        w = Window.partitionBy(E).orderBy(D)
        f = f.withColumn("case_growth_wow_pct", F.lead("case_growth_wow_pct", lead_days).over(w))
    f = f.where(F.col("case_growth_wow_pct").isNotNull())
    return f.groupBy(bucket("stringency_index", edges, labels).alias("stringency_bucket")).agg(
        F.round(_dec_avg("case_growth_wow_pct", 2), 2).alias("avg_wow_case_growth_pct"),
        F.count(F.lit(1)).alias("n_observations")).orderBy("stringency_bucket")


def q19_stock_ratio(fact, dim, n=10, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["total_boosters", "people_fully_vaccinated"])
    return (v.where(F.col("people_fully_vaccinated") > 0)
            .select("country_name", F.round(pct("total_boosters", "people_fully_vaccinated"), 1)
                    .alias("booster_pct_of_fully_vaxxed"))
            .orderBy(F.col("booster_pct_of_fully_vaxxed").desc(), "country_name").limit(n))


def q20_year_pivot(fact, years=(2021, 2022)):
    y = year_key(D)
    aggs = []
    for m, src in (("cases", "new_cases"), ("deaths", "new_deaths")):
        for yr in years:
            aggs.append(F.sum(F.when(y == yr, F.col(src)).otherwise(F.lit(0))).alias(f"{m}_{yr}"))
    return fact.agg(*aggs)


def q21_count_above(fact, dim, threshold=1.2):
    f = fact.where(F.col("reproduction_rate") > threshold).select(E).join(dim.select(E, "continent"), E)
    return f.groupBy("continent").agg(F.count(F.lit(1)).alias("days_with_rt_above_1_2")) \
        .orderBy(F.col("days_with_rt_above_1_2").desc(), "continent")


def q22_recovery_rate(fact, dim, n=10):
    v = latest_snapshot(fact, dim, columns=["total_recovered", "total_cases", "case_fatality_rate"])
    return (v.select("country_name", F.round(pct("total_recovered", "total_cases"), 2).alias("recovery_rate_pct"),
                     F.round("case_fatality_rate", 3).alias("case_fatality_rate"))
            .orderBy(F.col("recovery_rate_pct").desc_nulls_last(), "country_name").limit(n))


def q23_global_kpis(fact, dim, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["total_cases", "total_deaths", "total_recovered",
                                                         "active_cases", "vaccination_rate_pct"])
    return v.agg(
        F.sum("total_cases").alias("global_total_cases"),
        F.sum("total_deaths").alias("global_total_deaths"),
        F.sum("total_recovered").alias("global_total_recovered"),
        F.sum("active_cases").alias("global_active_cases"),
        F.round(pct(F.sum("total_deaths"), F.sum("total_cases")), 3).alias("global_cfr_pct"),
        F.round(_dec_avg("vaccination_rate_pct", 2), 1).alias("avg_country_vaccination_rate_pct"),
    )


def q24_above_global_avg(fact, dim, coverage=60.0, as_of=None):
    """Outliers: high coverage and a rate above the mean over entities.

    The mean is a scalar subquery (computed once, used as a value), not a
    cross join.
    """
    v = latest_snapshot(fact, dim, as_of=as_of, columns=["vaccination_rate_pct", "case_fatality_rate"])
    avg_cfr = v.select(_dec_avg("case_fatality_rate", 3)).scalar()
    return (v.where((F.col("vaccination_rate_pct") > coverage) & (F.col("case_fatality_rate") > avg_cfr))
            .select("country_name", "vaccination_rate_pct", "case_fatality_rate", "median_age")
            .orderBy(F.col("case_fatality_rate").desc(), "country_name"))


def q25_monthly_view_slice(fact, dim, name: str):
    m = monthly_summary(fact, dim).where(F.col("country_name") == name)
    return m.select("report_month", "monthly_new_cases", "monthly_new_deaths",
                    F.round("avg_positive_rate", 3).alias("avg_positive_rate")).orderBy("report_month")
