"""Published metrics (R1-R6) and the described patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import pct
from strata.operators import stats
from strata.operators.ranking import with_rank_variants
from strata.operators.snapshot import latest_snapshot
from strata.plans.questions import q20_year_pivot, q23_global_kpis

E, D = "country_id", "report_date"

PAIRS = (
    ("gdp_per_capita", "vaccination_rate_pct"),
    ("vaccination_rate_pct", "case_fatality_rate"),
    ("gdp_per_capita", "case_fatality_rate"),
    ("median_age", "case_fatality_rate"),
    ("testing_rate_pct", "cases_per_million"),
)
SNAP_COLS = ["vaccination_rate_pct", "case_fatality_rate", "testing_rate_pct", "cases_per_million",
             "deaths_per_million"]


def r1_pearson_pairs(fact, dim, as_of=None, pairs=PAIRS, digits=3):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=SNAP_COLS)
    return stats.pearson_pairs(v, pairs, digits)


def r2_pearson_p_value(fact, dim, as_of=None, pairs=PAIRS):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=SNAP_COLS)
    return stats.pearson_p_values(stats.pearson_pairs(v, pairs, None))


def r3_yoy_change_pct(fact, years=(2021, 2022), digits=1):
    a, b = years
    y = q20_year_pivot(fact, years)

    def change(m):
        return F.round((F.col(f"{m}_{b}") / F.when(F.col(f"{m}_{a}") != 0, F.col(f"{m}_{a}")) - F.lit(1.0))
                       * F.lit(100.0), digits)
    return y.select(change("cases").alias("cases_yoy_pct"), change("deaths").alias("deaths_yoy_pct"))


def r4_share_below(fact, dim, value="vaccination_rate_pct", threshold=50.0, as_of=None):
    v = latest_snapshot(fact, dim, as_of=as_of, columns=[value])
    return v.agg(F.count_if(F.col(value) < threshold).alias("n_below"), F.count(F.lit(1)).alias("n_total")) \
        .withColumn("share_pct", F.round(pct("n_below", "n_total"), 1))


LEADER_KPIS = (
    ("max_cases_per_million", "cases_per_million", "max"),
    ("max_deaths_per_million", "deaths_per_million", "max"),
    ("max_case_fatality_rate", "case_fatality_rate", "max"),
    ("min_case_fatality_rate", "case_fatality_rate", "min"),
    ("max_testing_rate_pct", "testing_rate_pct", "max"),
)


def r5_kpi_leaders(fact, dim, kpis=LEADER_KPIS, as_of=None):
    """Entities at each KPI's extreme; ties are all listed.

    The extremes are one aggregate row used as a scalar subquery; each entity's
    values are compared with it in place, so nothing is shuffled by KPI.
    """
    v = latest_snapshot(fact, dim, as_of=as_of, columns=SNAP_COLS)
    best = v.select(F.create_map(*[c for label, col, how in kpis for c in (
        F.lit(label), (F.max if how == "max" else F.min)(F.col(col).cast("double")))])).scalar()
    items = [F.struct(F.lit(label).alias("kpi"), F.col(col).cast("double").alias("value")) for label, col, _ in kpis]
    long = v.select("country_name", F.explode(F.array(*items)).alias("x"))
    return long.where(F.col("x.value") == F.element_at(best, F.col("x.kpi"))).select("x.kpi", "country_name", "x.value")


def r6_kpi_table(fact, dim, as_of=None):
    k = q23_global_kpis(fact, dim, as_of)
    cols = k.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return k.selectExpr(f"stack({len(cols)}, {pairs}) as (label, value)").withColumn("query_id", F.lit("Q23"))


# ---------------------------------------------------------------- P1-P10
def p1_top_n_per_group(fact, dim, value="cases_per_million", group="continent", n=3):
    """rank() <= n per group: Catalyst keeps only the top n per group in each map task."""
    v = latest_snapshot(fact, dim, columns=[value])
    w = Window.partitionBy(group).orderBy(F.col(value).desc())
    return v.withColumn("rk", F.rank().over(w)).where(F.col("rk") <= n) \
        .select(group, "country_name", value, F.col("rk").cast("bigint").alias("rk"))


def p2_rank_variants(fact, dim, value="population"):
    """RANK / DENSE_RANK / ROW_NUMBER over all entities, without a single-partition window."""
    v = latest_snapshot(fact, dim, columns=[]).select("country_name", value)
    order = [F.col(value).desc(), F.col("country_name")]
    r = with_rank_variants(v, [value], order)
    return r.select("country_name", value, "rnk", "dense_rnk", "row_num")


def p3_find_duplicates(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def p4_peak_by_window(fact, dim, value="new_cases"):
    """MAX() OVER (PARTITION BY entity) + filter; a partition is one entity's days (calendar-bounded)."""
    w = Window.partitionBy(E)
    f = fact.select(E, D, value).withColumn("__peak", F.max(value).over(w)).where(F.col(value) == F.col("__peak"))
    return f.join(dim.select(E, "country_name"), E).select(
        "country_name", F.col(D).alias("peak_date"), F.col(value).alias("peak_new_cases"))


def p5_moving_avg_7(fact, dim, value="new_cases", k=7):
    w = Window.partitionBy(E).orderBy(D).rowsBetween(-(k - 1), 0)
    f = fact.select(E, D, F.avg(value).over(w).alias("moving_avg_7d"))
    return f.join(dim.select(E, "country_name"), E).select("country_name", D, "moving_avg_7d")


def p6_before_after_profile(raw: DataFrame, fact: DataFrame):
    """Counts and sums before and after cleaning, joined on the metric name."""
    def prof(df):
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("new_cases").alias("sum_new_cases"),
            F.count_if(F.col("positive_rate").isNull()).alias("null_positive_rate"),
            F.count_if(F.col("icu_patients").isNull()).alias("null_icu_patients"),
            F.sum("icu_patients").cast("bigint").alias("sum_icu_patients"),
        ).selectExpr("stack(5, 'rows', rows, 'sum_new_cases', sum_new_cases, 'null_positive_rate', null_positive_rate,"
                     " 'null_icu_patients', null_icu_patients, 'sum_icu_patients', sum_icu_patients) as (metric, v)")
    return prof(raw).withColumnRenamed("v", "before").join(prof(fact).withColumnRenamed("v", "after"), "metric")


def p6_before_after_means(raw: DataFrame, fact: DataFrame, dim: DataFrame, group: str = "continent",
                          metrics: Sequence[str] = ("new_cases", "new_deaths", "positive_rate", "icu_patients")):
    """Group means of the metrics before and after cleaning, and their change in percent of the mean before."""
    def means(df, when):
        rows = df.select(E, *metrics).join(dim.select(E, group), E).unpivot(group, list(metrics), "metric", "v")
        return rows.groupBy(group, "metric").agg(F.count("v").alias(f"n_{when}"), (F.sum("v").cast("double") / F.when(F.count("v") > 0, F.count("v"))).alias(f"mean_{when}"))

    def exact(df):  # sums of decimals do not depend on the order of rows
        return df.select(E, *[F.col(m).try_cast("decimal(30,6)").alias(m) for m in metrics])

    both = means(exact(raw), "before").join(means(exact(fact), "after"), [group, "metric"], "full")
    both = both.withColumns({c: F.round(F.col(c), 6) for c in ("mean_before", "mean_after")})
    change = (F.col("mean_after") - F.col("mean_before")) / F.when(F.col("mean_before") != 0, F.col("mean_before"))
    return both.withColumn("change_pct", F.round(change * F.lit(100.0), 4))


def p7_median_vs_mean(fact, dim, value="new_cases", group="continent"):
    f = fact.select(E, value).join(dim.select(E, group), E)
    return stats.distribution(f, value, group)


def p8_profile_table(fact, columns=None):
    return stats.profile_table(fact, columns)


def p8_profile_distribution(fact, columns=None):
    return stats.profile_distribution(fact, columns)


def p9_incremental_upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], load_col: str = "load_id"):
    """Merge a newer load into a table: per key the row of the latest load wins, and of two rows of one load
    the larger by the other columns in turn. Columns that the delta lacks keep the base's value of their key;
    columns that only the delta has are NULL in rows of the base.

    ``row_number() == 1`` per key (partial WindowGroupLimit before the shuffle).
    """
    kept = [c for c in base.columns if c not in delta.columns]
    won = _winners(base.unionByName(delta, allowMissingColumns=True), keys, load_col)
    if not kept:
        return won
    own = _winners(base, keys, load_col).select(*[F.col(c).alias(f"__b_{c}") for c in (*keys, *kept)])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    return won.join(own, same, "left").select(*[F.col(f"__b_{c}").alias(c) if c in kept else F.col(c) for c in won.columns])


def _winners(rows: DataFrame, keys: Sequence[str], load_col: str) -> DataFrame:
    rest = [F.col(c).desc() for c in rows.columns if c not in keys and c != load_col]
    w = Window.partitionBy(*keys).orderBy(F.col(load_col).desc(), *rest)
    return rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


RESTATED = 1000


def p9_demo(fact, cutoff="1998-12-31", delta_from="1998-07-01"):
    cols = [E, D, "new_cases", "total_cases", "icu_patients"]
    base = fact.where(F.col(D) <= F.lit(cutoff).cast("date")).select(*cols, F.lit(1).alias("load_id"))
    delta = fact.where(F.col(D) >= F.lit(delta_from).cast("date")).select(*cols, F.lit(2).alias("load_id"))
    delta = delta.withColumn("new_cases", F.col("new_cases") + RESTATED)  # the newer load corrects the older
    return p9_incremental_upsert(base, delta, [E, D])


def p10_flow_stock_reconcile(fact, dim, flow="new_cases", stock="total_cases"):
    r = fact.groupBy(E).agg(F.sum(flow).alias("sum_flow"), F.max_by(stock, D).alias("last_stock"))
    return r.join(dim.select(E, "country_name"), E).select(
        "country_name", "sum_flow", "last_stock", (F.col("last_stock") - F.col("sum_flow")).alias("difference"))
