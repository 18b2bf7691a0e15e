"""Driver-table adapter: a dense entity x day panel from orders / lineitem / customer.

Column names follow the reference's raw panel so every operator and question
reads it unchanged. The entity is the customer's nation by default.

Plan shape (what Catalyst is given):

* lineitem -> one row per order (count, discount in hundredths): partial
  aggregation, one shuffle on ``l_orderkey``.
* orders join customer on the customer key (shuffle join: both grow with the
  data), then the per-order line stats on the order key.
* group to (nation, day): partial aggregation, so the exchange carries at
  most one row per (map task, nation, day).
* each customer's first, tenth and twelfth order (vaccinated, fully, boosted):
  ``row_number() <= 12`` over the customer's orders; Catalyst plans a partial
  ``WindowGroupLimit`` before the shuffle, so even a customer with a third of all
  orders ships 12 rows per map task.
* calendar: each nation explodes min..max order day (scalar subqueries), and the
  day aggregates are left-joined on (nation, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.expr import clip
from strata.operators.features import active_balance, cumulative_total, date_spine_from, momentum_index
from strata.sources.tables import read_table

# FIXED VALUES: labels in the driver tables that the adapter maps to measures.
STATUS_DEATH = "F"
STATUS_RECOVERED = "O"
DOSE_ORDERS = (1, 10, 12)
PRIORITY_ICU = ("1-URGENT",)
PRIORITY_HOSP = ("1-URGENT", "2-HIGH")
SEGMENT_AGE = "BUILDING"


def build_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation: id, name, region, and customer-derived attributes."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    cust = read_table(spark, sf_dir, "customer", ["c_nationkey", "c_acctbal", "c_mktsegment"])
    stats = cust.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("population"),
        (F.lit(100.0) * F.count_if(F.col("c_mktsegment") == SEGMENT_AGE) / F.count(F.lit(1))).alias("median_age"),
        (F.sum(F.col("c_acctbal").cast("decimal(15,2)")).cast("double") / F.count(F.lit(1))).alias("gdp_per_capita"),
        F.max("c_acctbal").alias("life_expectancy"),
    )
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey)
    dim = dim.join(stats, dim.n_nationkey == stats.c_nationkey, "left")
    return dim.select(
        F.col("n_nationkey").cast("bigint").alias("country_id"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("continent"),
        F.coalesce(F.col("population"), F.lit(0)).cast("bigint").alias("population"),
        "median_age",
        "gdp_per_capita",
        "life_expectancy",
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_discount"])
    hundredths = F.round(F.col("l_discount") * F.lit(100.0)).cast("bigint")
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(hundredths).alias("disc_h"))
    # mean discount x 1000 = 10 * hundredths / lines, fixed to 6 decimals so the
    # day average below is an exact decimal sum (independent of summation order)
    v = F.round(F.lit(10.0) * F.col("disc_h") / F.col("n_lines"), 6).cast("decimal(18,6)")
    return per.select("l_orderkey", "n_lines", v.alias("disc_index"))


def daily_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    o = orders.join(cust, orders.o_custkey == cust.c_custkey)
    o = o.join(_order_lines(spark, sf_dir), o.o_orderkey == F.col("l_orderkey"), "left")
    return o.groupBy(F.col("c_nationkey").cast("bigint").alias("country_id"),
                     F.col("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("d_orders"),
        F.count_if(F.col("o_orderstatus") == STATUS_DEATH).alias("d_deaths"),
        F.count_if(F.col("o_orderstatus") == STATUS_RECOVERED).alias("d_recovered"),
        F.coalesce(F.sum("n_lines"), F.lit(0)).alias("d_tests"),
        F.count_if(F.col("o_orderpriority").isin(*PRIORITY_ICU)).alias("d_icu"),
        F.count_if(F.col("o_orderpriority").isin(*PRIORITY_HOSP)).alias("d_hosp"),
        F.bround(F.sum("disc_index").cast("double") / F.count("disc_index"), 4).alias("d_stringency"),
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (nation, day): customers placing the orders that stand for the three doses (DOSE_ORDERS)."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    firsts = orders.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= DOSE_ORDERS[-1])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    j = firsts.join(cust, firsts.o_custkey == cust.c_custkey)
    return j.groupBy(F.col("c_nationkey").cast("bigint").alias("country_id"),
                     F.col("o_orderdate").alias("date")).agg(
        *[F.count_if(F.col("rn") == n).alias(name) for n, name in zip(DOSE_ORDERS, ("d_any", "d_full", "d_boost"))],
    )


def build_raw_panel(spark: SparkSession, sf_dir: str, dim: DataFrame | None = None) -> DataFrame:
    """Dense nation x day panel in the reference's raw layout (before cleaning).

    Gap days: flows 0, stocks carried, ``icu_patients``/``positive_rate``/
    ``stringency_index`` NULL (left for the cleaning operators).
    """
    dim = dim if dim is not None else build_dimension(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    spine = date_spine_from(dim.withColumnRenamed("country_name", "country"), orders, "o_orderdate", "date")

    day = daily_measures(spark, sf_dir)
    vax = first_orders(spark, sf_dir)
    p = spine.join(day, ["country_id", "date"], "left").join(vax, ["country_id", "date"], "left")
    zero = F.lit(0).cast("bigint")
    p = p.select(
        "country_id", "country", "continent", "date", "population", "median_age", "gdp_per_capita",
        "life_expectancy",
        F.coalesce("d_orders", zero).alias("new_cases"),
        F.coalesce("d_deaths", zero).alias("new_deaths"),
        F.coalesce("d_recovered", zero).alias("new_recovered"),
        F.coalesce("d_tests", zero).alias("new_tests"),
        F.coalesce("d_any", zero).alias("new_vaccinated"),
        F.coalesce("d_full", zero).alias("new_fully_vaccinated"),
        F.coalesce("d_boost", zero).alias("new_boosters"),
        F.col("d_icu").alias("icu_patients"),
        F.coalesce("d_hosp", zero).alias("hosp_patients"),
        (F.col("d_orders") / F.when(F.col("d_tests") != 0, F.col("d_tests"))).alias("positive_rate"),
        clip("d_stringency", 0.0, 100.0).alias("stringency_index"),
    )
    p = cumulative_total(p, {
        "total_cases": "new_cases",
        "total_deaths": "new_deaths",
        "total_recovered": "new_recovered",
        "total_tests": "new_tests",
        "people_vaccinated": "new_vaccinated",
        "people_fully_vaccinated": "new_fully_vaccinated",
        "total_boosters": "new_boosters",
    }, entity="country_id", date="date")
    p = active_balance(p, "total_cases", ("total_deaths", "total_recovered"), "active_cases")
    p = momentum_index(p, "new_cases", "reproduction_rate", entity="country_id", date="date")
    return p.drop("new_recovered", "new_vaccinated", "new_fully_vaccinated", "new_boosters")
