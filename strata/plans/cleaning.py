"""Cleaning (E1-E26) and generator-derived (G1-G19) operators applied to the driver tables.

The driver tables already carry the dirt each operator exists for (FIXTURES
section 3): repeated lineitem keys, negative balances, gap days in the panel,
orders without line items. Every plan reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expr import md5_fraction_below
from strata.operators import clean as C
from strata.operators import features as G
from strata.operators import ranking as RK
from strata.operators import star as S
from strata.sources.tables import read_table

K, DT = "country_id", "date"

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus"]
# FIXED VALUES: order-status labels used by the label-mapping example.
STATUS_LABELS = {"F": "FULFILLED", "O": "OPEN"}


def _t(spark, sf, name, cols=None):
    return read_table(spark, sf, name, cols)


# ---------------------------------------------------------------- E on driver tables
def e1_standardize_names(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    padded = o.withColumn("priority_label", F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\t")))
    return C.standardize_names(padded, "priority_label").select("o_orderkey", "priority_label")


def e2_map_labels(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus"])
    return C.map_labels(o, "o_orderstatus", STATUS_LABELS, "status_label").select("o_orderkey", "status_label")


def e3_distinct_label_audit(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    return C.distinct_label_audit(c, C.standardize_names(c, "c_mktsegment"), "c_mktsegment")


def e4_dedupe_keep_first(spark, sf):
    li = _t(spark, sf, "lineitem")
    return C.dedupe_keep_first(li, LINEITEM_KEY, LINEITEM_ORDER)


def e5_floor_negatives(spark, sf):
    return C.floor_negatives(_t(spark, sf, "customer", ["c_custkey", "c_acctbal"]), ["c_acctbal"])


def e5_negative_audit(spark, sf):
    return C.negative_audit(_t(spark, sf, "customer", ["c_acctbal"]), ["c_acctbal"])


def e6_clip_range(spark, sf, lo=0.0, hi=5000.0):
    return C.clip_range(_t(spark, sf, "customer", ["c_custkey", "c_acctbal"]), "c_acctbal", lo, hi)


def e18_row_audit(spark, sf):
    """Rows before and after the dedupe, counted by the one run of it (``observe``)."""
    before, seen = C.row_audit(_t(spark, sf, "lineitem"), "input")
    after, left = C.row_audit(C.dedupe_keep_first(before, LINEITEM_KEY, LINEITEM_ORDER), "deduplicated")
    after.write.format("noop").mode("overwrite").save()
    rows = [("input", seen.get["rows"]), ("deduplicated", left.get["rows"])]
    return spark.createDataFrame(rows, "step string, n_rows bigint")


def dirty_panel(spark, sf):
    """Orders as a panel that breaks every check: repeated (customer, day), unknown and negative flows,
    unknown and too large stocks."""
    o = _t(spark, sf, "orders", ["o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    price = F.col("o_totalprice")
    return o.select(F.col("o_custkey").alias("country"), F.col("o_orderdate").alias("date"),
                    F.when(F.col("o_orderstatus") != "P", price - 20000).alias("new_cases"), price.alias("total_deaths"),
                    F.when(price < 400000, F.lit(150000.0)).alias("total_cases"))


def e17_validate_dirty(spark, sf):
    return C.validate_panel(dirty_panel(spark, sf))


def e24_constraints_dirty(spark, sf):
    """Orders against the customers in credit, whose market segment is taken for a unique name."""
    c = _t(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"]).where("c_acctbal > 0")
    dim = c.select(F.col("c_custkey").alias("country"), F.col("c_mktsegment").alias("name"))
    return C.constraint_checks(dirty_panel(spark, sf), dim, "country", "date", "name",
                               not_null=("country", "date", "new_cases", "total_cases"), dim_not_null=("name",))


def e19_drift_orders(spark, sf):
    o = _t(spark, sf, "orders", ["o_custkey", "o_orderpriority"])
    return S.attribute_drift(o, "o_custkey", ("o_orderpriority",))


def e21_unmatched_some(spark, sf):
    o = _t(spark, sf, "orders", ["o_custkey"])
    c = _t(spark, sf, "customer", ["c_custkey", "c_acctbal"]).where("c_acctbal > 0").select("c_custkey")
    return S.unmatched_keys(o, c, "o_custkey", "c_custkey")


def _with_nulls(spark, sf):
    c = _t(spark, sf, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    return c.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
                    F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 500)).cast("bigint").alias("level"))


def rank_with_nulls(spark, sf):
    order = [F.col("level").desc(), F.col("c_custkey")]
    r = RK.with_rank_variants(_with_nulls(spark, sf), ["level"], order)
    return RK.with_group_rank(r, ["segment"], ["level"], order, "segment_rank")


def running_sum_with_nulls(spark, sf):
    r = RK.with_running_sums(_with_nulls(spark, sf), [F.col("c_custkey")], {"running": "level"})
    return RK.with_running_sums(r, [F.col("c_custkey")], {"segment_running": "level"}, by=["segment"])


def e20_assign_surrogate_key(fact, dim):
    f = fact.select("country_id", "report_date").join(dim.select("country_id", "country_name"), "country_id")
    return S.assign_surrogate_key(f, ["country_name", "report_date"], "fact_id") \
        .select("fact_id", "country_id", "report_date")


def e21_lookup_key(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = _t(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    return S.lookup_key(o, c, "o_custkey", "c_custkey", "c_nationkey").select("o_orderkey", "c_nationkey")


def e21_unmatched(spark, sf):
    o = _t(spark, sf, "orders", ["o_custkey"])
    c = _t(spark, sf, "customer", ["c_custkey"])
    return S.unmatched_keys(o, c, "o_custkey", "c_custkey")


def e23_normalize_date(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return S.normalize_date(o, "o_orderdate", "order_day", as_text=True).select("o_orderkey", "order_day")


# ---------------------------------------------------------------- E on the raw panel
def panel_ops(raw: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Each cleaning/feature operator applied alone to the raw adapter panel (built on demand)."""
    keys = [K, DT]
    out = {
        "null_audit": lambda: C.null_audit(raw),
        "recompute_missing_ratio": lambda: C.recompute_missing_ratio(raw, "positive_rate", "new_cases", "new_tests")
        .select(*keys, "positive_rate"),
        "fill_series_gaps": lambda: C.round_to_int(C.fill_series_gaps(raw, ["icu_patients"], K, DT), ["icu_patients"])
        .select(*keys, "icu_patients"),
        "round_to_int": lambda: C.round_to_int(raw.select(*keys, "stringency_index"), ["stringency_index"]),
        "sort_panel": lambda: C.sort_panel(raw.select(*keys, "new_cases"), K, DT),
        "fatality_rate": lambda: G.fatality_rate(raw).select(*keys, "case_fatality_rate"),
        "per_million": lambda: G.per_million(G.per_million(raw, "total_cases", out="cases_per_million"),
                                     "total_deaths", out="deaths_per_million")
        .select(*keys, "cases_per_million", "deaths_per_million"),
        "coverage_pct": lambda: G.coverage_pct(G.coverage_pct(raw, "people_fully_vaccinated", out="vaccination_rate_pct"),
                                       "total_tests", out="testing_rate_pct", cap=False)
        .select(*keys, "vaccination_rate_pct", "testing_rate_pct"),
        "rolling_mean_7": lambda: G.rolling_mean(raw, "new_cases", "new_cases_7day_avg", 7, 1, K, DT, 1)
        .select(*keys, "new_cases_7day_avg"),
        "growth_wow": lambda: G.growth_wow(G.rolling_mean(raw, "new_cases", "avg7", 7, 1, K, DT, 1), "avg7", "growth", 7, K, DT)
        .select(*keys, "growth"),
        "extract_dimension": lambda: S.extract_dimension(raw),
        "attribute_drift": lambda: S.attribute_drift(raw),
        "project_rename": lambda: S.project_rename(
            raw, columns=["report_date" if c == DT else c for c in raw.columns]),
        "cumulative_total": lambda: G.cumulative_total(raw.select(*keys, "new_cases"), {"running_cases": "new_cases"}, K, DT),
        "lag_zero": lambda: G.lag_zero(raw.select(*keys, "new_cases"), "new_cases", 12, "lagged_cases", K, DT),
        "elementwise_min_max": lambda: raw.select(*keys, G.elementwise_min("total_recovered", "total_cases").alias("capped"),
                                          G.elementwise_max("new_deaths", "new_tests").alias("wider")),
        "active_balance": lambda: G.active_balance(raw.select(*keys, "total_cases", "total_deaths", "total_recovered"),
                                           out="active").select(*keys, "active"),
        "pct_change_1": lambda: G.pct_change_1(raw.select(*keys, "new_cases"), "new_cases", "chg", K, DT),
        "momentum_index": lambda: G.momentum_index(raw.select(*keys, "new_cases"), "new_cases", "rt", entity=K, date=DT),
        "rolling_mean_k": lambda: G.rolling_mean(raw, "new_cases", "avg3", 3, 1, K, DT).select(*keys, "avg3"),
        "rolling_mean_full": lambda: G.rolling_mean(raw, "new_cases", "avg7_full", 7, 7, K, DT).select(*keys, "avg7_full"),
        "share_of_entity_max": lambda: G.share_of_entity_max(raw.select(*keys, "new_cases"), "new_cases", "share_max", K),
        "share_of_entity_total": lambda: G.share_of_entity_total(raw.select(*keys, "new_cases"), "new_cases", "share_total", K),
        "per_capita_share": lambda: G.share_to_count(
            G.per_capita_share(raw.select(*keys, "people_fully_vaccinated", "population"),
                               "people_fully_vaccinated", out="share"), "share", out="back_to_count")
        .select(*keys, "share", "back_to_count"),
    }
    return out


def g5_safe_ratio(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    li = _t(spark, sf, "lineitem", ["l_orderkey"]).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.select("o_orderkey", G.safe_ratio(F.col("o_totalprice"), F.coalesce("n_lines", F.lit(0)), 4)
                    .alias("price_per_line"))


def g9_weekday_factor(spark, sf):
    e = _t(spark, sf, "events", ["event_id", "ts", "value"])
    e = e.withColumn("weekday", F.weekday("ts").cast("bigint"))
    return G.weekday_factor(e, "ts", "value", "adjusted_value").select("event_id", "weekday", "adjusted_value")


def g9_weekday_seasonality(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderdate"]).withColumn("one", F.lit(1))
    daily = o.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("n"))
    return G.weekday_seasonality(daily, "o_orderdate", "n").withColumn("weekday", F.col("weekday").cast("bigint"))


def g10_top_share_tier(dim):
    return G.top_share_tier(dim.select("country_name", "population"), "population", "country_name")


def g14_complement_rate_proxy(fact):
    f = fact.select("country_id", "report_date", "active_cases",
                    (F.col("vaccination_rate_pct") / F.lit(100.0)).alias("coverage"))
    return G.complement_rate_proxy(f, "active_cases", "coverage", 0.015, 0.01, 0.003, 0.02, "icu_proxy") \
        .select("country_id", "report_date", "icu_proxy")


def g15_date_spine(spark, sf, dim):
    orders = _t(spark, sf, "orders", ["o_orderdate"])
    return G.date_spine_from(dim.select("country_id"), orders, "o_orderdate", "report_date")


def g16_sample_rows(spark, sf, fraction=0.1):
    li = _t(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    return li.where(md5_fraction_below(["l_orderkey", "l_linenumber"], fraction))


def g17_concat_rows(spark, sf):
    """Whole frames one after the other: every order's and every event's key and day."""
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    e = _t(spark, sf, "events", ["event_id", "ts"])
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("day")).unionByName(
        e.select(F.col("event_id").alias("key"), F.col("ts").cast("date").alias("day")))


def g18_conditional_update(spark, sf):
    o = _t(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    s = F.col("o_orderstatus")
    return o.select(
        "o_orderkey",
        F.when(s == "P", F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("price_or_null"),
        F.when(s == "F", F.concat(F.upper("o_orderpriority"), F.lit("  "))).otherwise(F.col("o_orderpriority"))
        .alias("priority_label"),
        F.when(s == "O", -F.abs("o_totalprice")).otherwise(F.col("o_totalprice")).alias("signed_price"),
    )


def g19_preview(spark, sf, n=5):
    return _t(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]).orderBy("o_orderkey").limit(n)


def p3_duplicates(spark, sf):
    li = _t(spark, sf, "lineitem", LINEITEM_KEY)
    return li.groupBy(*LINEITEM_KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

