"""Registry part 2: cleaning (E), generator-derived (G), chart (C), KPI (R), pattern (P)
and source/sink (S) keys, each with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import star as S
from strata.plans import charts as CH
from strata.plans import cleaning as CL
from strata.plans import kpis as R
from strata.plans.oracle import PANEL_CTES, clip_sql, latest_cte, r_even, r_up, with_panel
from strata.plans.panel import panel
from strata.plans.registry_core import COVERAGE, FACT_SELECT, YEARS
from strata.plans.registry_core import ORACLE as CORE_ORACLE
from strata.session import new_output_path
from strata.sources import io
from strata.sources.tables import read_table
from strata.streaming.upsert import read_current

NAMES6 = tuple(f"NATION_{i}" for i in range(6))
NAMES10 = tuple(f"NATION_{i}" for i in range(10))
RAW_COLS = [f.name for f in io.RAW_PANEL_SCHEMA.fields]
# FIXED VALUES: rows of the written CSV that get dirt, by the remainder of their day number (country_id added).
DIRT = {"repeated": 250, "no_rate": 67, "no_icu": 101, "shouted": 97, "negative": 1009}


def _p(spark, sf):
    return panel(spark, sf)


def _raw_op(name):
    return lambda spark, sf: CL.panel_ops(_p(spark, sf).raw)[name]()


MEAN_METRICS = ("new_cases", "new_deaths", "positive_rate", "icu_patients")


# ---------------------------------------------------------------- S1-S8
def s1_read_panel_csv(spark, sf):
    path = new_output_path(spark, "panel-csv")
    io.write_panel(_p(spark, sf).raw.select(*RAW_COLS), path, fmt="csv")
    return io.read_panel_csv(spark, path)


def s2_write_panel(spark, sf):
    """Fact written partitioned by year: date filters prune folders, and a folder has few files."""
    path = new_output_path(spark, "panel-parquet")
    fact = _p(spark, sf).fact.withColumn("report_year", F.year("report_date"))
    io.write_panel(fact, path, partition_by=["report_year"])
    return spark.read.parquet(path).drop("report_year")


def s3_create_star_tables(spark, sf):
    p = _p(spark, sf)
    paths = io.create_star_tables(spark, p.fact, p.dim, new_output_path(spark, "star"))
    return spark.read.parquet(paths["panel_facts"])


def s4_append_table(spark, sf, cutoff="1998-12-31"):
    fact = _p(spark, sf).fact
    path = new_output_path(spark, "append")
    cut = F.lit(cutoff).cast("date")
    io.write_panel(io.conform(fact.where(F.col("report_date") <= cut), io.FACT_SCHEMA), path)
    io.append_table(io.conform(fact.where(F.col("report_date") > cut), io.FACT_SCHEMA), path)
    return spark.read.parquet(path)


def s5_scan_table(spark, sf):
    p = _p(spark, sf)
    io.register_views(spark, p.fact, p.dim)
    return io.scan_table(spark, sql="SELECT * FROM vw_latest_snapshot")


def s6_register_views(spark, sf):
    p = _p(spark, sf)
    io.register_views(spark, p.fact, p.dim)
    return io.scan_table(spark, "vw_monthly_summary")


def s7_full_rebuild(spark, sf):
    def build():
        p = _p(spark, sf)
        return p.fact, p.dim
    base = new_output_path(spark, "rebuild")
    io.full_rebuild(spark, build, base)
    return spark.read.parquet(io.open_star_tables(spark, base)["panel_facts"])


def s8_query_suite(spark, sf):
    from strata.plans.registry_core import SPARK as CORE
    from strata.plans.suite import run_suite

    status, _ = run_suite(spark, {n: (lambda n=n: CORE[n](spark, sf)) for n in QUESTIONS}, new_output_path(spark, "suite"))
    return status


QUESTIONS = (  # the 25, in their order
    "top_per_million", "global_running_total", "rank_in_group", "pareto_quintiles", "moving_avg_30", "avg_monthly_gain",
    "snapshot_pairs", "avg_growth_having", "monthly_global", "group_ratio_of_sums", "below_threshold", "wave_direction",
    "level_per_million", "gdp_cohorts", "age_cohorts", "bottom_testing", "peak_day", "stringency_cohorts", "stock_ratio",
    "year_pivot", "count_above", "recovery_rate", "global_kpis", "above_global_avg", "monthly_view_slice")


def p9_stream_upsert(spark, sf, cutoff="1998-12-31", delta_from="1998-07-01"):
    """P9, stream form: base and delta loads land as files one after the other, and each is merged by a trigger
    of its own: the first makes the table, the second corrects its rows."""
    from pyspark.sql import types as T

    from strata.streaming.upsert import start_upsert_stream

    fact = _p(spark, sf).fact
    base = new_output_path(spark, "stream-upsert")
    cols = ["country_id", "report_date", "new_cases", "total_cases", "icu_patients"]
    month = F.date_format("report_date", "yyyy-MM").alias("part_month")
    loads = [(fact.where(F.col("report_date") <= F.lit(cutoff).cast("date")), 1),
             (fact.where(F.col("report_date") >= F.lit(delta_from).cast("date")), 2)]
    for df, load in loads:
        restated = (F.col("new_cases") + (load - 1) * R.RESTATED).alias("new_cases")
        df.select(*[restated if c == "new_cases" else c for c in cols], F.lit(load).alias("load_id"), month) \
            .write.mode("append").parquet(f"{base}/source")
        schema = spark.read.parquet(f"{base}/source").schema
        q = start_upsert_stream(spark, f"{base}/source", T.StructType(schema.fields), f"{base}/table",
                                ["country_id", "report_date"], "load_id", "part_month", f"{base}/checkpoint")
        q.awaitTermination()
    return spark.read.parquet(f"{base}/table").select(*cols, "load_id")


def p9_stream_upsert_moves(spark, sf, month="1997-06"):
    """P9, stream form, on orders by status: a correction that lacks a column and moves rows to another partition.

    The first load is the whole table, partitioned by status; the second closes the open orders of a month and says
    nothing of their price, which stays."""
    from strata.streaming.upsert import upsert_batch

    base = new_output_path(spark, "upsert-moves")
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"])
    keep = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"]
    upsert_batch(spark, orders.select(*keep, F.lit(1).alias("load_id")), base, ["o_orderkey"], "load_id", "o_orderstatus")
    closed = orders.where((F.date_format("o_orderdate", "yyyy-MM") == month) & (F.col("o_orderstatus") == "O"))
    delta = closed.select("o_orderkey", "o_orderdate", F.lit("F").alias("o_orderstatus"), F.lit(2).alias("load_id"))
    upsert_batch(spark, delta, base, ["o_orderkey"], "load_id", "o_orderstatus")
    return read_current(spark, base).select(*keep, "load_id")


def reference_workflow(spark, sf):
    """The raw-CSV workflow end to end on dirt put in by rule: the panel is written in the raw daily layout with
    repeated rows, missing rates and ICU counts, shouted names and negative flows, then read, cleaned
    (title-cased names, keep-first dedupe by file order, floor, fills, derived columns), validated and
    split into star tables; the result is the fact with the entity name."""
    from strata.plans import workflow as WF

    raw = _p(spark, sf).raw
    cols = [(F.col(n) if n in raw.columns else F.lit(None).cast(t)).alias(n) for n, t in WF.RAW_CSV_COLUMNS]
    nth = F.unix_date("date") + F.col("country_id")

    def hit(what):
        return F.pmod(nth, F.lit(DIRT[what])) == 0

    dirty = raw.withColumns({
        "repeated": hit("repeated"), "positive_rate": F.when(~hit("no_rate"), F.col("positive_rate")),
        "icu_patients": F.when(~hit("no_icu"), F.col("icu_patients")),
        "country": F.when(hit("shouted"), F.concat(F.upper("country"), F.lit("  "))).otherwise(F.col("country")),
        "new_cases": F.when(hit("negative"), -F.col("new_cases")).otherwise(F.col("new_cases"))})
    path = new_output_path(spark, "raw-csv")
    io.write_panel(dirty.select(*cols), path, fmt="csv")
    # copies come later and say something else: the first row of a key is kept
    again = dirty.where("repeated").withColumn("new_cases", F.col("new_cases") + 5)
    path_2 = new_output_path(spark, "raw-csv-later")
    io.write_panel(again.select(*cols), path_2, fmt="csv")
    clean, report = WF.clean_raw(WF.read_raw_csv(spark, [path, path_2]))
    stored = new_output_path(spark, "clean")
    io.write_panel(clean, stored)  # read by the validation, the dimension and the fact
    clean = spark.read.parquet(stored)
    C.assert_valid(C.validate_panel(clean, entity="country", date="date"))
    fact, dim = WF.build_star(clean)
    keep = [c for c in S.FACT_COLUMNS if c != "country_id"]
    return fact.join(dim.select("country_id", "country_name"), "country_id").select("country_name", *keep)


SPARK = {
    "reference_workflow": reference_workflow,
    # sources and sinks
    "read_panel_csv": s1_read_panel_csv,
    "write_panel": s2_write_panel,
    "create_star_tables": s3_create_star_tables,
    "append_table": s4_append_table,
    "scan_table": s5_scan_table,
    "register_views": s6_register_views,
    "full_rebuild": s7_full_rebuild,
    "query_suite": s8_query_suite,
    # cleaning on driver tables
    "standardize_names": CL.e1_standardize_names,
    "map_labels": CL.e2_map_labels,
    "distinct_label_audit": CL.e3_distinct_label_audit,
    "dedupe_keep_first": CL.e4_dedupe_keep_first,
    "floor_negatives": CL.e5_floor_negatives,
    "negative_audit": CL.e5_negative_audit,
    "clip_range": CL.e6_clip_range,
    "row_audit": CL.e18_row_audit,
    "lookup_key": CL.e21_lookup_key,
    "unmatched_keys": CL.e21_unmatched,
    "unmatched_keys_some": CL.e21_unmatched_some,
    "attribute_drift_orders": CL.e19_drift_orders,
    "validate_dirty": CL.e17_validate_dirty,
    "constraints_dirty": CL.e24_constraints_dirty,
    "rank_with_nulls": CL.rank_with_nulls,
    "running_sum_with_nulls": CL.running_sum_with_nulls,
    "normalize_date": CL.e23_normalize_date,
    "assign_surrogate_key": lambda spark, sf: CL.e20_assign_surrogate_key(_p(spark, sf).fact, _p(spark, sf).dim),
    "validate_panel": lambda spark, sf: C.validate_panel(_p(spark, sf).fact, "country_id", "report_date"),
    "constraint_checks": lambda spark, sf: C.constraint_checks(_p(spark, sf).fact, _p(spark, sf).dim),
    "sanity_metrics": lambda spark, sf: C.sanity_metrics(_p(spark, sf).fact, _p(spark, sf).dim),
    "clean_panel": lambda spark, sf: S.project_rename(
        C.clean_panel(_p(spark, sf).raw, entity="country_id", date="date", names=False)),
    "raw_panel": lambda spark, sf: _p(spark, sf).raw.select(*RAW_COLS),
    # generator-derived
    "safe_ratio": CL.g5_safe_ratio,
    "weekday_factor": CL.g9_weekday_factor,
    "weekday_seasonality": CL.g9_weekday_seasonality,
    "top_share_tier": lambda spark, sf: CL.g10_top_share_tier(_p(spark, sf).dim),
    "complement_rate_proxy": lambda spark, sf: CL.g14_complement_rate_proxy(_p(spark, sf).fact),
    "date_spine": lambda spark, sf: CL.g15_date_spine(spark, sf, _p(spark, sf).dim),
    "sample_rows": CL.g16_sample_rows,
    "concat_rows": CL.g17_concat_rows,
    "conditional_update": CL.g18_conditional_update,
    "preview": CL.g19_preview,
    # charts
    "global_trend_7d": lambda spark, sf: CH.c1_global_trend_7d(_p(spark, sf).fact),
    "pareto_curve": lambda spark, sf: CH.c2_pareto_curve(_p(spark, sf).fact, _p(spark, sf).dim),
    "bubble_pairs": lambda spark, sf: CH.c3_bubble_pairs(_p(spark, sf).fact, _p(spark, sf).dim),
    "continent_bars": lambda spark, sf: CH.c4_continent_bars(_p(spark, sf).fact, _p(spark, sf).dim),
    "rollout_lines": lambda spark, sf: CH.c5_rollout_lines(_p(spark, sf).fact, _p(spark, sf).dim, NAMES6),
    "month_heatmap": lambda spark, sf: CH.c6_month_heatmap(_p(spark, sf).fact, _p(spark, sf).dim, NAMES10),
    # published metrics
    "pearson_pairs": lambda spark, sf: R.r1_pearson_pairs(_p(spark, sf).fact, _p(spark, sf).dim),
    "pearson_p_value": lambda spark, sf: R.r2_pearson_p_value(_p(spark, sf).fact, _p(spark, sf).dim),
    "yoy_change_pct": lambda spark, sf: R.r3_yoy_change_pct(_p(spark, sf).fact, YEARS),
    "share_below": lambda spark, sf: R.r4_share_below(_p(spark, sf).fact, _p(spark, sf).dim, threshold=COVERAGE),
    "kpi_leaders": lambda spark, sf: R.r5_kpi_leaders(_p(spark, sf).fact, _p(spark, sf).dim),
    "kpi_table": lambda spark, sf: R.r6_kpi_table(_p(spark, sf).fact, _p(spark, sf).dim),
    # described patterns
    "top_n_per_group": lambda spark, sf: R.p1_top_n_per_group(_p(spark, sf).fact, _p(spark, sf).dim),
    "rank_variants": lambda spark, sf: R.p2_rank_variants(_p(spark, sf).fact, _p(spark, sf).dim),
    "find_duplicates": CL.p3_duplicates,
    "peak_by_window": lambda spark, sf: R.p4_peak_by_window(_p(spark, sf).fact, _p(spark, sf).dim),
    "moving_avg_7_sql": lambda spark, sf: R.p5_moving_avg_7(_p(spark, sf).fact, _p(spark, sf).dim),
    "before_after_profile": lambda spark, sf: R.p6_before_after_profile(_p(spark, sf).raw, _p(spark, sf).fact),
    "median_vs_mean": lambda spark, sf: R.p7_median_vs_mean(_p(spark, sf).fact, _p(spark, sf).dim),
    "profile_table": lambda spark, sf: R.p8_profile_table(_p(spark, sf).fact),
    "incremental_upsert": lambda spark, sf: R.p9_demo(_p(spark, sf).fact),
    "stream_upsert": p9_stream_upsert,
    "stream_upsert_moves": p9_stream_upsert_moves,
    "before_after_means": lambda spark, sf: R.p6_before_after_means(_p(spark, sf).raw, _p(spark, sf).fact, _p(spark, sf).dim),
    "profile_distribution": lambda spark, sf: R.p8_profile_distribution(_p(spark, sf).fact),
    "flow_stock_reconcile": lambda spark, sf: R.p10_flow_stock_reconcile(_p(spark, sf).fact, _p(spark, sf).dim),
}
for _k in ("null_audit recompute_missing_ratio fill_series_gaps round_to_int sort_panel fatality_rate per_million "
           "coverage_pct rolling_mean_7 growth_wow extract_dimension attribute_drift project_rename cumulative_total lag_zero "
           "elementwise_min_max active_balance pct_change_1 momentum_index rolling_mean_k rolling_mean_full "
           "share_of_entity_max share_of_entity_total per_capita_share").split():
    SPARK[_k] = _raw_op(_k)


# ---------------------------------------------------------------- oracles
def title_sql(x: str) -> str:
    s = f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    return (f"array_to_string(list_transform(generate_series(1, length({s})), lambda i: CASE WHEN i = 1 OR NOT "
            f"regexp_matches(substring({s}, i - 1, 1), '\\p{{L}}') THEN upper(substring({s}, i, 1)) "
            f"ELSE substring({s}, i, 1) END), '')")


W = "PARTITION BY country_id ORDER BY date"
V1 = latest_cte("v1")
LI_ORDER = ", ".join(f"{c} NULLS FIRST" for c in CL.LINEITEM_ORDER)


def _raw(body, *ctes):
    return with_panel(body, *ctes)


def _union(parts):
    return " UNION ALL ".join(parts)


PAIRS_SQL = _union([
    f"SELECT '{x}' AS x, '{y}' AS y, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n, "
    f"CASE WHEN var_pop({x}) > 0 AND var_pop({y}) > 0 THEN {r_up(f'corr({x}, {y})', 3)} END AS r FROM v1"
    for x, y in R.PAIRS])

PAIRS_RAW_SQL = _union([
    f"SELECT '{x}' AS x, '{y}' AS y, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n, "
    f"CASE WHEN var_pop({x}) > 0 AND var_pop({y}) > 0 THEN corr({x}, {y}) END AS r FROM v1"
    for x, y in R.PAIRS])
# Two-sided Student-t p-value by Simpson's rule over the tail: with u = |t| / w, p = 2 c |t| times the integral over
# w from 0 to 1 of w^(v-1) (w^2 + t^2/v)^(-(v+1)/2), a smooth function; c from lgamma.
_N = 4000
_W = f"(k / {_N}.0::DOUBLE)"
_SIMPSON = (f"list_sum(list_transform(generate_series(1, {_N}), lambda k: (CASE WHEN k = {_N} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * "
            f"pow({_W}, v - 1) * pow({_W} * {_W} + t * t / v, -(v + 1) / 2.0::DOUBLE))) / (3.0::DOUBLE * {_N})")
P_SQL = (f"CASE WHEN v >= 1 AND t IS NOT NULL THEN CASE WHEN t = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * exp(lgamma((v + 1) / 2.0::DOUBLE) - "
         f"lgamma(v / 2.0::DOUBLE)) / sqrt(v * pi()) * abs(t) * {_SIMPSON} END END")
LEVELS_SQL = ("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_acctbal >= 0 THEN "
              "CAST(floor(c_acctbal / 500) AS BIGINT) END AS level FROM customer")
KPI_COLS = ["global_total_cases", "global_total_deaths", "global_total_recovered", "global_active_cases",
            "global_cfr_pct", "avg_country_vaccination_rate_pct"]
Q23_SQL = ("k AS (SELECT sum(total_cases) AS global_total_cases, sum(total_deaths) AS global_total_deaths, "
           "sum(total_recovered) AS global_total_recovered, sum(active_cases) AS global_active_cases, "
           f"{r_up('100.0::DOUBLE * sum(total_deaths) / nullif(sum(total_cases), 0)', 3)} AS global_cfr_pct, "
           f"{r_up('CAST(sum(CAST(vaccination_rate_pct AS DECIMAL(18,2))) AS DOUBLE) / count(vaccination_rate_pct)', 1)} "
           "AS avg_country_vaccination_rate_pct FROM v1)")
MONTHS = ", ".join(f"CAST(sum(c) FILTER (WHERE ym = '{y}-{m:02d}') AS BIGINT) AS \"{y}-{m:02d}\""
                   for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8))


UPSERT_SQL = ("SELECT country_id, report_date, new_cases + CASE WHEN report_date >= DATE '1998-07-01' THEN 1000 ELSE 0 END AS new_cases, "
              "total_cases, icu_patients, CASE WHEN report_date >= DATE '1998-07-01' THEN 2 ELSE 1 END AS load_id FROM fact")
def _mean_sql(c, kind):
    return f"CAST(sum(CAST({c} AS DECIMAL(30,6))) AS DOUBLE) / count({c})" if kind == "measure" else f"avg({c})"


FACT_ID_SQL = "row_number() OVER (ORDER BY country_id, report_date) AS fact_id"


def _dirt(what):
    return f"((date - DATE '1970-01-01') + country_id) % {DIRT[what]} = 0"


#: The workflow's dirt, then what cleaning makes of it, in the panel's own CTEs.
DIRTY_PANEL = PANEL_CTES.replace("FROM raw\n),\nfact AS", "FROM spoilt\n),\nfact AS").replace(
    "clean0 AS (", "spoilt AS (SELECT * REPLACE (CASE WHEN " + _dirt("no_rate") + " THEN NULL ELSE positive_rate END AS "
    "positive_rate, CASE WHEN " + _dirt("no_icu") + " THEN NULL ELSE icu_patients END AS icu_patients, CASE WHEN "
    + _dirt("negative") + " THEN 0 ELSE new_cases END AS new_cases) FROM raw),\nclean0 AS (")

ORACLE = {
    "reference_workflow": "WITH " + DIRTY_PANEL.strip()
        + f"\nSELECT {title_sql('d.country_name')} AS country_name, "
        + ", ".join(f"f.{c}" for c in FACT_SELECT.split(", ") if c != "country_id")
        + " FROM fact f JOIN dim d ON d.country_id = f.country_id",
    "unmatched_keys_some": "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer "
                           "WHERE c_acctbal > 0)",
    "attribute_drift_orders": "SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_versions FROM orders GROUP BY 1 "
                              "HAVING count(DISTINCT o_orderpriority) > 1",
    "validate_dirty": _union([
        "SELECT 'null_date' AS \"check\", count(*) FILTER (WHERE o_orderdate IS NULL) AS violations FROM orders",
        "SELECT 'negative_new_cases', count(*) FILTER (WHERE o_orderstatus = 'P' OR o_totalprice < 20000) FROM orders",
        "SELECT 'deaths_exceed_cases', count(*) FILTER (WHERE o_totalprice > 150001) FROM orders",
        "SELECT 'duplicate_key', count(*) - count(DISTINCT (o_custkey, o_orderdate)) FROM orders"]),
    "constraints_dirty": _union([
        "SELECT 'not_null_country' AS \"check\", count(*) FILTER (WHERE o_custkey IS NULL) AS violations FROM orders",
        "SELECT 'not_null_date', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders",
        "SELECT 'not_null_new_cases', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders",
        "SELECT 'not_null_total_cases', count(*) FILTER (WHERE o_totalprice >= 400000) FROM orders",
        "SELECT 'not_null_name', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer WHERE c_acctbal > 0",
        "SELECT 'unique_name', count(*) FROM (SELECT c_mktsegment FROM customer WHERE c_acctbal > 0 GROUP BY 1 HAVING count(*) > 1)",
        "SELECT 'unique_key', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)",
        "SELECT 'foreign_key', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"]),
    "rank_with_nulls": f"WITH l AS ({LEVELS_SQL}) SELECT c_custkey, segment, level, rank() OVER (ORDER BY level DESC NULLS LAST) "
        "AS rnk, dense_rank() OVER (ORDER BY level DESC NULLS LAST) AS dense_rnk, row_number() OVER (ORDER BY level DESC "
        "NULLS LAST, c_custkey) AS row_num, rank() OVER (PARTITION BY segment ORDER BY level DESC NULLS LAST) AS segment_rank FROM l",
    "running_sum_with_nulls": f"WITH l AS ({LEVELS_SQL}) SELECT c_custkey, segment, level, CAST(sum(level) OVER (ORDER BY c_custkey) "
        "AS BIGINT) AS running, CAST(sum(level) OVER (PARTITION BY segment ORDER BY c_custkey) AS BIGINT) AS segment_running FROM l",
    "query_suite": " UNION ALL ".join(
        f"SELECT '{n}' AS name, true AS ok, (SELECT count(*) FROM ({CORE_ORACLE[n]})) AS n_rows, "
        "CAST(NULL AS VARCHAR) AS error" for n in QUESTIONS),
    "read_panel_csv": _raw(f"SELECT {', '.join(RAW_COLS)} FROM raw"),
    "raw_panel": _raw(f"SELECT {', '.join(RAW_COLS)} FROM raw"),
    "write_panel": with_panel(f"SELECT {FACT_SELECT} FROM fact"),
    "create_star_tables": with_panel(f"SELECT {FACT_ID_SQL}, {FACT_SELECT} FROM fact"),
    "append_table": with_panel(f"SELECT {FACT_SELECT} FROM fact"),
    "scan_table": with_panel("SELECT * FROM v1", V1),
    "register_views": with_panel(
        "SELECT d.country_name, d.continent, strftime(f.report_date, '%Y-%m') AS report_month, "
        "CAST(sum(f.new_cases) AS BIGINT) AS monthly_new_cases, CAST(sum(f.new_deaths) AS BIGINT) AS monthly_new_deaths, "
        "CAST(sum(CAST(f.positive_rate AS DECIMAL(18,4))) AS DOUBLE) / count(f.positive_rate) AS avg_positive_rate, "
        "CAST(sum(CAST(f.stringency_index AS DECIMAL(18,4))) AS DOUBLE) / count(f.stringency_index) AS avg_stringency_index, "
        "max(f.people_fully_vaccinated) AS end_of_month_fully_vaccinated "
        "FROM fact f JOIN dim d ON d.country_id = f.country_id GROUP BY 1, 2, 3"),
    "full_rebuild": with_panel(f"SELECT {FACT_ID_SQL}, {FACT_SELECT} FROM fact"),
    "standardize_names": f"SELECT o_orderkey, {title_sql(chr(39) + '  ' + chr(39) + ' || o_orderpriority || chr(9)')} AS priority_label FROM orders",
    "map_labels": "SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'OPEN' END, "
                  "o_orderstatus) AS status_label FROM orders",
    "distinct_label_audit": f"SELECT count(DISTINCT c_mktsegment) AS labels_before, count(DISTINCT {title_sql('c_mktsegment')}) "
                            "AS labels_after FROM customer",
    "dedupe_keep_first": "SELECT * EXCLUDE (rn) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM (SELECT *, row_number() "
                         f"OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LI_ORDER}) AS rn FROM lineitem) WHERE rn = 1",
    "floor_negatives": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer",
    "negative_audit": "SELECT 'c_acctbal' AS \"column\", count(*) FILTER (WHERE c_acctbal < 0) AS violations FROM customer",
    "clip_range": f"SELECT c_custkey, {clip_sql('c_acctbal', 0.0, 5000.0)} AS c_acctbal FROM customer",
    "row_audit": "SELECT 'input' AS step, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'deduplicated', count(*) "
                 "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
    "lookup_key": "SELECT o.o_orderkey, c.c_nationkey FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey",
    "unmatched_keys": "SELECT DISTINCT o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)",
    "normalize_date": "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_day FROM orders",
    "assign_surrogate_key": with_panel(
        "SELECT CAST(row_number() OVER (ORDER BY d.country_name, f.report_date) AS BIGINT) AS fact_id, f.country_id, f.report_date "
        "FROM fact f JOIN dim d ON d.country_id = f.country_id"),
    "validate_panel": with_panel(_union([
        "SELECT 'null_date' AS \"check\", count(*) FILTER (WHERE report_date IS NULL) AS violations FROM fact",
        "SELECT 'negative_new_cases', count(*) FILTER (WHERE new_cases < 0) FROM fact",
        "SELECT 'deaths_exceed_cases', count(*) FILTER (WHERE total_deaths > total_cases + 1) FROM fact",
        "SELECT 'duplicate_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM fact "
        "GROUP BY country_id, report_date HAVING count(*) > 1)"])),
    "constraint_checks": with_panel(_union(
        [f"SELECT 'not_null_{c}' AS \"check\", count(*) FILTER (WHERE {c} IS NULL) AS violations FROM fact" for c in S.FACT_NOT_NULL]
        + [f"SELECT 'not_null_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM dim" for c in S.DIM_NOT_NULL] + [
        "SELECT 'unique_name', count(*) FROM (SELECT country_name FROM dim GROUP BY 1 HAVING count(*) > 1)",
        "SELECT 'unique_key', count(*) FROM (SELECT 1 FROM fact GROUP BY country_id, report_date HAVING count(*) > 1)",
        "SELECT 'foreign_key', count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.country_id = f.country_id)"])),
    "sanity_metrics": with_panel(_union([
        "SELECT 'dim_rows' AS label, CAST(count(*) AS VARCHAR) AS value FROM dim",
        "SELECT 'fact_rows', CAST(count(*) AS VARCHAR) FROM fact",
        "SELECT 'distinct_entities', CAST(count(DISTINCT country_id) AS VARCHAR) FROM fact",
        "SELECT 'min_date', CAST(min(report_date) AS VARCHAR) FROM fact",
        "SELECT 'max_date', CAST(max(report_date) AS VARCHAR) FROM fact"])),
    "clean_panel": with_panel(f"SELECT {FACT_SELECT} FROM fact"),
    # raw-panel operators
    "null_audit": _raw(_union([f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw"
                               for c in RAW_COLS])),
    "recompute_missing_ratio": _raw(
        f"SELECT country_id, date, {r_even('coalesce(positive_rate, new_cases / nullif(new_tests, 0), 0.0::DOUBLE)', 4)} "
        "AS positive_rate FROM raw"),
    "fill_series_gaps": _raw(
        f"SELECT country_id, date, CAST(coalesce(last_value(icu_patients IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED "
        f"PRECEDING AND CURRENT ROW), first_value(icu_patients IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND "
        "UNBOUNDED FOLLOWING), 0) AS BIGINT) AS icu_patients FROM raw"),
    "round_to_int": _raw(f"SELECT country_id, date, CAST({r_even('stringency_index', 0)} AS BIGINT) AS stringency_index FROM raw"),
    "sort_panel": _raw("SELECT country_id, date, new_cases FROM raw"),
    "fatality_rate": _raw(
        f"SELECT country_id, date, CASE WHEN total_cases > 0 THEN {r_even('total_deaths / nullif(total_cases, 0) * 100.0::DOUBLE', 3)} "
        "ELSE 0.0::DOUBLE END AS case_fatality_rate FROM raw"),
    "per_million": _raw(
        f"SELECT country_id, date, {r_even('total_cases / nullif(population, 0) * 1000000.0::DOUBLE', 1)} AS cases_per_million, "
        f"{r_even('total_deaths / nullif(population, 0) * 1000000.0::DOUBLE', 1)} AS deaths_per_million FROM raw"),
    "coverage_pct": _raw(
        f"SELECT country_id, date, {r_even(clip_sql('people_fully_vaccinated / nullif(population, 0) * 100.0::DOUBLE', 0.0, 100.0), 2)} "
        f"AS vaccination_rate_pct, {r_even('total_tests / nullif(population, 0) * 100.0::DOUBLE', 2)} AS testing_rate_pct FROM raw"),
    "rolling_mean_7": _raw(
        f"SELECT country_id, date, {r_even(f'avg(new_cases) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 1)} "
        "AS new_cases_7day_avg FROM raw"),
    "growth_wow": _raw(
        f"SELECT country_id, date, {r_even(f'(avg7 / nullif(lag(avg7, 7) OVER ({W}), 0) - 1.0::DOUBLE) * 100.0::DOUBLE', 2)} AS growth "
        f"FROM (SELECT *, {r_even(f'avg(new_cases) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 1)} AS avg7 FROM raw)"),
    "extract_dimension": _raw(
        "SELECT country AS country_name, continent, population, median_age, gdp_per_capita, life_expectancy FROM raw "
        "QUALIFY row_number() OVER (PARTITION BY country ORDER BY date) = 1"),
    "attribute_drift": _raw(
        "SELECT country, count(DISTINCT (continent, population, median_age, gdp_per_capita, life_expectancy)) AS n_versions "
        "FROM raw GROUP BY country HAVING count(DISTINCT (continent, population, median_age, gdp_per_capita, life_expectancy)) > 1"),
    "project_rename": _raw(f"SELECT {', '.join('date AS report_date' if c == 'date' else c for c in RAW_COLS)} FROM raw"),
    "cumulative_total": _raw(
        f"SELECT country_id, date, new_cases, CAST(sum(new_cases) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
        "AS BIGINT) AS running_cases FROM raw"),
    "lag_zero": _raw(f"SELECT country_id, date, new_cases, lag(new_cases, 12, 0) OVER ({W}) AS lagged_cases FROM raw"),
    "elementwise_min_max": _raw(
        "SELECT country_id, date, CASE WHEN total_recovered IS NULL OR total_cases IS NULL THEN NULL "
        "WHEN total_recovered <= total_cases THEN total_recovered ELSE total_cases END AS capped, "
        "CASE WHEN new_deaths IS NULL OR new_tests IS NULL THEN NULL WHEN new_deaths >= new_tests THEN new_deaths "
        "ELSE new_tests END AS wider FROM raw"),
    "active_balance": _raw(
        "SELECT country_id, date, CASE WHEN total_cases - total_deaths - total_recovered < 0 THEN 0 "
        "ELSE total_cases - total_deaths - total_recovered END AS active FROM raw"),
    "pct_change_1": _raw(
        f"SELECT country_id, date, new_cases, coalesce(new_cases / nullif(lag(new_cases) OVER ({W}), 0) - 1.0::DOUBLE, "
        "0.0::DOUBLE) AS chg FROM raw"),
    "momentum_index": _raw(
        f"SELECT country_id, date, new_cases, {r_even(clip_sql(f'1.0::DOUBLE + 3.0::DOUBLE * avg(chg) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 0.5, 2.5), 2)} AS rt "
        f"FROM (SELECT *, coalesce(new_cases / nullif(lag(new_cases) OVER ({W}), 0) - 1.0::DOUBLE, 0.0::DOUBLE) AS chg FROM raw)"),
    "rolling_mean_k": _raw(
        f"SELECT country_id, date, avg(new_cases) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS avg3 FROM raw"),
    "rolling_mean_full": _raw(
        f"SELECT country_id, date, CASE WHEN count(new_cases) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) >= 7 "
        f"THEN avg(new_cases) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS avg7_full FROM raw"),
    "share_of_entity_max": _raw(
        "SELECT country_id, date, new_cases, coalesce(new_cases / nullif(max(new_cases) OVER (PARTITION BY country_id), 0), "
        "0.0::DOUBLE) AS share_max FROM raw"),
    "share_of_entity_total": _raw(
        "SELECT country_id, date, new_cases, new_cases / nullif(CAST(sum(new_cases) OVER (PARTITION BY country_id) AS BIGINT), 0) "
        "* 1.0::DOUBLE AS share_total FROM raw"),
    "per_capita_share": _raw(
        f"SELECT country_id, date, share, CAST({r_even('share * population', 0)} AS BIGINT) AS back_to_count "
        "FROM (SELECT *, people_fully_vaccinated / nullif(population, 0) AS share FROM raw)"),
    # generator-derived on tables
    "safe_ratio": "SELECT o_orderkey, coalesce(" + r_even(
        "o_totalprice / CASE WHEN coalesce(n, 0) < 1 THEN 1 ELSE coalesce(n, 0) END", 4) + ", 0.0::DOUBLE) AS price_per_line "
        "FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey",
    "weekday_factor": "SELECT event_id, CAST(isodow(ts) - 1 AS BIGINT) AS weekday, "
                      "[1.0::DOUBLE, 1.0, 1.0, 1.0, 1.0, 0.72, 0.55][isodow(ts)] * value AS adjusted_value FROM events",
    "weekday_seasonality": "SELECT CAST(isodow(d) - 1 AS BIGINT) AS weekday, sum(n) / count(n) / (SELECT sum(n) / count(n) FROM "
                           "(SELECT count(*) AS n FROM orders GROUP BY CAST(o_orderdate AS DATE))) AS weekday_index FROM "
                           "(SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1",
    "top_share_tier": with_panel(
        "SELECT country_name, population, avg_rank, avg_rank <= greatest(1, floor(0.2::DOUBLE * n)) AS top_tier FROM "
        "(SELECT country_name, population, rank() OVER (ORDER BY population DESC) + (count(*) OVER (PARTITION BY population) - 1) "
        "/ 2.0::DOUBLE AS avg_rank, count(*) OVER () AS n FROM dim)"),
    "complement_rate_proxy": with_panel(
        "SELECT country_id, report_date, CAST(" + r_even(
            "active_cases * (" + clip_sql('0.015::DOUBLE - 0.01::DOUBLE * (vaccination_rate_pct / 100.0::DOUBLE)', 0.003, 0.02)
            + " * 1.0::DOUBLE)", 0) + " AS BIGINT) AS icu_proxy FROM fact"),
    "date_spine": with_panel("SELECT dim.country_id, cal.d AS report_date FROM dim CROSS JOIN cal"),
    "sample_rows": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE "
                   "substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) < '19999999'",
    "concat_rows": "SELECT o_orderkey AS key, CAST(o_orderdate AS DATE) AS day FROM orders UNION ALL "
                   "SELECT event_id, CAST(ts AS DATE) FROM events",
    "conditional_update": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price_or_null, "
                          "CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) || '  ' ELSE o_orderpriority END AS priority_label, "
                          "CASE WHEN o_orderstatus = 'O' THEN -abs(o_totalprice) ELSE o_totalprice END AS signed_price FROM orders",
    "preview": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
    # charts
    "global_trend_7d": with_panel(
        "SELECT report_date, new_cases, new_deaths, CASE WHEN count(*) OVER w >= 7 THEN avg(new_cases) OVER w END AS cases_7d, "
        "CASE WHEN count(*) OVER w >= 7 THEN avg(new_deaths) OVER w END AS deaths_7d FROM (SELECT report_date, "
        "CAST(sum(new_cases) AS BIGINT) AS new_cases, CAST(sum(new_deaths) AS BIGINT) AS new_deaths FROM fact GROUP BY 1) "
        "WINDOW w AS (ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"),
    "pareto_curve": with_panel(
        "SELECT country_name, total_cases, CAST(sum(total_cases) OVER (ORDER BY total_cases DESC, country_name ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) / nullif(CAST(sum(total_cases) OVER () AS BIGINT), 0) * 100.0::DOUBLE "
        "AS cum_pct FROM v1 ORDER BY total_cases DESC, country_name LIMIT 15", V1),
    "bubble_pairs": with_panel(
        "SELECT country_name, vaccination_rate_pct, case_fatality_rate, gdp_per_capita, continent, "
        "gdp_per_capita / 400.0::DOUBLE AS bubble_size FROM v1", V1),
    "continent_bars": with_panel(
        "SELECT continent, CAST(sum(total_cases) AS BIGINT) AS total_cases, CAST(sum(total_deaths) AS BIGINT) AS total_deaths, "
        f"{r_up('100.0::DOUBLE * sum(total_deaths) / nullif(sum(total_cases), 0)', 2)} AS cfr FROM v1 GROUP BY continent", V1),
    "rollout_lines": with_panel(
        "SELECT d.country_name, f.report_date, f.vaccination_rate_pct FROM fact f JOIN dim d ON d.country_id = f.country_id "
        f"WHERE d.country_name IN {NAMES6!r}"),
    "month_heatmap": with_panel(
        f"SELECT country_name, {MONTHS} FROM (SELECT d.country_name, strftime(f.report_date, '%Y-%m') AS ym, "
        "sum(f.new_cases) AS c FROM fact f JOIN dim d ON d.country_id = f.country_id "
        f"WHERE d.country_name IN {NAMES10!r} GROUP BY 1, 2) GROUP BY 1"),
    # metrics
    "pearson_pairs": with_panel(PAIRS_SQL, V1),
    "pearson_p_value": with_panel(
        f"SELECT x, y, n, {r_up('r', 6)} AS r, {r_up('t', 6)} AS t, {r_up(P_SQL, 6)} AS p_value FROM "
        "(SELECT *, CAST(n - 2 AS DOUBLE) AS v, r * sqrt((n - 2) / CASE WHEN 1.0::DOUBLE - r * r > 0 THEN 1.0::DOUBLE - r * r END) AS t "
        f"FROM ({PAIRS_RAW_SQL}))", V1),
    "yoy_change_pct": with_panel(
        f"SELECT {r_up(f'(cases_{YEARS[1]} / nullif(cases_{YEARS[0]}, 0) - 1.0::DOUBLE) * 100.0::DOUBLE', 1)} AS cases_yoy_pct, "
        f"{r_up(f'(deaths_{YEARS[1]} / nullif(deaths_{YEARS[0]}, 0) - 1.0::DOUBLE) * 100.0::DOUBLE', 1)} AS deaths_yoy_pct "
        "FROM (SELECT " + ", ".join(
            f"CAST(sum(CASE WHEN year(report_date) = {y} THEN {src} ELSE 0 END) AS BIGINT) AS {m}_{y}"
            for m, src in (("cases", "new_cases"), ("deaths", "new_deaths")) for y in YEARS) + " FROM fact)"),
    "share_below": with_panel(
        "SELECT n_below, n_total, " + r_up("100.0::DOUBLE * n_below / nullif(n_total, 0)", 1) + " AS share_pct FROM "
        f"(SELECT count(*) FILTER (WHERE vaccination_rate_pct < {COVERAGE}) AS n_below, count(*) AS n_total FROM v1)", V1),
    "kpi_leaders": with_panel(_union([
        f"SELECT '{label}' AS kpi, country_name, CAST({col} AS DOUBLE) AS value FROM v1 WHERE {col} = "
        f"(SELECT {how}({col}) FROM v1)" for label, col, how in R.LEADER_KPIS]), V1),
    "kpi_table": with_panel(_union([f"SELECT '{c}' AS label, CAST({c} AS DOUBLE) AS value, 'Q23' AS query_id FROM k"
                                    for c in KPI_COLS]), V1, Q23_SQL),
    # patterns
    "top_n_per_group": with_panel(
        "SELECT continent, country_name, cases_per_million, rk FROM (SELECT continent, country_name, cases_per_million, "
        "CAST(rank() OVER (PARTITION BY continent ORDER BY cases_per_million DESC) AS BIGINT) AS rk FROM v1) WHERE rk <= 3", V1),
    "rank_variants": with_panel(
        "SELECT country_name, population, rank() OVER (ORDER BY population DESC) AS rnk, "
        "dense_rank() OVER (ORDER BY population DESC) AS dense_rnk, "
        "row_number() OVER (ORDER BY population DESC, country_name) AS row_num FROM v1", V1),
    "find_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "peak_by_window": with_panel(
        "SELECT d.country_name, f.report_date AS peak_date, f.new_cases AS peak_new_cases FROM (SELECT *, max(new_cases) "
        "OVER (PARTITION BY country_id) AS pk FROM fact) f JOIN dim d ON d.country_id = f.country_id WHERE f.new_cases = f.pk"),
    "moving_avg_7_sql": with_panel(
        "SELECT d.country_name, f.report_date, avg(f.new_cases) OVER (PARTITION BY f.country_id ORDER BY f.report_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg_7d FROM fact f JOIN dim d ON d.country_id = f.country_id"),
    "before_after_profile": with_panel(
        "SELECT b.metric, b.v AS before, a.v AS after FROM (" + _union([
            "SELECT 'rows' AS metric, count(*) AS v FROM raw",
            "SELECT 'sum_new_cases', CAST(sum(new_cases) AS BIGINT) FROM raw",
            "SELECT 'null_positive_rate', count(*) FILTER (WHERE positive_rate IS NULL) FROM raw",
            "SELECT 'null_icu_patients', count(*) FILTER (WHERE icu_patients IS NULL) FROM raw",
            "SELECT 'sum_icu_patients', CAST(sum(icu_patients) AS BIGINT) FROM raw"]) + ") b JOIN (" + _union([
            "SELECT 'rows' AS metric, count(*) AS v FROM fact",
            "SELECT 'sum_new_cases', CAST(sum(new_cases) AS BIGINT) FROM fact",
            "SELECT 'null_positive_rate', count(*) FILTER (WHERE positive_rate IS NULL) FROM fact",
            "SELECT 'null_icu_patients', count(*) FILTER (WHERE icu_patients IS NULL) FROM fact",
            "SELECT 'sum_icu_patients', CAST(sum(icu_patients) AS BIGINT) FROM fact"]) + ") a ON a.metric = b.metric"),
    "median_vs_mean": with_panel(
        "SELECT d.continent, count(f.new_cases) AS n, avg(f.new_cases) AS mean, "
        + ", ".join(f"{r_up(f'quantile_cont(f.new_cases, {q})', 6)} AS p{int(q * 100):02d}" for q in (0.1, 0.5, 0.9))
        + " FROM fact f JOIN dim d ON d.country_id = f.country_id GROUP BY d.continent"),
    "profile_table": with_panel(_union([
        f"SELECT '{c}' AS \"column\", '{'date' if c == 'report_date' else 'double' if kind == 'measure' else 'bigint'}' AS dtype, "
        f"count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
        + (f"CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(min({c}) AS VARCHAR) AS min_text, "
           f"CAST(max({c}) AS VARCHAR) AS max_text FROM fact" if c == "report_date" else
           f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {r_up(_mean_sql(c, kind), 6)} AS mean, "
           "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM fact") for c, kind in S.FACT_LAYOUT])),
    "before_after_means": with_panel(
        "SELECT continent, metric, n_before, mean_before, n_after, mean_after, "
        + r_up("(mean_after - mean_before) / nullif(mean_before, 0) * 100.0::DOUBLE", 4) + " AS change_pct FROM ("
        + ") b JOIN (".join(_union([
            f"SELECT d.continent, '{m}' AS metric, count(f.{m}) AS n_{when}, "
            + r_up(f"CAST(sum(CAST(f.{m} AS DECIMAL(30,6))) AS DOUBLE) / nullif(count(f.{m}), 0)", 6)
            + f" AS mean_{when} FROM {t} f JOIN dim d ON d.country_id = f.country_id GROUP BY 1" for m in MEAN_METRICS])
            for when, t in (("before", "raw"), ("after", "fact"))) + ") a USING (continent, metric)"),
    "profile_distribution": with_panel(_union([
        f"SELECT '{c}' AS \"column\", count({c}) AS n, count(DISTINCT {c}) AS n_distinct, "
        + r_up(f"CAST(sum(CAST({c} AS DECIMAL(30,6))) AS DOUBLE) / count({c})", 6) + " AS mean, "
        + ", ".join(f"{r_up(f'quantile_cont(CAST({c} AS DOUBLE), {q})', 6)} AS p{round(q * 100):02d}" for q in (0.01, 0.25, 0.5, 0.75, 0.99))
        + f" FROM fact HAVING count({c}) > 0" for c, _ in S.FACT_LAYOUT if c != "report_date"])),
    "stream_upsert_moves": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
       CASE WHEN moved THEN 'F' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN moved THEN 2 ELSE 1 END AS load_id
FROM (SELECT *, strftime(o_orderdate, '%Y-%m') = '1997-06' AND o_orderstatus = 'O' AS moved FROM orders)""",
    "incremental_upsert": with_panel(
        UPSERT_SQL),
    "stream_upsert": with_panel(
        UPSERT_SQL),
    "flow_stock_reconcile": with_panel(
        "SELECT d.country_name, r.sum_flow, r.last_stock, r.last_stock - r.sum_flow AS difference FROM (SELECT country_id, "
        "CAST(sum(new_cases) AS BIGINT) AS sum_flow, arg_max(total_cases, report_date) AS last_stock FROM fact GROUP BY 1) r "
        "JOIN dim d ON d.country_id = r.country_id"),
}
