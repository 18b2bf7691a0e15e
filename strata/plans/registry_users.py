"""Registry part 3: the panel operators on the user x day panel (entity count grows with the data)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.expr import pct
from strata.operators.ranking import with_ntile, with_rank_variants, with_running_sum
from strata.operators.snapshot import latest_rows
from strata.plans.oracle import clip_sql, r_even, r_up
from strata.plans.panel import user_panel

U, DT = "user_id", "date"
W = "PARTITION BY user_id ORDER BY date"


def _snap(spark, sf):
    return latest_rows(user_panel(spark, sf), U, DT).select(U, DT, "total_events", "total_purchases", "value_sum")


def user_peak_day(spark, sf):
    p = user_panel(spark, sf).select(U, DT, "new_events")
    m = p.groupBy(U).agg(F.max("new_events").alias("__peak"))
    j = p.join(m, [U]).where(F.col("new_events") == F.col("__peak"))
    return j.select(U, F.col(DT).alias("peak_date"), F.col("new_events").alias("peak_events"))


def user_quintiles(spark, sf, k=5):
    v = _snap(spark, sf)
    total = v.select(F.sum("total_events")).scalar()
    t = with_ntile(v, [F.col("total_events").desc(), F.col(U)], k, "quintile")
    return t.groupBy("quintile").agg(F.count(F.lit(1)).alias("n_users"),
                                     F.sum("total_events").alias("quintile_events"),
                                     F.round(pct(F.sum("total_events"), total), 1).alias("pct_of_events"))


def user_rank_variants(spark, sf):
    v = _snap(spark, sf).select(U, "total_events")
    return with_rank_variants(v, ["total_events"], [F.col("total_events").desc(), F.col(U)])


def user_pareto_curve(spark, sf):
    v = _snap(spark, sf).select(U, "total_events")
    r = with_running_sum(v, [F.col("total_events").desc(), F.col(U)], "total_events", "__cum", total_out="__tot")
    return r.select(U, "total_events",
                    (F.col("__cum") / F.when(F.col("__tot") != 0, F.col("__tot")) * F.lit(100.0)).alias("cum_pct"))


SPARK = {
    "user_panel": lambda spark, sf: user_panel(spark, sf),
    "user_latest_snapshot": _snap,
    "user_peak_day": user_peak_day,
    "user_quintiles": user_quintiles,
    "user_rank_variants": user_rank_variants,
    "user_pareto_curve": user_pareto_curve,
}

USER_CTES = f"""
ev AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, value FROM events),
udaily AS (
  SELECT user_id, d, count(*) AS d_events, count(*) FILTER (WHERE event_type = 'purchase') AS d_purchases,
         count(*) FILTER (WHERE event_type = 'error') AS d_errors,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS d_value
  FROM ev GROUP BY 1, 2),
uspan AS (SELECT user_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM ev GROUP BY user_id),
up0 AS (
  SELECT u.user_id, u.d AS date, CAST(coalesce(x.d_events, 0) AS BIGINT) AS new_events,
         CAST(coalesce(x.d_purchases, 0) AS BIGINT) AS new_purchases, CAST(coalesce(x.d_errors, 0) AS BIGINT) AS new_errors,
         x.d_value AS value_sum, x.d_purchases / nullif(x.d_events, 0) AS conversion_rate
  FROM uspan u LEFT JOIN udaily x ON x.user_id = u.user_id AND x.d = u.d),
up1 AS (
  SELECT user_id, date, new_events, new_purchases, new_errors,
         CAST(sum(new_events) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_events,
         CAST(sum(new_purchases) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_purchases,
         CAST(sum(new_errors) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_errors,
         {r_even('coalesce(conversion_rate, new_purchases / nullif(new_events, 0), 0.0::DOUBLE)', 4)} AS conversion_rate,
         coalesce(last_value(value_sum IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(value_sum IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                  0.0::DOUBLE) AS value_sum,
         {r_even(f'avg(new_events) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 1)} AS events_7d_avg,
         coalesce(new_events / nullif(lag(new_events) OVER ({W}), 0) - 1.0::DOUBLE, 0.0::DOUBLE) AS chg
  FROM up0),
up AS (
  SELECT user_id, date, new_events, new_purchases, new_errors, value_sum, conversion_rate, total_events,
         total_purchases, total_errors, events_7d_avg,
         {r_even(f'(events_7d_avg / nullif(lag(events_7d_avg, 7) OVER ({W}), 0) - 1.0::DOUBLE) * 100.0::DOUBLE', 2)} AS events_growth_wow_pct,
         {r_even(clip_sql(f'1.0::DOUBLE + 3.0::DOUBLE * avg(chg) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 0.5, 2.5), 2)} AS events_momentum
  FROM up1),
usnap AS (SELECT user_id, date, total_events, total_purchases, value_sum FROM up u
          WHERE date = (SELECT max(date) FROM up u2 WHERE u2.user_id = u.user_id))
"""


def _with_users(body: str) -> str:
    return f"WITH {USER_CTES.strip()}\n{body}"


ORACLE = {
    "user_panel": _with_users("SELECT * FROM up"),
    "user_latest_snapshot": _with_users("SELECT * FROM usnap"),
    "user_peak_day": _with_users(
        "SELECT user_id, date AS peak_date, new_events AS peak_events FROM up u "
        "WHERE new_events = (SELECT max(new_events) FROM up u2 WHERE u2.user_id = u.user_id)"),
    "user_quintiles": _with_users(
        "SELECT CAST(q AS BIGINT) AS quintile, count(*) AS n_users, CAST(sum(total_events) AS BIGINT) AS quintile_events, "
        f"{r_up('100.0::DOUBLE * sum(total_events) / nullif(max(tot), 0)', 1)} AS pct_of_events FROM "
        "(SELECT total_events, sum(total_events) OVER () AS tot, ntile(5) OVER (ORDER BY total_events DESC, user_id) AS q "
        "FROM usnap) GROUP BY q"),
    "user_rank_variants": _with_users(
        "SELECT user_id, total_events, rank() OVER (ORDER BY total_events DESC) AS rnk, "
        "dense_rank() OVER (ORDER BY total_events DESC) AS dense_rnk, "
        "row_number() OVER (ORDER BY total_events DESC, user_id) AS row_num FROM usnap"),
    "user_pareto_curve": _with_users(
        "SELECT user_id, total_events, CAST(sum(total_events) OVER (ORDER BY total_events DESC, user_id ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) / nullif(CAST(sum(total_events) OVER () AS BIGINT), 0) "
        "* 100.0::DOUBLE AS cum_pct FROM usnap"),
}
