"""A second panel configuration: user x day from the ``events`` table.

The nation panel has a fixed 25 entities; here the entity count grows with
the data (users), so the per-entity operators (gap fill, rolling means,
growth, running totals, snapshot, peaks) and the global ones (ranks, NTILE,
running shares) run on as many partitions' worth of entities as the data has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import clean as C
from strata.operators import features as G
from strata.sources.tables import read_table

U, DT = "user_id", "date"

# FIXED VALUES: event types mapped to flows.
PURCHASE = "purchase"
ERROR = "error"


def build_user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["user_id", "ts", "event_type", "value"]) \
        .withColumn(DT, F.col("ts").cast("date"))
    daily = ev.groupBy(U, DT).agg(
        F.count(F.lit(1)).alias("d_events"),
        F.count_if(F.col("event_type") == PURCHASE).alias("d_purchases"),
        F.count_if(F.col("event_type") == ERROR).alias("d_errors"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("d_value"),
    )
    # each user's own days, first to last: rows follow the users' activity, not users x calendar
    spans = ev.groupBy(U).agg(F.min(DT).alias("__lo"), F.max(DT).alias("__hi"))
    spine = G.date_spine(spans, F.col("__lo"), F.col("__hi"), DT).select(U, DT)
    zero = F.lit(0).cast("bigint")
    p = spine.join(daily, [U, DT], "left").select(
        U, DT,
        F.coalesce("d_events", zero).alias("new_events"),
        F.coalesce("d_purchases", zero).alias("new_purchases"),
        F.coalesce("d_errors", zero).alias("new_errors"),
        F.col("d_value").alias("value_sum"),
        (F.col("d_purchases") / F.when(F.col("d_events") != 0, F.col("d_events"))).alias("conversion_rate"),
    )
    p = G.cumulative_total(p, {"total_events": "new_events", "total_purchases": "new_purchases",
                               "total_errors": "new_errors"}, U, DT)
    p = C.recompute_missing_ratio(p, "conversion_rate", "new_purchases", "new_events", 4)
    p = C.fill_series_gaps(p, ["value_sum"], U, DT, default=0.0)
    p = G.rolling_mean(p, "new_events", "events_7d_avg", 7, 1, U, DT, digits=1)
    p = G.growth_wow(p, "events_7d_avg", "events_growth_wow_pct", 7, U, DT, 2)
    p = G.momentum_index(p, "new_events", "events_momentum", entity=U, date=DT)
    return p
