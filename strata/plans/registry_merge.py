"""Registry part 5: aggregates that merge (sketches, bitmaps), RANGE and GROUPS frames, hierarchies."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from strata.operators import bitmaps, frames, hierarchy, sketches
from strata.operators.ranking import with_row_number
from strata.plans.oracle import r_up
from strata.session import new_output_path, partitions_for
from strata.sources.tables import read_table

QUANTILES = (0.5, 0.9, 0.99)


# ---------------------------------------------------------------- sketches: stored by day, merged to weeks
def _events(spark, sf):
    return read_table(spark, sf, "events", ["user_id", "ts", "event_type", "value"]).withColumn("day", F.col("ts").cast("date"))


def _stored(spark, daily, name):
    """The daily sketches as a table of their own, partitioned by day: a merge reads these alone."""
    path = new_output_path(spark, name)
    daily.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return spark.read.parquet(path).withColumn("week", F.date_trunc("week", "day").cast("date"))


def sketch_quantiles(spark, sf):
    """Median and upper quantiles of value by week and type, within 1 %, from daily sketches."""
    daily = _stored(spark, sketches.quantile_sketches(_events(spark, sf), ["day", "event_type"], "value"), "quantile-sketches")
    weekly = sketches.merge_quantiles(daily, ["week", "event_type"])
    return weekly.select("week", "event_type", *[F.round(sketches.quantile("sketch", q), 6).alias(f"p{round(q * 100)}") for q in QUANTILES])


def sketch_distinct(spark, sf):
    """Distinct users by week and type, exact, and whether the estimate from daily sketches is within its bound."""
    ev = _events(spark, sf)
    daily = _stored(spark, sketches.distinct_sketches(ev, ["day", "event_type"], "user_id"), "distinct-sketches")
    weekly = sketches.merge_distinct(daily, ["week", "event_type"]).withColumn("estimate", sketches.distinct_estimate())
    exact = ev.withColumn("week", F.date_trunc("week", "day").cast("date")).groupBy("week", "event_type").agg(
        F.count_distinct("user_id").alias("n_users"))
    within = F.abs(F.col("estimate") - F.col("n_users")) <= F.greatest(F.lit(1.0), F.col("n_users") * F.lit(sketches.distinct_bound()))
    return exact.join(weekly, ["week", "event_type"]).select("week", "event_type", "n_users", within.alias("within_bound"))


# ---------------------------------------------------------------- bitmaps
def distinct_rollup(spark, sf):
    """Exact distinct users and events by day, month and in all."""
    ev = _events(spark, sf).withColumn("month", F.date_format("day", "yyyy-MM"))
    return bitmaps.distinct_over_sets(ev, ["month", "day"], "user_id", bitmaps.rollup_sets(["month", "day"]))


def distinct_cube(spark, sf):
    """Exact distinct parts and lines for all subsets of ship mode flags and year."""
    li = read_table(spark, sf, "lineitem", ["l_returnflag", "l_linestatus", "l_shipdate", "l_partkey"]).withColumn("year", F.year("l_shipdate"))
    keys = ["l_returnflag", "l_linestatus", "year"]
    return bitmaps.distinct_over_sets(li, keys, "l_partkey", bitmaps.cube_sets(keys))


# ---------------------------------------------------------------- frames
def _priced(spark, sf, key):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice", key])
    return o.select("o_orderkey", key, "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


_VALUES = {f"{fn}_price": (fn, "price") for fn in ("sum", "count", "min", "max", "avg")}


def range_frame_customer(spark, sf):
    """Each order with the customer's orders of the 30 days up to it (gappy dates)."""
    return frames.range_frames(_priced(spark, sf, "o_custkey"), ["o_custkey"], "o_orderdate", _VALUES, 30)


def range_frame_priority(spark, sf):
    """Each order with all of its priority from a week before to a week after (five series that hold all rows)."""
    return frames.range_frames(_priced(spark, sf, "o_orderpriority"), ["o_orderpriority"], "o_orderdate", _VALUES, 7, 7)


def groups_frame_priority(spark, sf):
    """Each order with all of its priority from two order days before to one after."""
    return frames.groups_frames(_priced(spark, sf, "o_orderpriority"), ["o_orderpriority"], "o_orderdate", _VALUES, 2, 1)


# ---------------------------------------------------------------- hierarchies
def hierarchy_orders(spark, sf):
    """Orders as chains (an order's parent is its customer's order before): totals of all later ones."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    with partitions_for(spark, o.count()):
        n = with_row_number(o, [F.col("o_orderdate"), F.col("o_orderkey")], "k", by=["o_custkey"])
        before = n.select(F.col("o_custkey").alias("c"), (F.col("k") + 1).alias("k2"), F.col("o_orderkey").alias("parent"))
        chain = n.join(before, (F.col("o_custkey") == F.col("c")) & (F.col("k") == F.col("k2")), "left")
        chain = chain.select("o_orderkey", "parent", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
        return hierarchy.closure_totals(chain, "o_orderkey", "parent", "price")


SPARK = {
    "sketch_quantiles": sketch_quantiles, "sketch_distinct": sketch_distinct, "distinct_rollup": distinct_rollup,
    "distinct_cube": distinct_cube, "range_frame_customer": range_frame_customer, "range_frame_priority": range_frame_priority,
    "groups_frame_priority": groups_frame_priority, "hierarchy_orders": hierarchy_orders,
}

_STEP = math.log((1 + sketches.ERROR) / (1 - sketches.ERROR))


def _middle(q: float) -> str:
    v = f"list_sort(list(CAST(value AS DOUBLE)))[CAST(floor({q} * (count(value) - 1)) AS BIGINT) + 1]"
    return r_up(f"exp(ceil(ln({v}) / {_STEP!r}) * {_STEP!r}) * {1 - sketches.ERROR!r}", 6)


def _frame(key: str, kind: str) -> str:
    return f"""
WITH o AS (SELECT o_orderkey, {key}, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
SELECT *, sum(price) OVER w AS sum_price, count(price) OVER w AS count_price, min(price) OVER w AS min_price,
       max(price) OVER w AS max_price, CAST(sum(price) OVER w AS DOUBLE) / count(price) OVER w AS avg_price
FROM o WINDOW w AS (PARTITION BY {key} ORDER BY o_orderdate {kind})"""


ORACLE = {
    "sketch_quantiles": "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, "
                        + ", ".join(f"{_middle(q)} AS p{round(q * 100)}" for q in QUANTILES) + " FROM events GROUP BY 1, 2",
    "sketch_distinct": "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(DISTINCT user_id) AS n_users, "
                       "true AS within_bound FROM events GROUP BY 1, 2",
    "distinct_rollup": """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m') AS month FROM events)
SELECT month, day, grouping(month, day) AS grouping_id, count(*) AS n_rows, count(DISTINCT user_id) AS n_distinct
FROM e GROUP BY ROLLUP (month, day)""",
    "distinct_cube": """
WITH e AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS year, l_partkey FROM lineitem)
SELECT l_returnflag, l_linestatus, year, grouping(l_returnflag, l_linestatus, year) AS grouping_id, count(*) AS n_rows,
       count(DISTINCT l_partkey) AS n_distinct FROM e GROUP BY CUBE (l_returnflag, l_linestatus, year)""",
    "range_frame_customer": _frame("o_custkey", "RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW"),
    "range_frame_priority": _frame("o_orderpriority", "RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY FOLLOWING"),
    "groups_frame_priority": _frame("o_orderpriority", "GROUPS BETWEEN 2 PRECEDING AND 1 FOLLOWING"),
    "hierarchy_orders": """
WITH RECURSIVE n AS (
  SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
up(node, anc, depth) AS (
  SELECT o_orderkey, o_orderkey, 0 FROM n
  UNION ALL SELECT u.node, n.parent, u.depth + 1 FROM up u JOIN n ON n.o_orderkey = u.anc WHERE n.parent IS NOT NULL),
below AS (SELECT anc, count(*) - 1 AS n_below, sum(price) AS total FROM up JOIN n ON n.o_orderkey = up.node GROUP BY 1)
SELECT u.node AS o_orderkey, arg_max(u.anc, u.depth) AS root, CAST(max(u.depth) AS BIGINT) AS depth, any_value(b.n_below) AS n_below,
       any_value(b.total) AS total, false AS in_cycle FROM up u JOIN below b ON b.anc = u.node GROUP BY 1""",
}
