"""Registry part 4: joins over time (as-of, interval overlap), event-time windows and keyed state as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.asof import asof_join, micros
from strata.operators.intervals import interval_join, window_counts
from strata.session import new_output_path, shared_dir
from strata.sources.tables import read_table
from strata.streaming import state, windows

EVENT = ["event_id", "ts", "user_id", "event_type", "value"]

# ---------------------------------------------------------------- as-of joins


def asof_last_purchase(spark, sf):
    """Every event with its user's last purchase before it."""
    ev = read_table(spark, sf, "events", EVENT)
    bought = ev.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("purchase_ts"), F.col("event_id").alias("purchase_id"), F.col("value").alias("purchase_value"))
    return asof_join(ev.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "purchase_ts", strict=True,
                     tie=["purchase_id"])


def _shipments(spark, sf):
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    lines = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate"])
    shipped = lines.join(orders.select("o_orderkey", "o_custkey"), lines.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    return shipped, orders


def asof_last_order(spark, sf):
    """Every shipped line with its customer's last order up to that day (of one day's the largest key)."""
    shipped, orders = _shipments(spark, sf)
    placed = orders.select("o_custkey", F.col("o_orderdate").alias("last_order_date"), F.col("o_orderkey").alias("last_order"))
    return asof_join(shipped, placed, ["o_custkey"], "l_shipdate", "last_order_date", tie=["last_order"])


def asof_next_order(spark, sf):
    """Every shipped line with its customer's next order within 30 days after it."""
    shipped, orders = _shipments(spark, sf)
    placed = orders.select("o_custkey", F.col("o_orderdate").alias("next_order_date"), F.col("o_orderkey").alias("next_order"))
    return asof_join(shipped, placed, ["o_custkey"], "l_shipdate", "next_order_date", direction="forward",
                     tolerance=F.expr("INTERVAL 30 DAY"), tie=["next_order"])


# ---------------------------------------------------------------- interval overlap joins
def _open_orders(spark, sf):
    """Orders with the day of their last shipment, written once: both sides of a join read them."""
    shipped, orders = _shipments(spark, sf)
    last = shipped.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("done"))
    shared_dir(spark)
    return last.join(orders, last.l_orderkey == orders.o_orderkey).select("o_custkey", "o_orderkey", "o_orderdate", "done").checkpoint()


def interval_open_orders(spark, sf):
    """Pairs of orders of one customer that were open (from order to last shipment) at the same time."""
    orders = _open_orders(spark, sf)
    a, b = (orders.toDF("o_custkey", *[f"{n}_{k}" for n in ("order", "from", "until")]) for k in "ab")
    pairs = interval_join(a, b, ("from_a", "until_a"), ("from_b", "until_b"), by=["o_custkey"])
    return pairs.where("order_a < order_b").select(
        "o_custkey", "order_a", "order_b", F.greatest("from_a", "from_b").alias("overlap_from"),
        F.least("until_a", "until_b").alias("overlap_until"))


def interval_incidents(spark, sf, minutes=10):
    """Events and users inside each incident: the minutes after each error, and one that covers all time (id -1).

    Incidents and the events inside them both grow with the events, so their pairs would grow with the square. An incident
    that is one window of these minutes is joined to the stretch of openings that have its counts, one pair each. Ids
    with several windows or one without end (users count once over all of them) have their pairs with the events.
    """
    ev = read_table(spark, sf, "events", EVENT)
    errors = ev.where("event_type = 'error'").select(
        F.col("event_id").alias("incident_id"), F.col("ts").alias("opened"),
        (F.col("ts") + F.expr(f"INTERVAL {minutes} MINUTE")).alias("closed"))
    always = ev.agg(F.min("ts").alias("opened")).select(F.lit(-1).cast("bigint").alias("incident_id"), "opened",
                                                        F.lit(None).cast(ev.schema["ts"].dataType).alias("closed"))
    incidents = errors.union(always).where(F.col("opened").isNotNull())
    ids = incidents.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min("opened").alias("first"),
        ((F.min("opened") == F.max("opened")) & (F.count("closed") == F.count(F.lit(1)))).alias("single"))
    at = micros(F.col("first"), ev.schema["ts"].dataType)
    single = ids.where("single").select("incident_id", "copies", at.alias("at"), (at + 1).alias("after"))
    stretches = window_counts(ev, "ts", "user_id", minutes * 60_000_000)
    counted = interval_join(single, stretches, ("at", "after"), ("since", "until")).select(
        "incident_id", (F.col("n_rows") * F.col("copies")).alias("n_events"), F.col("n_distinct").alias("n_users"))
    several = ids.where("NOT single").select(F.col("incident_id").alias("several"))
    rest = incidents.join(several, F.col("incident_id").eqNullSafe(F.col("several")), "left_semi")
    points = ev.select("event_id", "user_id", "ts", (F.col("ts") + F.expr("INTERVAL 1 MICROSECOND")).alias("after"))
    pairs = interval_join(points, rest, ("ts", "after"), ("opened", "closed"))
    return counted.unionByName(pairs.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users")))


# ---------------------------------------------------------------- streams over events
FILES, DELAY, STATE = 6, "1 day", 8


def arrivals(spark: SparkSession, sf: str, late_hours: int) -> DataFrame:
    """Events with the file (0 to FILES - 1) they arrive in: by their time, but errors ``late_hours`` an unit of value later."""
    ev = read_table(spark, sf, "events", EVENT)
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2020-01-01 00:00:00', ts)")
    ev = ev.withColumn("__us", us)
    span = ev.agg(F.min("__us").alias("lo"), F.max("__us").alias("hi")).first()
    late = F.when(F.col("event_type") == "error", F.floor(F.col("value") * late_hours * 3_600_000_000)).otherwise(0)
    width = ((span["hi"] or 0) - (span["lo"] or 0)) // FILES + 1
    file = F.least(F.floor((F.col("__us") + late - F.lit(span["lo"] or 0)) / F.lit(width)), F.lit(FILES - 1))
    return ev.withColumn("file", F.coalesce(file, F.lit(0)).cast("int")).drop("__us")


def arrive(spark: SparkSession, events: DataFrame, source: str, files, schema) -> None:
    """Write these files into the stream's folder, each after the one before."""
    for k in files:
        one = events.where(F.col("file") == k).select(*[f.name for f in schema])
        one.coalesce(1).write.mode("append").parquet(source)


def _stream(spark, sf, **window):
    """Windows of the arriving events and the query that made them."""
    ev = arrivals(spark, sf, 3).persist()
    schema = ev.select(*EVENT).schema
    source, table, check = (new_output_path(spark, n) for n in ("arrivals", "windows", "windows-state"))
    arrive(spark, ev, source, range(FILES), schema)
    windows.end_stream(spark, source, schema, "ts")
    query = windows.start_windows(spark, source, schema, table, check, "ts", "event_id", DELAY, partitions=STATE, **window)
    query.awaitTermination()
    ev.unpersist()
    return spark.read.parquet(table), query


def stream_tumbling(spark, sf):
    return _stream(spark, sf, by=["event_type"], width="6 hours", value="value")[0]


def stream_sliding(spark, sf):
    return _stream(spark, sf, by=["event_type"], width="1 day", slide="6 hours", value="value")[0]


def stream_sessions(spark, sf):
    return _stream(spark, sf, by=["user_id"], gap="4 hours", value="value")[0]


def stream_late_rows(spark, sf):
    """Rows of the stream that were counted in a window and rows that came too late for theirs."""
    out, query = _stream(spark, sf, width="1 day")
    return out.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_counted")).withColumn(
        "n_late", F.lit(windows.late_rows(query)).cast("bigint"))


def stream_entity_state(spark, sf, expiry_hours=6):
    """Each user's latest event and totals, life by life, from a stream that stops halfway and starts again."""
    ev = arrivals(spark, sf, 0).persist()
    schema = ev.select(*EVENT).schema
    source, table, check = (new_output_path(spark, n) for n in ("arrivals", "lives", "lives-state"))
    for files, last in ((range(FILES // 2), False), (range(FILES // 2, FILES), True)):
        arrive(spark, ev, source, files, schema)
        if last:
            windows.end_stream(spark, source, schema, "ts")
        state.start_lives(spark, source, schema, table, check, entity="user_id", ts="ts", event_id="event_id",
                          kind="event_type", value="value", expiry_seconds=expiry_hours * 3600, delay="1 hour",
                          partitions=STATE).awaitTermination()
    ev.unpersist()
    out = state.lives(spark, table)
    return out.select(F.col("entity").alias("user_id"), F.col("first").alias("first_us"), F.col("last").alias("last_us"),
                      F.col("last_id").alias("last_event_id"), F.col("last_type").alias("last_event_type"), "n", "cents", "closed")


SPARK = {
    "asof_last_purchase": asof_last_purchase, "asof_last_order": asof_last_order, "asof_next_order": asof_next_order,
    "interval_open_orders": interval_open_orders, "interval_incidents": interval_incidents,
    "stream_tumbling": stream_tumbling, "stream_sliding": stream_sliding, "stream_sessions": stream_sessions,
    "stream_late_rows": stream_late_rows, "stream_entity_state": stream_entity_state,
}

_SHIPPED = """
shipped AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, o_custkey
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
placed AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_orderkey) AS k FROM orders
           WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY ALL)"""

# arrival file and lateness of each event, as the stream's triggers see them: trigger k reads file k, and drops rows up to
# DELAY before the latest time of files that earlier triggers had handed on
_ARRIVALS = f"""
us AS (SELECT *, epoch_us(ts) AS u, min(epoch_us(ts)) OVER () AS lo, max(epoch_us(ts)) OVER () AS hi FROM events WHERE ts IS NOT NULL),
arr AS (SELECT *, least((u + CASE WHEN event_type = 'error' THEN CAST(floor(value * {{hours}} * 3600000000) AS BIGINT) ELSE 0 END - lo)
                        // ((hi - lo) // {FILES} + 1), {FILES - 1}) AS file FROM us),
tops AS (SELECT f.file, (SELECT max(u) FROM arr a WHERE a.file <= f.file - {{lag}}) // 1000 * 1000 - 86400000000 AS mark
         FROM range({FILES}) f(file)),
kept AS (SELECT arr.* FROM arr JOIN tops USING (file) WHERE mark IS NULL OR u > mark)"""


def _windowed(by: str, hours: int, slide: int) -> str:
    n = hours // slide
    at = f"time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL {slide} HOUR * i"
    return (f"SELECT {by}, s AS window_start, s + INTERVAL {hours} HOUR AS window_end, count(*) AS n, "
            f"sum(CAST(value AS DECIMAL(18,2))) AS total FROM (SELECT *, {at} AS s FROM kept, range({n}) r(i)) GROUP BY ALL")


def _islands(of: str, gap_us: int, strict: str) -> str:
    """Events ``of`` numbered by their user's runs: a gap of more than (``>``) or at least (``>=``) gap_us begins one."""
    return (f"SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS life FROM (SELECT *, CASE WHEN epoch_us(ts) - "
            f"lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) {strict} {gap_us} THEN 1 ELSE 0 END AS new FROM {of})")


LAG = 2

ORACLE = {
    "asof_last_purchase": """
WITH p AS (SELECT user_id, ts AS purchase_ts, max(event_id) AS purchase_id, arg_max(value, event_id) AS purchase_value
           FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, e.user_id, e.ts, p.purchase_ts, p.purchase_id, p.purchase_value
FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts > p.purchase_ts""",
    "asof_last_order": f"""
WITH {_SHIPPED}
SELECT s.*, p.d AS last_order_date, p.k AS last_order
FROM shipped s ASOF LEFT JOIN placed p ON s.o_custkey = p.o_custkey AND s.l_shipdate >= p.d""",
    "asof_next_order": f"""
WITH {_SHIPPED}
SELECT s.*, CASE WHEN p.d <= s.l_shipdate + INTERVAL 30 DAY THEN p.d END AS next_order_date,
       CASE WHEN p.d <= s.l_shipdate + INTERVAL 30 DAY THEN p.k END AS next_order
FROM shipped s ASOF LEFT JOIN placed p ON s.o_custkey = p.o_custkey AND s.l_shipdate <= p.d""",
    "interval_open_orders": """
WITH o AS (SELECT o_custkey, o_orderkey AS k, CAST(any_value(o_orderdate) AS DATE) AS f, CAST(max(l_shipdate) AS DATE) AS u
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT a.o_custkey, a.k AS order_a, b.k AS order_b, greatest(a.f, b.f) AS overlap_from, least(a.u, b.u) AS overlap_until
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.k < b.k AND a.f < b.u AND b.f < a.u AND a.f < a.u AND b.f < b.u""",
    "interval_incidents": """
WITH i AS (SELECT event_id AS incident_id, ts AS opened, ts + INTERVAL 10 MINUTE AS closed FROM events WHERE event_type = 'error'
           UNION ALL SELECT -1, min(ts), NULL FROM events)
SELECT incident_id, count(*) AS n_events, count(DISTINCT user_id) AS n_users
FROM i JOIN events e ON e.ts >= i.opened AND (i.closed IS NULL OR e.ts < i.closed) GROUP BY 1""",
    "stream_tumbling": f"WITH {_ARRIVALS.format(hours=3, lag=LAG)} {_windowed('event_type', 6, 6)}",
    "stream_sliding": f"WITH {_ARRIVALS.format(hours=3, lag=LAG)} {_windowed('event_type', 24, 6)}",
    "stream_sessions": f"""WITH {_ARRIVALS.format(hours=3, lag=LAG)}
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 4 HOUR AS window_end, count(*) AS n,
       sum(CAST(value AS DECIMAL(18,2))) AS total FROM ({_islands('kept', 4 * 3600 * 10**6, '>=')}) GROUP BY user_id, life""",
    "stream_late_rows": f"""WITH {_ARRIVALS.format(hours=3, lag=LAG)}
SELECT (SELECT count(*) FROM kept) AS n_counted, (SELECT count(*) FROM arr) - (SELECT count(*) FROM kept) AS n_late""",
    "stream_entity_state": f"""
WITH live AS ({_islands('(SELECT * FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL)', 6 * 3600 * 10**6, '>')})
SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, arg_max(event_id, (ts, event_id)) AS last_event_id,
       arg_max(event_type, (ts, event_id)) AS last_event_type, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, true AS closed FROM live GROUP BY user_id, life""",
}
