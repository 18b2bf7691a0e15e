"""Registry part 6: differences between versions of a table, and semi-structured raw rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.session import new_output_path
from strata.sources import nested, versions
from strata.sources.tables import read_table

ORDER = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
# FIXED VALUES: the months in which the second version of the orders closes, drops, adds and repeats rows.
CLOSED, DROPPED, ADDED, REPEATED = "1997-06", "1998-03", "1999-01", "2000-05"


def two_versions(spark, sf):
    """Folders of the orders as they are, and after corrections in four months."""
    old = read_table(spark, sf, "orders", ORDER).withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    m = F.col("month")
    closed = F.when((m == CLOSED) & (F.col("o_orderstatus") == "O"), "F").otherwise(F.col("o_orderstatus"))
    new = old.withColumn("o_orderstatus", closed).where(~((m == DROPPED) & (F.col("o_orderpriority") == "1-URGENT")))
    new = new.unionByName(old.where(m == ADDED).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000))
    new = new.unionByName(old.where((m == REPEATED) & (F.col("o_orderpriority") == "5-LOW")))
    paths = [new_output_path(spark, "orders-version") for _ in range(2)]
    for df, path in zip((old, new), paths, strict=True):
        versions.write_version(df, path, ["o_orderkey"], "month", buckets=1)
    return paths


def version_diff(spark, sf):
    return versions.version_diff(spark, *two_versions(spark, sf), ["o_orderkey"])


# FIXED VALUES: from this day on the raw rows have other field names and types; long error rows are cut off.
DRIFT_DAY, CUT_VALUE = "2024-01-16", 50
_OLD = """'{"user": {"id": ' || user_id || '}, "type": "' || event_type || '", "value": ' || value || ', "props": ' || props || '}'"""
_NEW = ("""'{"account": {"id": ' || user_id || '}, "kind": "' || event_type || '", "value": "' || value || '", "props": ' || props || ', "tags": [1, 2]}'""")


def raw_rows(spark, sf):
    """(event_id, day, text): events as JSON texts whose fields drift, some of them cut off."""
    ev = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"]).withColumn("day", F.col("ts").cast("date"))
    text = F.when(F.col("day") < F.lit(DRIFT_DAY).cast("date"), F.expr(_OLD)).otherwise(F.expr(_NEW))
    cut = (F.col("event_type") == "error") & (F.col("value") > CUT_VALUE)
    return ev.withColumn("text", text).select("event_id", "day", F.when(cut, F.expr("left(text, 20)")).otherwise(F.col("text")).alias("text"))


FIELDS = {"user_id": (["$.user.id", "$.account.id"], "bigint"), "event_type": (["$.type", "$.kind"], "string"),
          "value": (["$.value"], "double"), "k": (["$.props.k"], "int")}


def nested_extract(spark, sf):
    rows = nested.extract(nested.parse_rows(raw_rows(spark, sf), "text"), FIELDS)
    return rows.select("event_id", "day", *FIELDS, "malformed")


def nested_drift(spark, sf):
    return nested.drift_report(nested.parse_rows(raw_rows(spark, sf), "text"), "day")


SPARK = {"version_diff": version_diff, "nested_extract": nested_extract, "nested_drift": nested_drift}

_RAW = f"""
raw AS (SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' AND value > {CUT_VALUE} THEN left(t, 20) ELSE t END AS text
        FROM (SELECT *, CASE WHEN CAST(ts AS DATE) < DATE '{DRIFT_DAY}' THEN {_OLD} ELSE {_NEW} END AS t FROM events)),
good AS (SELECT *, json_valid(text) AS ok FROM raw)"""
_PATHS = ["$.user", "$.user.id", "$.type", "$.account", "$.account.id", "$.kind", "$.value", "$.props", "$.props.k", "$.tags"]

ORACLE = {
    "version_diff": f"""
WITH v1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
                   strftime(o_orderdate, '%Y-%m') AS month FROM orders),
v2 AS (SELECT * REPLACE (CASE WHEN month = '{CLOSED}' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus) FROM v1
       WHERE NOT (month = '{DROPPED}' AND o_orderpriority = '1-URGENT')
       UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM v1 WHERE month = '{ADDED}'
       UNION ALL SELECT * FROM v1 WHERE month = '{REPEATED}' AND o_orderpriority = '5-LOW'),
net AS (SELECT *, 0 AS new, count(*) AS times FROM (SELECT * FROM v1 EXCEPT ALL SELECT * FROM v2) GROUP BY ALL
        UNION ALL SELECT *, 1 AS new, count(*) AS times FROM (SELECT * FROM v2 EXCEPT ALL SELECT * FROM v1) GROUP BY ALL)
SELECT n.* EXCLUDE (new, times), CASE WHEN new = 1 THEN CASE WHEN both_sides THEN 'changed_to' ELSE 'added' END
       ELSE CASE WHEN both_sides THEN 'changed_from' ELSE 'removed' END END AS change, times
FROM (SELECT *, min(new) OVER k = 0 AND max(new) OVER k = 1 AS both_sides FROM net WINDOW k AS (PARTITION BY o_orderkey)) n(
      o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, month, new, times, both_sides)""".replace(
        "n.* EXCLUDE (new, times)", "n.* EXCLUDE (new, times, both_sides)"),
    "nested_extract": f"""
WITH {_RAW}
SELECT event_id, day, CASE WHEN ok THEN CAST(coalesce(json_extract_string(text, '$.user.id'), json_extract_string(text, '$.account.id')) AS BIGINT) END AS user_id,
       CASE WHEN ok THEN coalesce(json_extract_string(text, '$.type'), json_extract_string(text, '$.kind')) END AS event_type,
       CASE WHEN ok THEN CAST(json_extract_string(text, '$.value') AS DOUBLE) END AS value,
       CASE WHEN ok THEN CAST(json_extract_string(text, '$.props.k') AS INTEGER) END AS k, NOT ok AS malformed FROM good""",
    "nested_drift": f"""
WITH {_RAW},
seen AS (SELECT day, p AS path, json_type(text, p) AS t FROM good, (SELECT unnest({_PATHS!r}) AS p) WHERE ok)
SELECT path, CASE t WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'VARCHAR' THEN 'STRING' ELSE t END AS type,
       count(*) AS n_rows, min(day) AS first_day, max(day) AS last_day FROM seen WHERE t IS NOT NULL GROUP BY 1, 2""",
}
