"""Semi-structured rows: VARIANT columns, extraction by path, and a report of fields that come, go or change type.

Each raw text is parsed once to a VARIANT; what is no JSON becomes NULL and is counted, never an error. Fields are
taken by path with a type, from the first of several paths that has a value (a field that was renamed). The drift
report lists every path and type with the days it was seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_rows(df: DataFrame, text: str, out: str = "raw", malformed: str = "malformed") -> DataFrame:
    """``df`` with the VARIANT of ``text`` and whether it is no JSON object. A NULL or blank text is malformed."""
    v = F.try_parse_json(F.col(text))
    parsed = df.withColumn(out, v)
    kind = F.schema_of_variant(F.col(out))
    ok = F.col(out).isNotNull() & F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    return parsed.withColumn(malformed, ~ok).withColumn(out, F.when(ok, F.col(out)))


def extract(df: DataFrame, fields: dict[str, tuple[Sequence[str], str]], raw: str = "raw") -> DataFrame:
    """``df`` with ``{out: (paths, type)}``: the value at the first path that has one of that type, else NULL.

    A value that cannot be cast to the type counts as none.
    """
    def field(paths, kind):
        return F.coalesce(*[F.try_variant_get(F.col(raw), p, kind) for p in paths])

    return df.withColumns({out: field(paths, kind) for out, (paths, kind) in fields.items()})


def drift_report(df: DataFrame, day: str, raw: str = "raw", depth: int = 3) -> DataFrame:
    """path, type, n_rows, first_day, last_day of all fields down to ``depth`` objects, of all rows.

    Rows are counted by path and type where they are read. Arrays are not opened. Keys of an object are its path's next part.
    """
    spark = df.sparkSession
    level = df.select(F.col(day).alias("day"), F.lit("$").alias("path"), F.col(raw).alias("v")).where(F.col(raw).isNotNull())
    seen = None
    for k in range(depth):
        opened = level.alias("l").lateralJoin(spark.tvf.variant_explode(F.col("l.v").outer()))
        own = opened.where(F.col("key").isNotNull()).select(
            "day", F.concat_ws(".", "path", "key").alias("path"), F.col("value").alias("v"))
        own = own.withColumn("type", F.when(F.schema_of_variant("v").startswith("OBJECT"), "OBJECT").when(
            F.schema_of_variant("v").startswith("ARRAY"), "ARRAY").otherwise(
            F.regexp_replace(F.schema_of_variant("v"), r"\(.*", "")))
        counted = own.groupBy("path", "type").agg(F.count(F.lit(1)).alias("n_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
        seen = counted if seen is None else seen.unionByName(counted)
        level = own.where("type = 'OBJECT'").select("day", "path", "v")
    return seen
