"""Versions of a table and their difference, reading only the parts that differ.

A version is written in parts: folders by a partition column and a hash bucket of the key. Beside them stands a hash
tree: of each part the number of rows and two sums of row hashes (sums do not depend on the order of rows, and count
repeated ones), of each partition value those of its parts, and of the whole table. The difference of two versions
compares the trees from the top down, and reads the files of unequal parts alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART, BUCKET, BUCKETS = "__part", "__bucket", 8


def _row_hash(df: DataFrame, seed: str) -> Column:
    """Of the row's columns by name, NULLs and empty texts apart, in exact sums."""
    cols = [c for n in sorted(df.columns) for c in (F.lit(n), F.col(n).isNull(), F.col(n))]
    return F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")


def _nodes(hashed: DataFrame, by: Sequence[str]) -> DataFrame:
    aggs = [F.sum(c).alias(c) for c in ("n", "h1", "h2")]
    return hashed.groupBy(*by).agg(*aggs) if by else hashed.agg(*aggs)


def write_version(df: DataFrame, path: str, keys: Sequence[str], partition: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` in parts by ``partition`` (a column that a key never leaves) and hash of ``keys``, and its hash tree."""
    # a letter before the value keeps folder names texts, and tells NULL from an empty text
    part = F.coalesce(F.concat(F.lit("v"), F.col(partition).cast("string")), F.lit("null"))
    placed = df.withColumns({PART: part, BUCKET: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")})
    placed.hint("rebalance", PART, BUCKET).write.partitionBy(PART, BUCKET).parquet(f"{path}/rows")
    # of what was written, so that a source that changes meanwhile cannot make tree and rows differ
    spark, cols = df.sparkSession, [c for c in df.columns]
    rows = spark.read.parquet(f"{path}/rows")
    own = rows.select(*cols)
    leaves = _nodes(rows.select(F.col(PART).cast("string").alias(PART), F.col(BUCKET).cast("int").alias(BUCKET),
                                F.lit(1).cast("decimal(38,0)").alias("n"), _row_hash(own, "a").alias("h1"),
                                _row_hash(own, "b").alias("h2")), [PART, BUCKET])
    leaves.write.parquet(f"{path}/tree/level=2")
    held = spark.read.parquet(f"{path}/tree/level=2")
    inner = _nodes(held, [PART])
    inner.write.parquet(f"{path}/tree/level=1")
    _nodes(spark.read.parquet(f"{path}/tree/level=1"), []).write.parquet(f"{path}/tree/level=0")


def _level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.parquet(f"{path}/tree/level={level}")


def unequal(spark: SparkSession, old: str, new: str) -> DataFrame | None:
    """(part, bucket) of the parts that differ, top down; None where the versions are equal."""
    tops = [_level(spark, p, 0).first() for p in (old, new)]
    if tops[0] == tops[1]:
        return None

    def differ(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
        b = b.withColumnsRenamed({c: f"o_{c}" for c in b.columns})
        same = F.lit(True)
        for c in by:
            same = same & (F.col(c) == F.col(f"o_{c}"))
        both = a.join(b, same, "full")
        equal = F.lit(True)
        for c in ("n", "h1", "h2"):
            equal = equal & F.col(c).eqNullSafe(F.col(f"o_{c}"))
        return both.where(~equal).select(*[F.coalesce(c, f"o_{c}").alias(c) for c in by])

    parts = differ(_level(spark, old, 1), _level(spark, new, 1), [PART])
    leaves = [_level(spark, p, 2).join(parts, PART, "left_semi") for p in (old, new)]
    return differ(*leaves, [PART, BUCKET])


def _rows(spark: SparkSession, path: str, parts: list[tuple[str, int]]) -> DataFrame:
    rows = spark.read.parquet(f"{path}/rows")
    by: dict[str, list[int]] = {}
    for p, b in parts:
        by.setdefault(p, []).append(b)
    wanted = F.lit(False)
    for p, bs in by.items():
        wanted = wanted | ((F.col(PART).cast("string") == p) & F.col(BUCKET).isin(bs))
    return rows.where(wanted).drop(PART, BUCKET)


#: Unequal parts that are named in a partition filter; with more, the parts are joined to the rows' folders.
FILTERED_PARTS = 2_000


def version_diff(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """The rows that differ: the columns of both versions, ``change`` and ``times``.

    As EXCEPT ALL both ways: a row stands ``times`` as often in one version as it has no partner in the other. It is
    ``removed`` or ``added``, or, where its key has rows on both sides, ``changed_from`` or ``changed_to``. NULLs are
    equal to NULLs; a column that only one version has is NULL in the other.
    """
    differ = unequal(spark, old, new)
    if differ is None:
        frames = [spark.read.parquet(f"{p}/rows").drop(PART, BUCKET).limit(0) for p in (old, new)]
    else:
        differ = differ.persist()
        few = differ.limit(FILTERED_PARTS + 1).collect()
        if len(few) <= FILTERED_PARTS:
            frames = [_rows(spark, p, [tuple(r) for r in few]) for p in (old, new)]
        else:
            frames = [spark.read.parquet(f"{p}/rows").join(differ, [PART, BUCKET], "left_semi").drop(PART, BUCKET) for p in (old, new)]
    one = F.lit(1).cast("bigint")
    both = frames[0].withColumn("__n", -one).unionByName(frames[1].withColumn("__n", one), allowMissingColumns=True)
    cols = [c for c in both.columns if c != "__n"]
    net = both.groupBy(*cols).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)
    sides = net.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        (F.max("__n") > 0).alias("__in_new"), (F.min("__n") < 0).alias("__in_old"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    both_sides = F.col("__in_new") & F.col("__in_old")
    change = F.when(F.col("__n") > 0, F.when(both_sides, "changed_to").otherwise("added")).otherwise(
        F.when(both_sides, "changed_from").otherwise("removed"))
    return net.join(sides, same).select(*cols, change.alias("change"), F.abs("__n").alias("times"))
