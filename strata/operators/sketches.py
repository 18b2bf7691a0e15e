"""Sketches as columns: distinct counts and quantiles per day, stored, and merged to months and groups later.

Distinct counts are HyperLogLog sketches (binary columns). With 2 to the power of ``LG_K`` registers the relative
standard error is 1.04 / sqrt(2 ** LG_K), 1.6 % at 12; ``distinct_bound`` is three of these. Union keeps the larger
register, so a merge of parts is the sketch of the whole.

Quantiles are histograms over buckets whose edges grow by a constant factor: every value of a bucket is within
``error`` of its middle, relatively, so is every quantile. Merging adds counts: parts give the whole, exactly and in any
order. A sketch is an array of (bucket, n) in the order of values, some thousand entries at most for numbers of
everyday size (a range of 10 to the power of 12 has 1,400 at 1 %), whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, ERROR = 12, 0.01
#: Buckets of positive numbers stand above this, those of negative ones below its negative; zero is bucket 0.
_BASE = 1 << 20


def distinct_bound(lg_k: int = LG_K) -> float:
    """The relative error that 997 of 1,000 estimates stay within."""
    return 3 * 1.04 / math.sqrt(1 << lg_k)


def distinct_sketches(df: DataFrame, by: Sequence[str], value: str, out: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct non-NULL values for each ``by``; numbers, strings or binary."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias(out))


def merge_distinct(sketches: DataFrame, by: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """The sketches of coarser groups from stored ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(sketch).alias(sketch))


def distinct_estimate(sketch: str = "sketch") -> Column:
    return F.hll_sketch_estimate(sketch)


def _bucket(v: Column, error: float) -> Column:
    step = math.log((1 + error) / (1 - error))
    size = F.ceil(F.log(F.abs(v)) / F.lit(step)).cast("int") + _BASE
    return F.when(v > 0, size).when(v < 0, -size).when(v == 0, 0)


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, out: str = "sketch", error: float = ERROR) -> DataFrame:
    """One sketch of the finite values for each ``by`` (NULL, NaN and infinite ones do not count).

    Groups without any value have no row. Values are counted by bucket where they are read, so a group that has
    most rows ships its buckets only.
    """
    v = F.col(value).cast("double")
    counted = df.select(*by, _bucket(v, error).alias("bucket")).where(F.abs(v) < float("inf")).groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("n"))
    return _as_sketch(counted, by, out)


def _as_sketch(counted: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    return counted.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias(out))


def merge_quantiles(sketches: DataFrame, by: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """The sketches of coarser groups from stored ones of the same error."""
    each = sketches.select(*by, F.explode(sketch).alias("e")).select(*by, "e.bucket", "e.n")
    return _as_sketch(each.groupBy(*by, "bucket").agg(F.sum("n").alias("n")), by, sketch)


def quantile(sketch: str, q: float, error: float = ERROR) -> Column:
    """The value of rank floor(q * (n - 1)) (from 0), within ``error`` of it, relatively."""
    entries, step = F.col(sketch), math.log((1 + error) / (1 - error))
    total = F.aggregate(entries, F.lit(0).cast("bigint"), lambda a, e: a + e["n"])
    rank = F.floor(F.lit(float(q)) * (total - 1))
    at = F.aggregate(entries, F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("bucket")),
                     lambda a, e: F.struct((a["seen"] + e["n"]).alias("seen"), F.when(
                         a["bucket"].isNull() & (a["seen"] + e["n"] > rank), e["bucket"]).otherwise(a["bucket"]).alias("bucket")))
    b = at["bucket"]
    middle = F.exp((F.abs(b) - _BASE) * F.lit(step)) * F.lit(1 - error)
    return F.when(b == 0, F.lit(0.0)).otherwise(F.signum(b.cast("double")) * middle)
