"""Statistics: guarded Pearson r, its p-value, distribution and profile tables."""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ranking import with_running_sums


def pearson(x: str, y: str) -> Column:
    """corr(x, y), NULL when either side has zero variance (ANSI corr would divide by zero)."""
    ok = (F.var_pop(x) > 0) & (F.var_pop(y) > 0)
    return F.when(ok, F.corr(x, y))


def pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int | None = 3) -> DataFrame:
    """One aggregate computing every pair, returned long (x, y, n, r)."""
    aggs = []
    for i, (x, y) in enumerate(pairs):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        aggs.append(F.count_if(both).alias(f"n{i}"))
        r = pearson(x, y)
        aggs.append((F.round(r, digits) if digits is not None else r).alias(f"r{i}"))
    one = df.agg(*aggs)
    rows = ", ".join(f"'{x}', '{y}', n{i}, r{i}" for i, (x, y) in enumerate(pairs))
    return one.selectExpr(f"stack({len(pairs)}, {rows}) as (x, y, n, r)")


#: Steps of the continued fraction at most: it settles after some sqrt(dof) of them.
MAX_STEPS = 20_000


def t_two_sided_p(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t, for any dof >= 1.

    p = I_x(v/2, 1/2), x = v / (v + t^2): the tail itself, so small p keep their relative precision and
    none is negative. The incomplete beta function is its continued fraction by Lentz's method, on the
    side where it settles fast, in bounded memory. The gamma ratio in its factor is an asymptotic series
    at a + 20, brought down by recurrence. Built from ``aggregate`` over a ``sequence``: JVM expressions.
    """
    v = dof.cast("double")
    a = v / 2.0
    half = F.lit(0.5)
    t2 = t * t
    x, y = v / (v + t2), t2 / (v + t2)
    # G(a + 1/2) / G(a), from its series at z = a + 20
    z = a + 20.0
    series = F.sqrt(z) * (1.0 - 1.0 / (8.0 * z) + 1.0 / (128.0 * z * z) + 5.0 / (1024.0 * z * z * z)
                          - 21.0 / (32768.0 * z * z * z * z) - 399.0 / (262144.0 * z * z * z * z * z))
    ratio = F.aggregate(F.sequence(F.lit(0), F.lit(19)), series, lambda g, i: g * (a + i) / (a + i + 0.5))
    # x^a (1-x)^(1/2) / B(a, 1/2); log1p keeps x near 1 exact
    front = F.exp(a * -F.log1p(t2 / v)) * F.sqrt(y) * ratio / F.lit(math.sqrt(math.pi))
    direct = x < (a + 1.0) / (a + 2.5)
    p, q, w = F.when(direct, a).otherwise(half), F.when(direct, half).otherwise(a), F.when(direct, x).otherwise(y)
    steps = F.least(F.lit(MAX_STEPS), (100 + 6 * F.sqrt(a)).cast("bigint").cast("int"))
    tiny = F.lit(1e-300)

    def guard(c):
        return F.when(F.abs(c) < tiny, tiny).otherwise(c)

    def one(state, term):
        d = 1.0 / guard(1.0 + term * state["d"])
        c = guard(1.0 + term / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * d * c).alias("h"))

    def step(state, i):
        m = i.cast("double")
        even = m * (q - m) * w / ((p + 2.0 * m - 1.0) * (p + 2.0 * m))
        odd = -(p + m) * (p + q + m) * w / ((p + 2.0 * m) * (p + 2.0 * m + 1.0))
        inner = F.transform(F.array(one(state, even)), lambda s: one(s, odd))
        return F.get(inner, 0)

    d0 = 1.0 / guard(1.0 - (p + q) * w / (p + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))
    fraction = F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda s: s["h"])
    tail = front * fraction / p
    value = F.when(t2 == 0, F.lit(1.0)).when(direct, tail).otherwise(1.0 - tail)
    return F.when((dof >= 1) & t.isNotNull(), F.greatest(value, F.lit(0.0)))


def pearson_p_values(pairs_df: DataFrame, digits: int | None = 6) -> DataFrame:
    """R2: t = r * sqrt((n-2)/(1-r^2)) and its two-sided p-value (n-2 degrees of freedom).

    Input is the (x, y, n, r) table of ``pearson_pairs`` with unrounded r.
    """
    n, r = F.col("n"), F.col("r")
    one_minus = F.lit(1.0) - r * r
    t = r * F.sqrt((n - F.lit(2)) / F.when(one_minus > 0, one_minus))
    # t and p are computed in their own projection: in a single select, a rounded ``r`` alias would be
    # picked up by the later expressions (lateral column alias resolution)
    full = pairs_df.withColumn("t", t).withColumn("p_value", t_two_sided_p(F.col("t"), n - F.lit(2)))
    if digits is None:
        return full.select("x", "y", "n", "r", "t", "p_value")
    return full.select("x", "y", "n", *[F.round(c, digits).alias(c) for c in ("r", "t", "p_value")])


def distribution(df: DataFrame, value: str, group: str | None = None,
                 quantiles: Sequence[float] = (0.1, 0.5, 0.9), digits: int | None = 6,
                 distinct: bool = False) -> DataFrame:
    """Mean vs exact median / quantiles (linear between neighbours) of a skewed measure (per group when given).

    The values are counted, and running sums of the counts (``with_running_sums``, in range slices) give each
    value's positions: a group's values are in no task together. NULL values do not count.
    """
    by = [group] if group else []
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__c"))
    at = with_running_sums(counts, [F.col(value)], {"__upto": "__c"}, total_suffix="__all", by=by)
    n = F.col("__upto__all")
    aggs = [F.sum("__c").alias("n"), (F.sum(F.col(value) * F.col("__c")) / F.sum("__c")).alias("mean")]
    if distinct:
        aggs = [aggs[0], F.count(F.lit(1)).alias("n_distinct"), F.round(_exact_mean(value), digits or 6).alias("mean")]
    for q in quantiles:
        place = F.lit(float(q)) * (n - 1)
        low = F.min(F.when(F.col("__upto") > F.floor(place), F.col(value))).cast("double")
        high = F.min(F.when(F.col("__upto") > F.ceil(place), F.col(value))).cast("double")
        part = F.max(place - F.floor(place))
        p = low + (high - low) * part
        aggs.append((F.round(p, digits) if digits is not None else p).alias(f"p{int(round(q * 100)):02d}"))
    return (at.groupBy(*by) if by else at).agg(*aggs)


def _exact_mean(value: str) -> Column:
    """The mean from counted values, their sum exact to six decimals: no order of summation changes it."""
    each = F.col(value).try_cast("decimal(30,6)") * F.col("__c").cast("decimal(20,0)")
    return F.sum(each).cast("double") / F.sum("__c")


def approx_distribution(df: DataFrame, value: str, group: str | None = None,
                        quantiles: Sequence[float] = (0.1, 0.5, 0.9), accuracy: int = 10000) -> DataFrame:
    """P7 at scale: ``percentile_approx`` (bounded sketch per group)."""
    aggs = [F.count(value).alias("n"), F.avg(value).alias("mean"),
            F.percentile_approx(value, list(quantiles), accuracy).alias("quantiles")]
    return (df.groupBy(group) if group else df).agg(*aggs)


def _mean(c: str, dtype: str) -> Column:
    """The mean; of floating numbers by their sum to six decimals, which no order of summation changes."""
    if dtype not in ("float", "double"):
        return F.avg(c)
    return F.sum(F.col(c).try_cast("decimal(30,6)")).cast("double") / F.when(F.count(c) > 0, F.count(c))


def profile_table(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """Per column: type, rows, nulls, and min, max, mean of numbers or min_text, max_text of anything else
    (one aggregate, long form)."""
    num = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    cols = list(columns or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        number = types[c] in num or types[c].startswith("decimal")
        none = F.lit(None)
        aggs += [F.count(F.lit(1)).alias(f"rows{i}"), F.count_if(F.col(c).isNull()).alias(f"nulls{i}"),
                 (F.min(c) if number else none).cast("double").alias(f"min{i}"),
                 (F.max(c) if number else none).cast("double").alias(f"max{i}"),
                 (F.round(_mean(c, types[c]), digits) if number else none).cast("double").alias(f"mean{i}"),
                 (none if number else F.min(c)).cast("string").alias(f"mint{i}"),
                 (none if number else F.max(c)).cast("string").alias(f"maxt{i}")]
    one = df.agg(*aggs)
    rows = ", ".join(f"'{c}', '{types[c]}', rows{i}, nulls{i}, min{i}, max{i}, mean{i}, mint{i}, maxt{i}"
                     for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {rows}) as (column, dtype, n_rows, n_null, min, max, mean, min_text, max_text)")


def profile_distribution(df: DataFrame, columns: Sequence[str] | None = None,
                         quantiles: Sequence[float] = (0.01, 0.25, 0.5, 0.75, 0.99), digits: int = 6) -> DataFrame:
    """Per number column the non-NULL rows, distinct values, mean and exact quantiles (linear between neighbours).

    Columns become (column, value) rows that are counted where they are read, so the running counts that
    give the positions hold each distinct value once. NaN counts as the largest value.
    """
    num = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    cols = [c for c in (columns or df.columns) if types[c] in num or types[c].startswith("decimal")]
    if not cols:
        raise ValueError("no number columns")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return distribution(long, "value", "column", quantiles, digits, distinct=True)
