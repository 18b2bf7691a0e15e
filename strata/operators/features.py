"""Per-entity time-series features.

All windows are ``partitionBy(entity).orderBy(date)``. On a panel at its
(entity, date) grain an entity holds at most one row per calendar day, so a
window partition is bounded by the calendar length, whatever the data volume.
Whole-entity totals and maxima (G11, G12) are computed by an aggregate joined
back instead of an unbounded window, so a large entity is pre-aggregated
map-side rather than buffered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import clip, col, lookup, safe_div
from strata.operators.ranking import with_running_sums, with_tie_range


def series_window(entity: str | Sequence[str], date: str) -> Window:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(date)


def _rows(entity, date, lo, hi=0):
    return series_window(entity, date).rowsBetween(lo, hi)


# ---------------------------------------------------------------- E12-E16
def fatality_rate(df: DataFrame, deaths: str = "total_deaths", cases: str = "total_cases",
                  out: str = "case_fatality_rate", digits: int = 3) -> DataFrame:
    """Deaths / cases * 100, half-even ``digits``; 0 where cases <= 0."""
    rate = F.bround(F.col(deaths) / F.when(F.col(cases) != 0, F.col(cases)) * F.lit(100.0), digits)
    return df.withColumn(out, F.when(F.col(cases) > 0, rate).otherwise(F.lit(0.0)))


def per_million(df: DataFrame, value: str, population: str = "population", out: str | None = None,
                digits: int = 1) -> DataFrame:
    """Value / population * 1e6, half-even ``digits``."""
    return df.withColumn(out or f"{value}_per_million",
                         F.bround(safe_div(value, population) * F.lit(1_000_000.0), digits))


def coverage_pct(df: DataFrame, stock: str, population: str = "population", out: str | None = None,
                 digits: int = 2, cap: bool = True) -> DataFrame:
    """Stock / population * 100, clipped to 0..100 when ``cap``, half-even ``digits``."""
    x = safe_div(stock, population) * F.lit(100.0)
    if cap:
        x = clip(x, 0.0, 100.0)
    return df.withColumn(out or f"{stock}_pct", F.bround(x, digits))


def rolling_mean(df: DataFrame, value: str, out: str, k: int = 7, min_periods: int = 1,
                 entity: str = "country_id", date: str = "report_date", digits: int | None = None) -> DataFrame:
    """Mean of the last ``k`` rows per entity.

    ``min_periods=1`` is the partial-window form (pandas ``rolling(k, min_periods=1)``);
    ``min_periods=k`` gives NULL until the window is full (plain ``rolling(k)``).
    """
    w = _rows(entity, date, -(k - 1), 0)
    m = F.avg(value).over(w)
    if min_periods > 1:
        m = F.when(F.count(value).over(w) >= min_periods, m)
    if digits is not None:
        m = F.bround(m, digits)
    return df.withColumn(out, m)


def growth_wow(df: DataFrame, value: str, out: str = "case_growth_wow_pct", periods: int = 7,
               entity: str = "country_id", date: str = "report_date", digits: int = 2) -> DataFrame:
    """(x[t] / x[t-periods] - 1) * 100 per entity, half-even; 0 base and head rows -> NULL."""
    prev = F.lag(value, periods).over(series_window(entity, date))
    g = (F.col(value) / F.when(prev != 0, prev) - F.lit(1.0)) * F.lit(100.0)
    return df.withColumn(out, F.bround(g, digits))


# ---------------------------------------------------------------- G1-G15
def cumulative_total(df: DataFrame, columns: dict[str, str], entity: str = "country_id",
                     date: str = "report_date", long_series: bool = False) -> DataFrame:
    """G1: running sum per entity, ``{out: flow}``.

    ``long_series=True`` is for input not at the (entity, day) grain, where one
    entity can hold a large share of all rows: the series is cut into range
    slices, each slice sums locally, and the carry of earlier slices of the
    same entity is added (``ranking.with_running_sums(by=...)``). ``(entity,
    date)`` must then be unique.
    """
    if long_series:
        return with_running_sums(df, [F.col(date)], columns, by=[entity])
    w = _rows(entity, date, Window.unboundedPreceding, 0)
    return df.withColumns({out: F.sum(flow).over(w) for out, flow in columns.items()})


def lag_zero(df: DataFrame, value: str, k: int, out: str, entity: str = "country_id",
             date: str = "report_date") -> DataFrame:
    """Shift by ``k`` rows with leading zeros."""
    return df.withColumn(out, F.lag(value, k, 0).over(series_window(entity, date)))


def elementwise_min(a: str | Column, b: str | Column) -> Column:
    """Min of two columns; NULL if either is NULL (numpy semantics, not ``least``)."""
    x, y = col(a), col(b)
    return F.when(x.isNull() | y.isNull(), F.lit(None)).when(x <= y, x).otherwise(y)


def elementwise_max(a: str | Column, b: str | Column) -> Column:
    x, y = col(a), col(b)
    return F.when(x.isNull() | y.isNull(), F.lit(None)).when(x >= y, x).otherwise(y)


def active_balance(df: DataFrame, total: str = "total_cases",
                   minus: Sequence[str] = ("total_deaths", "total_recovered"),
                   out: str = "active_cases") -> DataFrame:
    """clip(total - sum(minus), 0)."""
    x = F.col(total)
    for m in minus:
        x = x - F.col(m)
    return df.withColumn(out, clip(x, lo=0))


def safe_ratio(num: str | Column, den: str | Column, digits: int = 4) -> Column:
    """Num / max(den, 1), half-even; non-finite or NULL -> 0."""
    d = col(den)
    d1 = F.when(d < 1, F.lit(1)).otherwise(d)
    return F.coalesce(F.bround(col(num) / d1, digits), F.lit(0.0))


def pct_change_1(df: DataFrame, value: str, out: str, entity: str = "country_id",
                 date: str = "report_date") -> DataFrame:
    """Day-on-day relative change; first row and zero base -> 0."""
    prev = F.lag(value, 1).over(series_window(entity, date))
    return df.withColumn(out, F.coalesce(F.col(value) / F.when(prev != 0, prev) - F.lit(1.0), F.lit(0.0)))


def momentum_index(df: DataFrame, value: str, out: str = "reproduction_rate", k: int = 7,
                   scale: float = 3.0, lo: float = 0.5, hi: float = 2.5, digits: int = 2,
                   entity: str = "country_id", date: str = "report_date") -> DataFrame:
    """clip(1 + scale * mean of the last k day-on-day changes, lo, hi), half-even.

    The change is materialised in one projection and averaged in the next,
    so both windows share one sort of the entity's rows.
    """
    tmp = f"__chg_{out}"
    df = pct_change_1(df, value, tmp, entity, date)
    df = df.withColumn(out, F.lit(1.0) + F.lit(scale) * F.avg(tmp).over(_rows(entity, date, -(k - 1), 0)))
    df = df.withColumn(out, F.bround(clip(out, lo, hi), digits))
    return df.drop(tmp)


# FIXED VALUES: weekday reporting factors of the reference, Monday first.
WEEKDAY_FACTORS = (1.0, 1.0, 1.0, 1.0, 1.0, 0.72, 0.55)


def weekday_factor(df: DataFrame, date: str, value: str | None = None, out: str = "weekday_factor",
                   factors: Sequence[float] = WEEKDAY_FACTORS) -> DataFrame:
    """Factor of the row's weekday (Monday = 0); multiplied into ``value`` when given."""
    f = lookup(F.weekday(F.col(date)), factors)
    return df.withColumn(out, f * F.col(value) if value else f)


def weekday_seasonality(df: DataFrame, date: str, value: str, out: str = "weekday_index") -> DataFrame:
    """G9 inverse: mean by weekday / overall mean (one row per weekday)."""
    by_day = df.groupBy(F.weekday(F.col(date)).alias("weekday")).agg(
        F.sum(value).alias("__s"), F.count(value).alias("__n"))
    overall = df.select((F.sum(value) / F.count(value)).alias("m"))
    return by_day.select("weekday", (F.col("__s") / F.col("__n") / overall.scalar()).alias(out))


def top_share_tier(df: DataFrame, value: str, key: str, share: float = 0.2, out: str = "top_tier",
                   rank_out: str = "avg_rank") -> DataFrame:
    """Flag rows whose descending average rank is within the top ``share``.

    Average rank = mean of the tie's first and last position (pandas
    ``rank(ascending=False)``): a row without a value has no rank, counts in no n and is not
    flagged, but stays. The flag holds for rank <= max(1, floor(share * n)).
    """
    res = with_tie_range(df, [value], [F.col(value).desc(), F.col(key)], "__first", "__last", "__n")
    res = res.withColumn(rank_out, F.when(F.col(value).isNotNull(), (F.col("__first") + F.col("__last")) / F.lit(2.0)))
    known = F.lit(df.select(F.count(value)).scalar())
    bound = F.greatest(F.lit(1), F.floor(F.lit(share) * known))
    return res.withColumn(out, F.coalesce(F.col(rank_out) <= bound, F.lit(False))).drop("__n", "__first", "__last")


def _entity_agg(df: DataFrame, entity: str, value: str, fn, name: str) -> DataFrame:
    """``df`` with the entity's aggregate; rows without an entity are one group and stay."""
    agg = df.groupBy(F.col(entity).alias("__entity")).agg(fn(value).alias(name))
    return df.join(agg, F.col(entity).eqNullSafe(F.col("__entity")), "left").drop("__entity")


def share_of_entity_max(df: DataFrame, value: str, out: str, entity: str = "country_id") -> DataFrame:
    """Value / the entity's max; 0 when the max is 0."""
    j = _entity_agg(df, entity, value, F.max, "__emax")
    return j.withColumn(out, F.coalesce(safe_div(value, "__emax"), F.lit(0.0))).drop("__emax")


def share_of_entity_total(df: DataFrame, value: str, out: str, entity: str = "country_id",
                          rescale: float = 1.0) -> DataFrame:
    """Value / the entity's total (times ``rescale``)."""
    j = _entity_agg(df, entity, value, F.sum, "__etot")
    return j.withColumn(out, safe_div(value, "__etot") * F.lit(float(rescale))).drop("__etot")


def per_capita_share(df: DataFrame, stock: str, population: str = "population", out: str | None = None) -> DataFrame:
    """Stock / population."""
    return df.withColumn(out or f"{stock}_share", safe_div(stock, population))


def share_to_count(df: DataFrame, share: str, population: str = "population", out: str | None = None) -> DataFrame:
    """G13 reverse: round-half-even(share * population) as a count."""
    return df.withColumn(out or f"{share}_count", F.bround(F.col(share) * F.col(population)).cast("bigint"))


def complement_rate_proxy(df: DataFrame, level: str, coverage: str, a: float, b: float,
                          lo: float, hi: float, out: str, scale: float = 1.0) -> DataFrame:
    """Level * clip(a - b * coverage, lo, hi) * scale, half-even to an integer."""
    rate = clip(F.lit(a) - F.lit(b) * F.col(coverage), lo, hi) * F.lit(scale)
    return df.withColumn(out, F.bround(F.col(level) * rate).cast("bigint"))


def calendar_rolling_mean(df: DataFrame, date: str, values: dict[str, str], days: int = 7,
                          min_periods: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Mean over the ``days`` calendar days ending at each row's date, ``{out: value}``.

    Each row is exploded to the ``days`` dates whose frame it belongs to and the
    frames are summed by a grouped aggregate (partial aggregation, hash-shuffled
    on the target date): no ordered window, so a series with no partition key
    (a global daily total) is not gathered into one task. On a dense daily series
    this equals the ``days``-row frame; ``min_periods`` (default: ``days``) gives
    NULL until enough observations exist, like pandas ``rolling(days)``.
    """
    need = days if min_periods is None else min_periods
    t = "__target"
    spread = df.select(*keys, F.explode(F.sequence(F.col(date), F.date_add(F.col(date), days - 1))).alias(t),
                       *[F.col(v) for v in dict.fromkeys(values.values())])
    aggs = []
    for i, v in enumerate(dict.fromkeys(values.values())):
        aggs += [F.sum(v).alias(f"__s{i}"), F.count(v).alias(f"__c{i}")]
    frames = spread.groupBy(*keys, t).agg(*aggs)
    j = df.join(frames.withColumnRenamed(t, date), [*keys, date], "left")
    idx = {v: i for i, v in enumerate(dict.fromkeys(values.values()))}
    drop = []
    for out, v in values.items():
        i = idx[v]
        mean = F.col(f"__s{i}") / F.col(f"__c{i}")
        j = j.withColumn(out, F.when(F.col(f"__c{i}") >= need, mean))
    for i in idx.values():
        drop += [f"__s{i}", f"__c{i}"]
    return j.drop(*drop)


def date_spine(entities: DataFrame, start: Column, end: Column, date: str = "report_date") -> DataFrame:
    """Every day from start to end for every entity.

    Each entity row explodes its own day sequence (a Generate, no join), so the
    work stays with the entity's partition and scales with entities x days.
    """
    return entities.withColumn(date, F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))))


def date_spine_from(entities: DataFrame, dates: DataFrame, date_col: str, out: str = "report_date") -> DataFrame:
    """G15 with the range min..max of a data column: one aggregate, taken as a scalar subquery."""
    span = dates.select(F.struct(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))).scalar()
    return date_spine(entities, span["lo"], span["hi"], out)
