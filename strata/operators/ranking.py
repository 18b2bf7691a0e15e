"""Global order statistics without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task
(``Exchange SinglePartition``). The helpers here rank, number, tile and
running-sum a frame of any size in two phases instead:

1. ``repartitionByRange`` on the full (total) sort order, so partition i holds
   a contiguous slice of the order; a window per slice gives local positions.
2. Per-slice counts, sums and tie boundaries (one row per slice and group)
   become offsets through a window over the slices, joined back by slice id.

Ranks come from the boundaries of ties inside the slices and the boundary
carried from earlier slices, so nothing is joined on the ranked value: NULL
values rank like any other (they tie with each other), and a value that most
rows share is no hot key.

The sliced frame is materialised once with ``checkpoint()`` (a reliable
checkpoint in the cluster's ``spark.checkpoint.dir``): the per-slice summary and
the local positions must see the same slice assignment, and two independent
range exchanges would each sample their own bounds. Spark's context cleaner
removes the files once the result is no longer referenced
(``spark.cleaner.referenceTracking.cleanCheckpoints``, see ``session``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import shared_dir

_PID = "__slice"


def sliced(df: DataFrame, order: Sequence[Column], num_partitions: int | None) -> DataFrame:
    """Range slices in ``order``, numbered by ``spark_partition_id``.

    Without an explicit count the exchange uses the session's shuffle partitions
    and AQE may coalesce neighbouring slices (coalesced range partitions stay
    contiguous, so slice ids stay in order): small inputs get few slices, large
    ones many. The checkpoint then fixes the assignment for every reader.
    """
    shared_dir(df.sparkSession)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return ranged.withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)


#: The slice table may be broadcast up to this many slices (one row of a few numbers each).
BROADCAST_SLICES = 10_000


def _attach(local: DataFrame, slices: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join the slice table back; group keys compare null-safe. Without groups it has one row for each
    partition of ``local``, a count that is known here: it is broadcast only if that is small."""
    keys = [_PID, *by]
    s = slices.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    if not by and local.rdd.getNumPartitions() <= BROADCAST_SLICES:
        s = F.broadcast(s)
    cond = F.lit(True)
    for k in keys:
        cond = cond & local[k].eqNullSafe(s[f"__k_{k}"])
    return local.join(s, cond).drop(*[f"__k_{k}" for k in keys])


def _positions(df: DataFrame, order: Sequence[Column], value_cols: Sequence[str], num_partitions: int | None,
               by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``__rn`` (row number), ``__rank``, ``__dense`` and ``__n`` (rows), within each ``by`` group.

    Rows are equal in rank if they are equal (null-safe) on ``value_cols``.
    """
    cut = sliced(df, [F.col(b) for b in by] + list(order), num_partitions)
    w = Window.partitionBy(_PID, *by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    vals = F.struct(*[F.col(v) for v in value_cols]) if value_cols else F.struct(F.lit(0))
    local = cut.withColumn("__lrn", F.row_number().over(w)).withColumn("__vals", vals)
    # a boundary: the row differs from the one before it in its slice (the first row is decided by the slices)
    local = local.withColumn("__new", (F.col("__lrn") > 1) & ~F.col("__vals").eqNullSafe(F.lag("__vals").over(w)))
    local = local.withColumns({"__last": F.max(F.when(F.col("__new"), F.col("__lrn"))).over(upto),
                               "__seen": F.sum(F.col("__new").cast("int")).over(upto)})
    per = local.groupBy(_PID, *by).agg(
        F.count(F.lit(1)).alias("__tot_cnt"), F.max("__last").alias("__b"), F.max("__seen").alias("__nb"),
        F.min_by("__vals", "__lrn").alias("__first"), F.max_by("__vals", "__lrn").alias("__end"))
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    ordered = part.orderBy(_PID)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    head = F.lag("__end").over(ordered)
    per = per.withColumns({
        "__off": F.coalesce(F.sum("__tot_cnt").over(before), F.lit(0)), "__n": F.sum("__tot_cnt").over(part),
        "__head": head.isNull() | ~F.col("__first").eqNullSafe(head)})
    per = per.withColumns({
        "__mark": F.coalesce(F.col("__off") + F.col("__b"), F.when(F.col("__head"), F.col("__off") + 1)),
        "__ties": F.col("__nb") + F.col("__head").cast("int")})
    per = per.withColumns({"__carry": F.last("__mark", ignorenulls=True).over(before),
                           "__dcarry": F.coalesce(F.sum("__ties").over(before), F.lit(0))})
    res = _attach(local, per.select(_PID, *by, "__off", "__n", "__head", "__carry", "__dcarry"), by)
    first = F.when(F.col("__head"), F.col("__off") + 1).otherwise(F.col("__carry"))
    res = res.withColumns({
        "__rn": (F.col("__off") + F.col("__lrn")).cast("bigint"),
        "__rank": F.coalesce(F.col("__off") + F.col("__last"), first).cast("bigint"),
        "__dense": (F.col("__dcarry") + F.col("__head").cast("int") + F.col("__seen")).cast("bigint"),
        "__n": F.col("__n").cast("bigint")})
    return res.drop(_PID, "__lrn", "__vals", "__new", "__last", "__seen", "__off", "__head", "__carry", "__dcarry")


def with_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                    num_partitions: int | None = None, total_out: str | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """1-based position in ``order`` (within each ``by`` group); ``order`` must be a
    total order within the group (end it with a unique key)."""
    res = _positions(df, order, (), num_partitions, by)
    extra = [F.col("__n").alias(total_out)] if total_out else []
    return res.select(*df.columns, F.col("__rn").alias(out), *extra)


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str],
                      num_partitions: int | None = None, total_suffix: str | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """Running sums ``{out: value}`` along a total order (ROWS UNBOUNDED PRECEDING..CURRENT ROW),
    restarting for each ``by`` group; NULL only where no non-NULL value has been seen, as SQL has it.

    With ``by`` this is the per-entity running total for series too long for one
    task: each range slice sums its part of the series, and the carry from the
    earlier slices of the same entity is added. With ``total_suffix`` each
    ``out`` also gets ``out + total_suffix``, the (group) grand total.
    """
    cut = sliced(df, [F.col(b) for b in by] + list(order), num_partitions)
    w = Window.partitionBy(_PID, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    values = list(sums.values())
    local = cut.withColumns({f"__l{i}": F.sum(v).over(w) for i, v in enumerate(values)})
    per = local.groupBy(_PID, *by).agg(*[F.sum(v).alias(f"__tot_{i}") for i, v in enumerate(values)])
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    before = part.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({f"__off{i}": F.sum(f"__tot_{i}").over(before) for i in range(len(values))}
                          | {f"__all{i}": F.sum(f"__tot_{i}").over(part) for i in range(len(values))})
    res = _attach(local, per.drop(*[f"__tot_{i}" for i in range(len(values))]), by)
    drop = [_PID]
    for i, out in enumerate(sums):
        off, own = F.col(f"__off{i}"), F.col(f"__l{i}")
        res = res.withColumn(out, F.coalesce(off + own, own, off))
        if total_suffix:
            res = res.withColumn(out + total_suffix, F.col(f"__all{i}"))
        drop += [f"__l{i}", f"__off{i}", f"__all{i}"]
    return res.drop(*drop)


def with_running_sum(df: DataFrame, order: Sequence[Column], value: str, out: str,
                     num_partitions: int | None = None, total_out: str | None = None) -> DataFrame:
    """Running sum of one column; ``total_out`` names an optional grand-total column."""
    res = with_running_sums(df, order, {out: value}, num_partitions, "__total" if total_out else None)
    return res.withColumnRenamed(out + "__total", total_out) if total_out else res


def with_ntile(df: DataFrame, order: Sequence[Column], k: int, out: str = "ntile",
               num_partitions: int | None = None) -> DataFrame:
    """NTILE(k) over a total order, same tile sizes as SQL (first n mod k tiles one larger)."""
    rn = with_row_number(df, order, "__rn", num_partitions, total_out="__n")
    r, n = F.col("__rn"), F.col("__n")
    q = F.floor(n / F.lit(k)).cast("bigint")
    m = (n % F.lit(k)).cast("bigint")
    big = m * (q + 1)
    tile = (F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1)
            .otherwise(m + F.floor((r - 1 - big) / F.when(q != 0, q)) + 1))
    return rn.withColumn(out, tile.cast("bigint")).drop("__rn", "__n")


def with_rank(df: DataFrame, value_cols: Sequence[str], order: Sequence[Column], out: str = "rank",
              dense: bool = False, num_partitions: int | None = None) -> DataFrame:
    """RANK (or DENSE_RANK) over ``order``; rows equal (null-safe) on ``value_cols`` share a rank.

    ``order`` must start with the ``value_cols`` terms and end with a unique key.
    """
    res = _positions(df, order, value_cols, num_partitions)
    return res.withColumnRenamed("__dense" if dense else "__rank", out).drop("__rn", "__n", "__rank", "__dense")


def with_rank_variants(df: DataFrame, value_cols: Sequence[str], order: Sequence[Column],
                       num_partitions: int | None = None) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER from one numbering."""
    res = _positions(df, order, value_cols, num_partitions)
    return res.withColumnsRenamed({"__rank": "rnk", "__dense": "dense_rnk", "__rn": "row_num"}).drop("__n")


def with_group_rank(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                    order: Sequence[Column], out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """RANK() OVER (PARTITION BY group ORDER BY ...), without gathering a group in one task."""
    res = _positions(df, order, value_cols, num_partitions, by=group_cols)
    return res.withColumnRenamed("__rank", out).drop("__rn", "__dense", "__n")


def with_tie_range(df: DataFrame, value_cols: Sequence[str], order: Sequence[Column], first: str, last: str,
                   total: str, num_partitions: int | None = None) -> DataFrame:
    """First and last position of each row's tie and the number of rows: two numberings, the second in
    reverse, so that a tie's end is found as its start is."""
    up = _positions(df, order, value_cols, num_partitions).withColumnRenamed("__rank", first)
    up = up.drop("__dense", "__n").withColumnRenamed("__rn", "__up")
    down = _positions(up, [F.col("__up").desc()], value_cols, num_partitions)
    return (down.withColumn(last, F.col("__n") + 1 - F.col("__rank")).withColumnRenamed("__n", total)
            .drop("__up", "__rn", "__rank", "__dense"))
