"""Interval overlap join by nested time bins.

Time is cut into bins of every power of two. An interval lives on the level whose bins are as long as it or just
longer, where it touches two bins at most. Two intervals meet on the level of the longer one: the longer lives
there, the shorter visits each coarser level on which the other side has intervals, again in two bins at
most. So the join is an equality on (keys, level, bin), and a pair is reported in the one bin where its overlap
begins. The rows grow with intervals x levels in use (64 at most), never with pairs that do not overlap by far: what
lives on a level is longer than half a bin.

A bin that many rows visit (one interval covers everything, or one key has most rows) is cut by a salt: its visitors
are counted first, and the few rows that live there are copied for each salt.

Where only counts of the pairs with windows of one width are asked, ``window_counts`` gives them without the pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.asof import asof_join, micros
from strata.operators.ranking import BROADCAST_SLICES, sliced
from strata.session import shared_dir

#: Visitors of a bin that one salt takes, and the number of cut bins that may be broadcast (more are not cut).
SALT_ROWS, CUT_BINS = 200_000, 50_000


def _placed(df: DataFrame, span: tuple[str, str], closed: bool, row: str) -> DataFrame:
    """One struct column a row, its first and last instant and its level. Rows that cover nothing go."""
    s, e = (micros(F.col(c), df.schema[c].dataType).cast("bigint") for c in span)
    if not closed:
        e = e - 1
    held = df.select(F.struct(*df.columns).alias(row), s.alias("a"), e.alias("z"))
    held = held.where(F.col("a").isNotNull() & (F.col("z").isNull() | (F.col("a") <= F.col("z"))))
    return held


def _level(a: Column, z: Column) -> Column:
    """The smallest level whose bins (2 to the power of it) are at least as long as the interval."""
    less_one = z - a
    return F.when(less_one == 0, F.lit(0)).otherwise(F.length(F.bin(less_one))).cast("int")


def _bins(level: Column) -> Column:
    """The bins of a level that the interval touches: with the level at least its own, two at most."""
    return F.array_distinct(F.array(F.expr("shiftright(a, l)"), F.expr("shiftright(z, l)")))


def interval_join(left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str],
                  by: Sequence[str] = (), closed: bool = False) -> DataFrame:
    """All pairs of a left and a right row with equal ``by`` columns whose intervals overlap, each pair once.

    Spans are (start, end) columns of dates, timestamps (whole microseconds) or whole numbers, of one type on both
    sides; a point is a span of one column twice with ``closed``. They are half-open, or with ``closed`` include
    their end. A NULL end means no end; a NULL start, a NULL key or an end before the start overlaps
    nothing. Repeated rows each have their pairs. The result has the left columns and the right ones but ``by``; apart from ``by``
    no name may stand on both sides.
    """
    if clash := (set(left.columns) & set(right.columns)) - set(by):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    shared_dir(left.sparkSession)
    # written once: levels, counts of visitors and both joins read a side again, whatever work it took
    sides = {"l": _placed(left, left_span, closed, "l_row").checkpoint(), "r": _placed(right, right_span, closed, "r_row").checkpoint()}
    # ends that are open end with the last instant of all; the levels in use are at most 64 numbers a side
    ends = [d.agg(F.max("z").alias("z"), F.max("a").alias("a")).first() for d in sides.values()]
    top = max((v for e in ends for v in (e["z"], e["a"]) if v is not None), default=0)
    levels = {}
    for k, d in sides.items():
        d = d.withColumn("z", F.coalesce("z", F.greatest(F.lit(top), F.col("a"))))
        keys = [F.col(f"{k}_row.{c}") for c in by]
        for c in keys:
            d = d.where(c.isNotNull())
        sides[k] = d.withColumn("own", _level(F.col("a"), F.col("z"))).withColumn("key", F.struct(*keys) if by else F.lit(0))
        levels[k] = sorted(r["own"] for r in sides[k].select("own").distinct().collect())

    def living(k: str) -> DataFrame:
        d = sides[k].withColumn("l", F.col("own"))
        return d.select("key", "l", F.explode(_bins(F.col("l"))).alias("bin"), f"{k}_row",
                        F.col("a").alias(f"{k}_a"), F.col("z").alias(f"{k}_z"))

    def visiting(k: str, to: list[int], own_too: bool) -> DataFrame:
        all_levels = F.array(*[F.lit(x) for x in to]).cast("array<int>")
        up = F.filter(all_levels, lambda x: (x >= F.col("own")) if own_too else (x > F.col("own")))
        d = sides[k].select("*", F.explode(up).alias("l"))
        return d.select("key", "l", F.explode(_bins(F.col("l"))).alias("bin"), f"{k}_row",
                        F.col("a").alias(f"{k}_a"), F.col("z").alias(f"{k}_z"))

    def meet(visitors: DataFrame, residents: DataFrame, v: str, r: str) -> DataFrame:
        place = ["key", "l", "bin"]
        count = visitors.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
        # at most CUT_BINS bins can have more than this many visitors
        total = visitors.count()
        each = max(SALT_ROWS, -(-total // CUT_BINS))
        cut = count.where(F.col("n") > each).select(
            *[F.col(c).alias(f"c_{c}") for c in place], F.ceil(F.col("n") / F.lit(each)).cast("int").alias("salts"))
        on = (F.col("key") == F.col("c_key")) & (F.col("l") == F.col("c_l")) & (F.col("bin") == F.col("c_bin"))
        vs = visitors.join(F.broadcast(cut), on, "left").withColumn(
            "salt", F.pmod(F.xxhash64(F.spark_partition_id(), f"{v}_row"), F.coalesce("salts", F.lit(1))).cast("int"))
        rs = residents.join(F.broadcast(cut), on, "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        gone = ["c_key", "c_l", "c_bin", "salts"]
        both = vs.drop(*gone).join(rs.drop(*gone), [*place, "salt"])
        begin = F.greatest(F.col("l_a"), F.col("r_a"))
        return both.where((begin <= F.least("l_z", "r_z")) & (F.expr("shiftright(greatest(l_a, r_a), l)") == F.col("bin"))) \
            .select("l_row", "r_row")

    pairs = meet(visiting("l", levels["r"], True), living("r"), "l", "r").unionByName(
        meet(visiting("r", levels["l"], False), living("l"), "r", "l"))
    return pairs.select(*[F.col(f"l_row.{c}").alias(c) for c in left.columns],
                        *[F.col(f"r_row.{c}").alias(c) for c in right.columns if c not in by])


def window_counts(df: DataFrame, at: str, entity: str, width: int) -> DataFrame:
    """since, until, n_rows, n_distinct: for all windows that begin from ``since`` on and before ``until``, the rows and the
    distinct entities whose ``at`` is inside; a window is ``width`` long (in the unit of ``micros``) and without its end.

    Stretches do not overlap, and those without rows are left out. A row is in the windows that begin in the ``width``
    up to it, and the entity's first one there if they begin after its row before: so each row adds to the counts at most
    at two instants and takes from them at one, and the counts are running sums over the instants. Rows without
    a time are in no window; a NULL entity is none, as in COUNT(DISTINCT).
    """
    rows = df.select(F.col(entity).alias("e"), micros(F.col(at), df.schema[at].dataType).cast("bigint").alias("t"))
    rows = rows.where(F.col("t").isNotNull()).groupBy("e", "t").agg(F.count(F.lit(1)).alias("n"))
    before = rows.where(F.col("e").isNotNull()).select("e", F.col("t").alias("t0"))
    rows = asof_join(rows, before, ["e"], "t", "t0", strict=True)
    since = F.col("t") - F.lit(width - 1)
    none, known = F.lit(0).cast("bigint"), F.col("e").isNotNull().cast("bigint")

    def change(when: Column, n_rows: Column, n_distinct: Column) -> Column:
        return F.struct(when.alias("since"), n_rows.alias("r"), n_distinct.alias("d"))

    changes = F.array(change(since, F.col("n"), none), change(F.greatest(since, F.col("t0") + 1), none, known),
                      change(F.col("t") + 1, -F.col("n"), -known))
    steps = rows.select(F.explode(changes).alias("c")).groupBy(F.col("c.since").alias("since")).agg(
        F.sum("c.r").alias("r"), F.sum("c.d").alias("d"))
    # running sums and the next instant: inside a slice, then over one row a slice
    cut = sliced(steps, [F.col("since")], None)
    order = Window.partitionBy("__slice").orderBy("since")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("__slice", "since", F.lead("since").over(order).alias("next"), F.sum("r").over(upto).alias("r"),
                       F.sum("d").over(upto).alias("d"))
    slices = Window.partitionBy(F.lit(1)).orderBy("__slice")
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    per = cut.groupBy("__slice").agg(F.sum("r").alias("r0"), F.sum("d").alias("d0"), F.min("since").alias("first"))
    per = per.select(F.col("__slice").alias("s"), F.coalesce(F.sum("r0").over(earlier), none).alias("r0"),
                     F.coalesce(F.sum("d0").over(earlier), none).alias("d0"), F.lead("first").over(slices).alias("first"))
    if cut.rdd.getNumPartitions() <= BROADCAST_SLICES:
        per = F.broadcast(per)
    both = local.join(per, F.col("__slice") == F.col("s"))
    return both.select("since", F.coalesce("next", "first").alias("until"), (F.col("r") + F.col("r0")).alias("n_rows"),
                       (F.col("d") + F.col("d0")).alias("n_distinct")).where("n_rows > 0")
