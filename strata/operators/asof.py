"""As-of join: each row of a series with the nearest earlier (or later) row of a second, irregular series.

Both sides go into one frame, cut into range slices by (keys, time, side), so a key that holds most rows spans
many slices. Inside a slice the last row of the other side is carried down to each row. A slice's first key may have
begun in earlier slices: it starts with the last row of that key there, one row a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.ranking import BROADCAST_SLICES, sliced

_KEY, _T, _SIDE, _SALT, _SLICE, _L, _R = "__key", "__t", "__side", "__salt", "__slice", "__left", "__right"


def micros(c: Column, kind: T.DataType) -> Column:
    """A date as days, a timestamp as microseconds (of its own clock, if it has no zone), a number as itself."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(c.cast("date")).cast("bigint") * 86_400_000_000
        second = F.extract(F.lit("SECOND"), c) * 1_000_000
        return day + (F.hour(c) * 60 + F.minute(c)).cast("bigint") * 60_000_000 + second.cast("bigint")
    if isinstance(kind, T.NumericType):
        return c
    raise ValueError(f"neither a time nor a number: {kind.simpleString()}")


def last_of_each(df: DataFrame, by: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """One row for each ``by``: the largest by the ``tie`` columns in turn, then by the others (NULL smallest)."""
    rest = [*tie, *[c for c in df.columns if c not in by and c not in tie]]
    if not rest:
        return df.distinct()
    top = df.groupBy(*by).agg(F.max(F.struct(*rest)).alias("__m"))
    return top.select(*[c if c in by else F.col(f"__m.{c}").alias(c) for c in df.columns])


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, right_on: str,
              direction: str = "backward", strict: bool = False, tolerance: Column | None = None,
              tie: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """``left`` with, for each row, the columns of one row of ``right`` that has equal ``by`` columns and the
    largest ``right_on`` up to the row's ``on`` (``direction="forward"``: the smallest from it on).

    Every left row comes back once, repeated rows included; without a match the right columns are NULL. As in SQL,
    a NULL key or NULL time matches nothing. ``strict`` leaves out equal times. ``tolerance`` (an interval, or a
    number where times are numbers) leaves out rows further away. Right rows of one key and time count as one, the
    largest by the ``tie`` columns in turn, then by the other columns in order. Right columns other than ``by``
    must not be named like left ones. ``on`` and ``right_on`` are of one type: a date, a timestamp or a number.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    payload = [c for c in right.columns if c not in by]
    if clash := set(payload) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    forward = direction == "forward"

    def time(df: DataFrame, name: str) -> Column:
        c = F.col(name)
        return -micros(c, df.schema[name].dataType).cast("decimal(38,9)" if "decimal" in dict(df.dtypes)[name] else
                                                         "double" if dict(df.dtypes)[name] in ("float", "double") else
                                                         "bigint") if forward else c

    known = right.where(F.col(right_on).isNotNull())
    for k in by:
        known = known.where(F.col(k).isNotNull())
    one = last_of_each(known, [*by, right_on], [t for t in tie if t not in by and t != right_on])
    own, other = F.struct(*left.columns), F.struct(*payload)
    l_type, r_type = left.select(own.alias("s")).schema[0].dataType, one.select(other.alias("s")).schema[0].dataType
    keys = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    # at equal times the right row goes first, unless equal times are left out
    r_side, l_side = (1, 0) if strict else (0, 1)
    r = one.select(keys.alias(_KEY), time(one, right_on).alias(_T), F.lit(r_side).alias(_SIDE),
                   F.lit(0).cast("bigint").alias(_SALT), other.alias(_R), F.lit(None).cast(l_type).alias(_L))
    # rows equal in key and time are dealt out by a salt that a task run again gives them again
    lf = left.select(keys.alias(_KEY), time(left, on).alias(_T), F.lit(l_side).alias(_SIDE),
                     F.xxhash64(F.spark_partition_id(), own).alias(_SALT), F.lit(None).cast(r_type).alias(_R),
                     own.alias(_L))
    order = [F.col(c) for c in (_T, _SIDE, _SALT)]
    both = sliced(r.union(lf), [F.col(_KEY), *order], num_partitions)
    upto = Window.partitionBy(_SLICE, _KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("__m", F.last(_R, ignorenulls=True).over(upto)).where(F.col(_L).isNotNull())

    # each slice's last key with that key's last right row, if it has one in the slice ...
    is_right = F.col(_R).isNotNull()
    ends = both.groupBy(_SLICE).agg(
        F.max(_KEY).alias("__k"), F.max(F.when(is_right, F.col(_KEY))).alias("__rk"),
        F.max_by(_R, F.when(is_right, F.struct(_KEY, _T))).alias("__r"))
    ends = ends.withColumn("__r", F.when(F.col("__rk") == F.col("__k"), F.col("__r")))
    # ... or in the slices before that the key fills, handed to the next slice
    so_far = Window.partitionBy("__k").orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, 0)
    carry = ends.select(F.lead(_SLICE).over(Window.partitionBy(F.lit(1)).orderBy(_SLICE)).alias("__to"), "__k",
                        F.last("__r", ignorenulls=True).over(so_far).alias("__c"))
    carry = carry.where(F.col("__to").isNotNull() & F.col("__c").isNotNull())
    if both.rdd.getNumPartitions() <= BROADCAST_SLICES:
        carry = F.broadcast(carry)  # at most one row a slice
    joined = local.join(carry, (F.col(_SLICE) == F.col("__to")) & (F.col(_KEY) == F.col("__k")), "left")
    hit = F.coalesce(F.col("__m"), F.col("__c"))
    ok = F.col(f"{_L}.{on}").isNotNull()
    if tolerance is not None:
        at, found = F.col(f"{_L}.{on}"), F.col(f"__hit.{right_on}")
        ok = ok & ((found <= at + tolerance) if forward else (found >= at - tolerance))
    out = joined.select(_L, hit.alias("__hit")).withColumn("__hit", F.when(ok, F.col("__hit")))
    return out.select(*[F.col(f"{_L}.{c}").alias(c) for c in left.columns],
                      *[F.col(f"__hit.{c}").alias(c) for c in payload])
