"""RANGE and GROUPS frames over series of any length.

A window by entity gathers the whole series in a task. Here a series is cut into cells of the order's value, four
times as wide as the frame, and the rows that frames of a neighbouring cell reach into are copied there (the halo, a
quarter of the rows). Each cell is then a window of its own. As all rows of one entity and value share a frame, the values are aggregated
by (entity, value) before, so a value that most rows have is one row.

Frames are made of sums, counts, extremes and means, which add up from these rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.asof import micros
from strata.operators.ranking import with_row_number

FUNCTIONS = ("sum", "count", "min", "max", "avg")
_AT, _CELL, _OWN, CELL_FRAMES = "__at", "__cell", "__own", 4


def _parts(values: dict[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """The columns of partial aggregates, each with (function, source column)."""
    out = {}
    for fn, col in values.values():
        if fn not in FUNCTIONS:
            raise ValueError(f"unknown function {fn!r}")
        for f in ("sum", "count") if fn == "avg" else (fn,):
            out[f"__{f}_{col}"] = (f, col)
    return out


def _framed(points: DataFrame, by: Sequence[str], parts: dict, preceding: int, following: int) -> DataFrame:
    """``points`` (one row for each ``by`` and whole number ``__at``) with each part aggregated over its frame."""
    if preceding < 0 or following < 0:
        raise ValueError("frames include the current row")
    width = CELL_FRAMES * (preceding + following) or 1024

    def cell(c):
        return F.floor(c / F.lit(width)).cast("bigint")

    at = F.col(_AT)
    reach = F.array_distinct(F.array(cell(at), cell(at - following), cell(at + preceding)))
    spread = points.withColumn(_CELL, F.explode(reach)).withColumn(_OWN, F.col(_CELL) == cell(at))
    w = Window.partitionBy(*by, _CELL).orderBy(_AT).rangeBetween(-preceding, following)
    over = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    framed = spread.withColumns({f"{p}__f": over[f](p).over(w) for p, (f, _) in parts.items()})
    return framed.where(_OWN).drop(_CELL, _OWN, *parts).withColumnsRenamed({f"{p}__f": p for p in parts})


def _points(df: DataFrame, by: Sequence[str], order: str, parts: dict) -> DataFrame:
    agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    known = df.where(F.col(order).isNotNull())
    return known.groupBy(*by, order).agg(*[agg[f](c).alias(p) for p, (f, c) in parts.items()])


def _join_back(df: DataFrame, framed: DataFrame, by: Sequence[str], order: str, values: dict) -> DataFrame:
    keys = [*by, order]
    f = framed.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(f[f"__k_{k}"])
    out = df.join(f, same, "left")
    for name, (fn, col) in values.items():
        if fn == "avg":
            n = F.col(f"__count_{col}")
            out = out.withColumn(name, F.col(f"__sum_{col}").cast("double") / F.when(n > 0, n))
        elif fn == "count":
            out = out.withColumn(name, F.coalesce(F.col(f"__count_{col}"), F.lit(0)))
        else:
            out = out.withColumn(name, F.col(f"__{fn}_{col}"))
    return out.select(*df.columns, *values)


def range_frames(df: DataFrame, by: Sequence[str], order: str, values: dict[str, tuple[str, str]], preceding: int,
                 following: int = 0) -> DataFrame:
    """``df`` with ``{out: (function, column)}`` over RANGE BETWEEN ``preceding`` PRECEDING AND ``following`` FOLLOWING.

    ``order`` is a date (frames in days), a timestamp (in microseconds) or a whole number, ascending. NULL keys are one
    group. Rows with a NULL order are outside of all frames: their sums are NULL and counts 0. Repeated rows
    each count and come back each. A mean is a double: the sum over the count.
    """
    parts = _parts(values)
    points = _points(df, by, order, parts)
    points = points.withColumn(_AT, micros(F.col(order), df.schema[order].dataType).cast("bigint"))
    return _join_back(df, _framed(points, by, parts, preceding, following).drop(_AT), by, order, values)


def groups_frames(df: DataFrame, by: Sequence[str], order: str, values: dict[str, tuple[str, str]], preceding: int,
                  following: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``{out: (function, column)}`` over GROUPS BETWEEN ``preceding`` PRECEDING AND ``following`` FOLLOWING:
    as many distinct values of ``order`` (any type that sorts) before and after the row's own; else as ``range_frames``.

    The distinct values are numbered in range slices, so that no entity's values are in one task.
    """
    parts = _parts(values)
    points = _points(df, by, order, parts)
    points = with_row_number(points, [F.col(order)], _AT, num_partitions, by=by)
    return _join_back(df, _framed(points, by, parts, preceding, following).drop(_AT), by, order, values)
