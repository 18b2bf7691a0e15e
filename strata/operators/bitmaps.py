"""Exact distinct counts over GROUPING SETS from bitmaps that merge.

A distinct count cannot be added up from groups, and COUNT(DISTINCT) over several grouping sets copies every raw row
once a set. Here ids become 64-bit words (word = id / 64, one bit an id): the raw rows are aggregated once, to one
word for each finest group, and the coarser sets combine words with OR. Dense ids shrink 64 to one; sparse ids never
take more than one row an id and group. Words are long values, so all aggregates are hash aggregates with map-side
combine, and a group that has most rows is spread over its words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD, _BITS, _ROWS, _SET = "__word", "__bits", "__rows", "__set"


def words(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """keys, word, bits, rows: the ids of each finest group. NULL ids are rows without a bit.

    These can be stored (say, a day's partition at a time) and counted later: OR of the parts is the whole.
    """
    i = F.col(id_col).cast("bigint")
    bit = F.expr(f"shiftleft(1L, cast(cast(`{id_col}` as bigint) & 63 as int))")
    return df.groupBy(*keys, F.shiftright(i, 6).alias(_WORD)).agg(
        F.coalesce(F.bit_or(F.when(i.isNotNull(), bit)), F.lit(0).cast("bigint")).alias(_BITS), F.count(F.lit(1)).alias(_ROWS))


def count_over_sets(held: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """keys, grouping_id, n_rows, n_distinct for each of the ``sets`` of keys, from ``words``.

    grouping_id has a bit for each key, the first key's highest, set where the key is summed up (its column is NULL
    there). An empty set is the grand total; over an empty table it has no row.
    """
    keys = list(keys)
    if any(set(s) - set(keys) for s in sets):
        raise ValueError("sets of other keys")
    number = F.array(*[F.lit(sum(1 << (len(keys) - 1 - k) for k, c in enumerate(keys) if c not in s)) for s in sets])
    # the words, not the raw rows, are copied for each set
    spread = held.select("*", F.explode(number).alias(_SET))

    def kept(k: int, c: str) -> Column:
        return F.when(F.col(_SET).bitwiseAND(F.lit(1 << (len(keys) - 1 - k))) == 0, F.col(c)).alias(c)

    cut = spread.select(*[kept(k, c) for k, c in enumerate(keys)], _SET, _WORD, _BITS, _ROWS)
    merged = cut.groupBy(*keys, _SET, _WORD).agg(F.bit_or(_BITS).alias(_BITS), F.sum(_ROWS).alias(_ROWS))
    return merged.groupBy(*keys, _SET).agg(F.sum(_ROWS).alias("n_rows"), F.sum(F.bit_count(_BITS)).alias("n_distinct")).select(
        *keys, F.col(_SET).alias("grouping_id"), "n_rows", "n_distinct")


def rollup_sets(keys: Sequence[str]) -> list[list[str]]:
    """All prefixes of the keys, the empty one included."""
    return [list(keys[:k]) for k in range(len(keys), -1, -1)]


def cube_sets(keys: Sequence[str]) -> list[list[str]]:
    """All subsets of the keys."""
    return [[c for k, c in enumerate(keys) if not m >> k & 1] for m in range(1 << len(keys))]


def distinct_over_sets(df: DataFrame, keys: Sequence[str], id_col: str, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Exact distinct ``id_col`` values (whole numbers) and rows for each of the ``sets``: see ``count_over_sets``."""
    return count_over_sets(words(df, keys, id_col), keys, sets)
