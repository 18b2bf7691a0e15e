"""Totals over a parent-child tree of any depth, by path doubling.

Round k knows of every node its ancestor 2 ** k levels up and the sum over its descendants less than 2 ** k levels
down. The next round adds the sums of the nodes whose ancestor it is (a grouped sum) and takes the ancestor's
ancestor (a join), so a path of n nodes needs about log2(n) rounds and not n. A node that still has an ancestor
after more levels than there are nodes leads into a cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import partitions_for, shared_dir

_UP, _HOPS, _SUM, _N, _TOP = "__up", "__hops", "__sum", "__n", "__top"


def closure_totals(nodes: DataFrame, node: str, parent: str, value: str) -> DataFrame:
    """node, root, depth, n_below, total, in_cycle.

    ``depth`` is the number of ancestors, ``n_below`` that of descendants, ``total`` the sum of ``value`` over the
    node and its descendants (NULL where none of them has one). A parent that is no node makes a root, as NULL does.
    Rows of one node are one: their values add up and the smallest parent counts. Rows without a node are left out. Nodes on a cycle,
    or below one, are ``in_cycle``: root, depth, n_below and total are NULL, and no other node has them below.
    """
    spark = nodes.sparkSession
    shared_dir(spark)
    one = nodes.where(F.col(node).isNotNull()).groupBy(F.col(node).alias(node)).agg(
        F.min(parent).alias(_UP), F.sum(value).alias(_SUM))
    one = one.checkpoint(eager=True)
    n = one.count()
    # every round is written in here: its shuffles have partitions by the number of nodes
    with partitions_for(spark, n):
        now = _rounds(one, node, n)
    loop = F.col(_UP).isNotNull()

    def known_only(c: str, out: str):
        return F.when(~loop, F.col(c)).alias(out)

    return now.select(node, known_only(_TOP, "root"), known_only(_HOPS, "depth"), known_only(_N, "n_below"),
                      known_only(_SUM, "total"), loop.alias("in_cycle"))


def _rounds(one: DataFrame, node: str, n: int) -> DataFrame:
    """All rounds over ``n`` nodes with their parent and value: top, levels up to it, nodes below and sum of each."""
    known = one.select(F.col(node).alias("__p"))
    now = one.join(known, F.col(_UP) == F.col("__p"), "left").select(
        node, F.col("__p").alias(_UP), F.when(F.col("__p").isNotNull(), 1).otherwise(0).cast("bigint").alias(_HOPS), _SUM,
        F.lit(0).cast("bigint").alias(_N), F.coalesce(F.col("__p"), F.col(node)).alias(_TOP))
    now, levels = now.checkpoint(eager=True), 1
    while levels <= n and not now.where(F.col(_UP).isNotNull()).isEmpty():
        # a frame that has been written: adaptive execution may split a node that most others are below
        below = now.where(F.col(_UP).isNotNull()).groupBy(F.col(_UP).alias("__to")).agg(
            F.sum(_SUM).alias("__s"), F.sum(F.col(_N) + 1).alias("__m")).checkpoint(eager=True)
        up = now.select(F.col(node).alias("__at"), F.col(_UP).alias("__up2"), F.col(_HOPS).alias("__hops2"), F.col(_TOP).alias("__top2"))
        added = now.join(below, F.col(node) == F.col("__to"), "left").join(up, F.col(_UP) == F.col("__at"), "left")
        own, more = F.col(_SUM), F.col("__s")
        now = added.select(
            node, F.col("__up2").alias(_UP), (F.col(_HOPS) + F.coalesce("__hops2", F.lit(0))).alias(_HOPS),
            F.coalesce(own + more, own, more).alias(_SUM), (F.col(_N) + F.coalesce("__m", F.lit(0))).alias(_N),
            F.coalesce("__top2", F.col(_TOP)).alias(_TOP)).checkpoint(eager=True)
        levels *= 2
    return now
