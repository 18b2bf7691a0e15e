"""Property check: the distributed order statistics equal Spark's single-partition windows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import ranking as RK
from strata.operators.features import top_share_tier


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.none() | st.integers(min_value=-3, max_value=3), min_size=1, max_size=60),
       groups=st.lists(st.none() | st.integers(0, 2), min_size=60, max_size=60),
       parts=st.integers(min_value=1, max_value=40), k=st.integers(min_value=1, max_value=8))
def test_ranking_equals_builtin(spark, values, groups, parts, k):
    df = spark.createDataFrame([(i, v, g) for i, (v, g) in enumerate(zip(values, groups))], "key long, v long, g long")
    order = [F.col("v").desc(), F.col("key")]
    w, wv, wg = Window.orderBy(*order), Window.orderBy(F.col("v").desc()), Window.partitionBy("g")
    upto = Window.unboundedPreceding, 0
    ref = {r.key: tuple(r)[1:] for r in df.select(
        "key", F.rank().over(wv), F.dense_rank().over(wv), F.row_number().over(w), F.ntile(k).over(w),
        F.sum("v").over(w.rowsBetween(*upto)), F.rank().over(wg.orderBy(F.col("v").desc())),
        F.sum("v").over(wg.orderBy("key").rowsBetween(*upto)), F.row_number().over(wg.orderBy("key"))).collect()}
    mine = (RK.with_rank_variants(df, ["v"], order, parts)
            .join(RK.with_ntile(df, order, k, "t", parts).select("key", "t"), "key")
            .join(RK.with_running_sum(df, order, "v", "s", parts).select("key", "s"), "key")
            .join(RK.with_group_rank(df, ["g"], ["v"], order, "gr", parts).select("key", "gr"), "key")
            .join(RK.with_running_sums(df, [F.col("key")], {"gs": "v"}, parts, by=["g"]).select("key", "gs"), "key")
            .join(RK.with_row_number(df, [F.col("key")], "gn", parts, by=["g"]).select("key", "gn"), "key"))
    got = {r.key: (r.rnk, r.dense_rnk, r.row_num, r.t, r.s, r.gr, r.gs, r.gn) for r in mine.collect()}
    assert got == ref


def test_rows_without_a_value_keep_their_place(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 5), (4, 1), (5, None)], "key long, v long")
    got = {r.key: (r.avg_rank, r.top_tier) for r in top_share_tier(df, "v", "key", share=0.7).collect()}
    assert got == {1: (1.5, True), 3: (1.5, True), 4: (3.0, False), 2: (None, False), 5: (None, False)}
