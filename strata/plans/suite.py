"""Run a named list of queries; one failure is recorded and the rest go on.

The loop is over query names (a handful), not over data: each query runs as
its own Spark job, its result is written in full to the output folder (when
given) and counted, and a status table (name, ok, n_rows, error) is returned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STATUS_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False), T.StructField("ok", T.BooleanType(), False),
    T.StructField("n_rows", T.LongType()), T.StructField("error", T.StringType()),
])


def run_suite(spark: SparkSession, named: Mapping[str, Callable[[], DataFrame]], out_dir: str | None = None,
              sample: int = 15) -> tuple[DataFrame, dict[str, list]]:
    status, samples = [], {}
    for name, make in named.items():
        try:
            df = make()
            if out_dir:
                df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
                df = spark.read.parquet(f"{out_dir}/{name}")
            else:
                df = df.persist()  # counted and sampled from one execution
            n = df.count()
            samples[name] = df.limit(sample).collect()
            df.unpersist()
            status.append((name, True, n, None))
        except Exception as e:  # noqa: BLE001 - a failed query is recorded, the suite goes on
            status.append((name, False, None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(status, STATUS_SCHEMA), samples
