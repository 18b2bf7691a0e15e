"""Typed access to the driver's parquet tables.

Every reader selects only the columns it is given, so the parquet scan's
``ReadSchema`` is pruned at the source. Driver timestamps arrive as
``timestamp_ntz``; day-grain columns are cast to DATE here once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# columns that hold a calendar day in a timestamp type
DAY_COLUMNS = {"o_orderdate", "l_shipdate"}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is not None:
        df = df.select(*columns)
    for c in df.columns:
        if c in DAY_COLUMNS:
            df = df.withColumn(c, F.col(c).cast("date"))
    return df


def register_tables(spark: SparkSession, sf_dir: str, names: Sequence[str] = TABLES) -> None:
    """Temp views named like the tables, for ``spark.sql`` users."""
    for n in names:
        spark.read.parquet(table_path(sf_dir, n)).createOrReplaceTempView(n)
