"""P9 as a stream: daily delta files merged into a partitioned table, latest load wins.

``readStream`` picks up new delta files; ``foreachBatch`` merges each
micro-batch into the table:

* only the partitions the batch touches are read and rewritten (dynamic partition
  overwrite): those of its rows, and, if a key does not fix its partition, those in
  which its keys stand now, so a key that moves leaves no row behind;
* per key the row with the highest load id wins (``row_number() == 1``, with a
  partial WindowGroupLimit before the shuffle); a column that the delta lacks keeps
  the table's value, a column that is new is NULL in older rows;
* the merged rows are checkpointed (reliable checkpoint in the shared folder)
  before the overwrite, so the write never reads the files it replaces; a partition
  that lost all its rows is removed after it.

Re-running a batch (restart after a failure) applies the same merge again and
gives the same table: the step is idempotent, and the stream's checkpoint
location records which files were already consumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.plans.kpis import p9_incremental_upsert
from strata.session import shared_dir


def _folder(spark: SparkSession, path: str, encoded: bool = False):
    """(Hadoop file system, path) of a folder; paths that Spark gives for its files are encoded URIs."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path) if encoded else path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_current(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The table with all columns that any of its files has; None before its first batch."""
    fs, p = _folder(spark, table_path)
    return spark.read.option("mergeSchema", "true").parquet(table_path) if fs.exists(p) else None


def _matching(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``cols`` stand in ``other``; NULLs match."""
    o = other.select(*[F.col(c).alias(f"__o_{c}") for c in cols]).distinct()
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    return df.join(o, cond, "left_semi")


def upsert_batch(spark: SparkSession, delta: DataFrame, table_path: str, keys: Sequence[str],
                 load_col: str, partition_col: str) -> None:
    """Merge one batch of rows into the table at ``table_path`` (partitioned by ``partition_col``)."""
    shared_dir(spark)
    current = read_current(spark, table_path)
    if current is None:
        merged = p9_incremental_upsert(delta.limit(0), delta, keys, load_col).checkpoint(eager=True)
        merged.write.partitionBy(partition_col).parquet(table_path)
        return
    touched = delta.select(partition_col)
    if partition_col not in keys:  # a key may stand in another partition than its new row's
        touched = touched.unionByName(_matching(current.select(*keys, partition_col), delta, keys).select(partition_col))
    touched = touched.distinct().checkpoint(eager=True)
    old = _matching(current, touched, [partition_col])
    merged = p9_incremental_upsert(old, delta, keys, load_col).checkpoint(eager=True)
    held = merged.select(F.col(partition_col).alias("__p")).distinct()
    emptied = touched.join(held, F.col(partition_col).eqNullSafe(F.col("__p")), "left_anti")
    gone = _partition_paths(current, emptied, partition_col)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(table_path))
    for path in gone:
        fs, p = _folder(spark, path, encoded=True)
        fs.delete(p, True)


def _partition_paths(current: DataFrame, emptied: DataFrame, partition_col: str) -> list[str]:
    """Folders of the emptied partitions (of those a batch touches, a few), by the files that their rows stand in."""
    files = current.select(partition_col, F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("__folder"))
    return [r[0] for r in _matching(files, emptied, [partition_col]).select("__folder").distinct().collect()]


def start_upsert_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table_path: str,
                        keys: Sequence[str], load_col: str, partition_col: str, checkpoint_location: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    w = (stream.writeStream
         .foreachBatch(lambda df, _batch_id: upsert_batch(spark, df, table_path, keys, load_col, partition_col))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
