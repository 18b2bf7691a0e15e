"""Helpers shared by the corpus operators: table reads, Arrow batch limits, shared-folder checkpoints."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes and rows of an Arrow batch handed to a Python worker; whole rows, so one long text may exceed the bytes.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def limit_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once (the session's default is 10,000 rows, whatever their length)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    _ship(spark)


def _ship(spark: SparkSession) -> None:
    """Send this subpackage to the Python workers (addPyFile), once a context: they needn't have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_llm_shipped", False):
        return
    here = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="strata-llm-")) / "strata_llm.zip"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("strata/__init__.py", "")
        for p in sorted(here.glob("*.py")):
            z.write(p, f"strata/llm/{p.name}")
    sc.addPyFile(str(out))
    sc._strata_llm_shipped = True


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) and nothing else: null texts are empty, other columns can't clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares (spark.checkpoint.dir; see session.shared_dir)."""
    from strata.session import shared_dir  # on the driver alone: workers have this subpackage only

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """Eager checkpoint() in the folder the cluster shares (spark.checkpoint.dir)."""
    shared_path(df.sparkSession, "")
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of frames that a checkpoint has replaced.

    The first collection detaches what Python held in the driver's JVM, later ones find the shuffles unused.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def trim() -> None:
    """Give a worker's freed memory back to the system: workers are reused, and share the executor's limit."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    if libc and hasattr(ctypes.CDLL(libc), "malloc_trim"):
        ctypes.CDLL(libc).malloc_trim(0)


def slices(ids: list, texts: list[str], size: int = 1 << 20) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) in runs of some ``size`` characters, so that a step's lists stay small."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield ids[first:i + 1], texts[first:i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield ids[first:], texts[first:]


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts) of each batch."""
    for b in batches:
        yield b.column(0).to_pylist(), b.column(1).to_pylist()
    trim()


def keep_rows(docs: DataFrame, judge) -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``judge()`` keeps: it makes, once a task, a function from
    a list of texts (null: empty) to a list of booleans. No shuffle."""
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches):
        keeps = None
        for b in batches:
            keeps = keeps or judge()
            texts = [x if x is not None else "" for x in b.column(at).to_pylist()]
            yield b.filter(pa.array(keeps(texts), pa.bool_()))
        trim()

    return docs.mapInArrow(run, docs.schema)
