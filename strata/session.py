"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """One machine: the shared folder may be a temporary one, removed by the system."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-ckpt-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spill-aware defaults for a cluster run, from the input size and the executor cores.

    Shuffle partitions: enough that a partition of the largest shuffle (at most
    the input size, before partial aggregation shrinks it) stays near
    ``target_partition_bytes``, and at least 3 waves over the cores; AQE then
    coalesces small ones and splits skewed ones. Scan splits of 256 MB keep
    parquet tasks large enough to amortise scheduling at 100 TB.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    parts = max(3 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for written intermediate tables.

    It is the session's checkpoint directory (``spark.checkpoint.dir``). Without one, a local master (one
    process, as in tests) gets a temporary folder; on a cluster this raises, as the executors would not see
    a folder of the driver's machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


#: Rows that a task of a shuffle takes at most, in steps that know how many there are.
ROWS_A_TASK = 500_000


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles run here have the session's partitions, or more where a task would have more than ``ROWS_A_TASK`` of so many
    rows: a task's memory does not grow with the input. Adaptive execution still joins small ones and splits skewed ones."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-rows // ROWS_A_TASK))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never reused, never deleted here)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/strata-out/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["local_session", "cluster_settings", "shared_dir", "partitions_for", "new_output_path"]
