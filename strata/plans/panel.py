"""Build (and reuse within a session) the adapter panel: raw, clean fact, dimension.

Many questions read the same fact and snapshot; building them once per
(session, data folder) and persisting them is the Spark form of the
reference's views. ``persist`` keeps the lineage, so a lost executor's blocks
are recomputed rather than lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from strata.operators.clean import clean_panel
from strata.operators.star import project_rename
from strata.sources.adapter import build_dimension, build_raw_panel


@dataclass
class Panel:
    raw: DataFrame
    fact: DataFrame
    dim: DataFrame


_CACHE: dict[tuple[str, str], Panel] = {}


def build_panel(spark: SparkSession, sf_dir: str) -> Panel:
    dim = build_dimension(spark, sf_dir)
    raw = build_raw_panel(spark, sf_dir, dim)
    clean = clean_panel(raw, entity="country_id", date="date", names=False)
    fact = project_rename(clean)
    return Panel(raw=raw, fact=fact, dim=dim)


def panel(spark: SparkSession, sf_dir: str, cache: bool = True) -> Panel:
    if not cache:
        return build_panel(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    p = _CACHE.get(key)
    if p is None:
        b = build_panel(spark, sf_dir)
        lvl = StorageLevel.MEMORY_AND_DISK
        p = Panel(raw=b.raw.persist(lvl), fact=b.fact.persist(lvl), dim=b.dim.persist(lvl))
        _CACHE[key] = p
    return p


def release(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    for k in [k for k in _CACHE if k[0] == app]:
        p = _CACHE.pop(k)
        for df in (p.raw, p.fact, p.dim):
            df.unpersist()


_USER_CACHE: dict[tuple[str, str], DataFrame] = {}


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user x day panel (``sources.events_adapter``), persisted once per session and folder."""
    from strata.sources.events_adapter import build_user_panel

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    p = _USER_CACHE.get(key)
    if p is None:
        p = build_user_panel(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
        _USER_CACHE[key] = p
    return p
