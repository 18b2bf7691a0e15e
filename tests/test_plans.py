"""Plan shape: no ordered window over a whole frame, partial group limits where skew matters."""

import re

import pytest

import __spark_entry__ as entry
from strata.operators.snapshot import latest_rows
from strata.plans.panel import build_panel
from strata.sources import adapter

from .conftest import SF_SMALL

SPEC = re.compile(r"windowspecdefinition\((.*?)specifiedwindowframe")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def unpartitioned_windows(plan: str) -> list[str]:
    """Window specs with no partition key (or a constant one) whose input is not a per-slice offset table."""
    bad = []
    for m in SPEC.finditer(plan):
        inner = m.group(1)
        first = inner.split(",")[0].strip()
        unpartitioned = bool(re.search(r" (ASC|DESC) NULLS", first)) or first in ("1", "")
        context = plan[max(0, m.start() - 120):m.end()]
        if unpartitioned and "__slice" not in inner and "__tot_" not in context:
            bad.append(context[-200:])
    return bad


QUERIES = {k: f for r in entry._registries() for k, f in r.SPARK.items()}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_single_partition_window(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert unpartitioned_windows(plan_text(df)) == []


def test_panel_build_has_no_single_partition_window(spark):
    p = build_panel(spark, SF_SMALL)
    for df in (p.raw, p.fact):
        assert unpartitioned_windows(plan_text(df)) == []


def test_partial_group_limits(spark, tmp_out):
    firsts = plan_text(adapter.first_orders(spark, SF_SMALL))
    assert "WindowGroupLimit" in firsts and ", Partial" in firsts
    # V1 over a fact read from files: the top-1 per entity is cut before the shuffle.
    # (Over the cached fact, already partitioned by entity, no shuffle is planned at all.)
    build_panel(spark, SF_SMALL).fact.write.parquet(f"{tmp_out}/fact")
    latest = plan_text(latest_rows(spark.read.parquet(f"{tmp_out}/fact")))
    assert re.search(r"WindowGroupLimit \[.*rank\(.*, 1, Partial", latest)


def test_scans_are_pruned(spark):
    plan = plan_text(adapter.daily_measures(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("l_comment" not in s and "o_totalprice" not in s for s in schemas)
    li = [s for s in schemas if "l_orderkey" in s]
    assert li == ["struct<l_orderkey:bigint,l_discount:double>"]
