"""Properties of the physical plans: what is pushed down, shuffled, and kept off Python."""

from __future__ import annotations

import os

import pytest

from kerbflow.catalogue import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables absent")

RUNS = {"parking_after_gap", "energy_two_fixtures"}  # building these runs whole jobs
CORE = [
    n
    for n in sorted(all_queries())
    if n not in RUNS and n.startswith(("traffic", "energy", "parking", "dim_", "capacity", "interval", "asof", "counter", "combo"))
]


def plan_of(spark, name):
    frame = all_queries()[name].build(spark, SF_DIR)
    return frame._jdf.queryExecution().sparkPlan().toString() + frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CORE)
def test_no_cross_product_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "SinglePartition"):
        assert unwanted not in plan, unwanted


def test_time_window_reaches_the_scan(spark):
    plan = plan_of(spark, "scan_window")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_day_window_prunes_partitions(spark):
    plan = plan_of(spark, "scan_pruned")
    assert "PartitionFilters: [isnotnull(startday" in plan


def test_latest_version_is_combined_before_the_shuffle(spark):
    plan = plan_of(spark, "latest_version")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_parking_shuffles_changes_once_and_summaries_once(spark):
    frame = all_queries()["parking_15min_spot"].build(spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(parkingspotid#") >= 1
    by_slice = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "slice" in line]
    by_spot = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line]
    assert len(by_slice) == 1 and len(by_spot) == 1
