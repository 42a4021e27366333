"""Node groups: equal rows, missing texts, and what a task holds."""

from __future__ import annotations

from kerbflow.plans import dimensions
from tests.conftest import rows


def tables(spark):
    site_group = [("g1", "s1"), ("g1", "s1"), ("g1", None), ("g1", ""), ("g2", "s2"), ("g2", "s2"), (None, "s3")]
    groups = [
        ("g1", "one", None, ["Group"]),
        ("g1", "one", "", ["Group"]),
        ("g2", "two", "d", ["LightingGroup"]),
        ("g2", "two", "d", ["LightingGroup"]),
        ("g3", "three", "d", ["ParkingGroup"]),
        (None, "none", "d", ["Group"]),
    ]
    group_node = [("g1", "n1"), ("g1", "n1"), ("g1", None), ("g2", "n2"), ("g2", "n2"), ("g2", "n2"), ("g3", "n3"), (None, "n4")]
    return (
        spark.createDataFrame(site_group, "groupid string, siteid string"),
        spark.createDataFrame(groups, "groupid string, name string, description string, labels array<string>"),
        spark.createDataFrame(group_node, "groupid string, nodeid string"),
    )


def test_only_lighting_rows_repeat(spark):
    got = rows(dimensions.node_groups(*tables(spark)))
    plain = [(s, "g1", "one", "", "Organizational", n, "Group ") for s in ("", "s1") for n in ("", "n1")]
    assert got == sorted(plain + [("s2", "g2", "two", "d", "Lighting", "n2", "LightingGroup ")] * 12)


def test_joined_rows_are_not_grouped(spark):
    """Wide rows meet in no hash table: all grouping is below the joins."""
    plan = dimensions.node_groups(*tables(spark))._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[: plan.index("Join")]
