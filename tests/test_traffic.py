"""Detections, dwell and transitions on hand-made events."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US, SECOND_US
from kerbflow.plans import traffic
from tests.conftest import rows

T0 = 1_704_067_200_000_000
STATUS = (
    "nodeid string, time bigint, data string, name string, type string, siteid string, "
    "trafficdetectioneventid string"
)


def status(spark, *events):
    """(time, data, type, name) tuples of node n."""
    return spark.createDataFrame(
        [("n", t, d, name, kind, "s", "e") for t, d, kind, name in events], STATUS
    )


def seen(*objects):
    return json.dumps({"detected_objects": list(objects)})


def expanded(spark, data, kind="Enter"):
    out = traffic.expand_detections(status(spark, (T0, data, kind, "in")))
    return sorted(
        (tuple(r) for r in out.select("objectclass", "objectid", "objectvelocity", "dwell").collect()),
        key=repr,
    )


NOTHING = [("na", "na", None, None)]


@pytest.mark.parametrize(
    "data, expected",
    [
        ("no json", NOTHING),
        ("na", NOTHING),
        (None, NOTHING),
        ("{}", NOTHING),
        ('{"detected_objects": []}', NOTHING),
        ('{"detected_objects": 5}', NOTHING),
        ('{"detected_objects":[{"class":"x"', NOTHING),
        (seen({"class": "Car", "detectedobjectid": 5, "velocity": {"x": 3, "y": 4}}), [("car", "5", 5.0, 0.0)]),
        (seen({"class": "", "detectedobjectid": "a"}), [("na", '"a"', 0.0, 0.0)]),
        (seen({}), [("na", "", 0.0, 0.0)]),
        (
            seen({"class": "b", "velocity": {"x": 0, "y": 0}, "world_velocity": {"x": 6, "y": 8}}),
            [("b", "", 10.0, 0.0)],
        ),
        (
            seen({"class": "b", "velocity": {"x": "3", "y": 4}, "world_velocity": {"x": 6, "y": 8}}),
            [("b", "", 10.0, 0.0)],
        ),
        (seen({"class": "b", "velocity": {"x": 3}, "world_velocity": 1}), [("b", "", 0.0, 0.0)]),
        (seen({"class": "b", "velocity": {"x": "NaN", "y": 1}}), [("b", "", 0.0, 0.0)]),
        (seen(5, {"class": "c"}), [("c", "", 0.0, 0.0), ("na", "", 0.0, 0.0)]),
        (seen(None, {"class": "c"}), [("c", "", 0.0, 0.0), ("na", "", 0.0, 0.0)]),
    ],
)
def test_detections(spark, data, expected):
    assert expanded(spark, data) == sorted(expected, key=repr)


def test_dwell_rows_carry_their_time_and_collapse(spark):
    car = seen({"class": "car", "detectedobjectid": 1})
    kind = traffic.DWELL_TYPE
    facts = traffic.object_facts(
        status(
            spark,
            (T0 + 5 * SECOND_US, car, kind, "b"),
            (T0 + 9 * SECOND_US, car, kind, "a"),
            (T0 + BUCKET_US, car, kind, "next bucket"),
            (T0 + 1, "bad", kind, "nothing seen"),
        )
    )
    assert rows(facts, "starttime", "eventname", "eventtime", "objectid", "objectvelocity", "dwell") == sorted(
        [
            (T0, "a", T0 + 5 * SECOND_US, "1", 0.0, 6_000_000.0),
            (T0, "nothing seen", T0 + 1, "na", 0.0, None),
            (T0 + BUCKET_US, "next bucket", T0 + BUCKET_US, "1", 0.0, 2_000_000.0),
        ]
    )


def test_transition_within_sixty_seconds(spark):
    car = seen({"class": "car", "detectedobjectid": 1, "velocity": {"x": 1, "y": 0}})
    start = T0 + BUCKET_US - 10 * SECOND_US  # pairs straddle a bucket edge
    facts = traffic.object_facts(
        status(
            spark,
            (start, car, "Enter", "one"),
            (start + 60_000_000 - 1, car, "Leave", "two"),
            (start + 2 * 60_000_000 - 1, car, "Leave", "three"),  # exactly 60 s later
        )
    )
    combos = traffic.transitions(facts)
    assert rows(combos, "eventname", "eventid", "eventtime", "starttime") == [
        ("n==>one==>two", "n==>one==>two", start + 60_000_000 - 1, T0 + BUCKET_US)
    ]
    everything = traffic.with_transitions(facts)
    assert everything.count() == 4
    counted = traffic.rollup(everything, "1hr", by_event=False)
    assert rows(counted, "type", "eventcnt") == [("COMBO", 1), ("Enter", 1), ("Leave", 2)]


def test_speed_zero_is_left_out_of_means(spark):
    def at(x, k):
        return (T0 + k, seen({"class": "car", "detectedobjectid": k, "velocity": {"x": x, "y": 0}}), "Enter", "e")

    facts = traffic.traffic_facts(status(spark, at(2, 1), at(0, 2), at(4, 3), at(9, 4)))
    row = traffic.rollup(facts.filter("eventtype = 'Enter'"), "15min", by_event=True).first()
    assert (row.avgvelocity, row.medianvelocity, row.p85velocity, row.eventcnt) == (5.0, 4.0, 9.0, 4)
    assert (row.name, row.nodeid, row.avgdwell) == ("e", "n", None)
    assert (row.startdt, row.enddt, row.starthr, row.startday) == (
        "2024-01-01 00:00",
        "2024-01-01 00:15",
        "2024-01-01 00",
        "2024-01-01",
    )


def test_grouping_sets_equal_single_rollups(spark):
    car = seen({"class": "car", "detectedobjectid": 1, "velocity": {"x": 1, "y": 2}})
    facts = traffic.traffic_facts(
        status(spark, *[(T0 + i * 7_000_000_000, car, "Enter", f"e{i % 3}") for i in range(20)])
    )
    for by_event in (True, False):
        single = traffic.rollup(facts, "15min", by_event)
        for grain in ("1hr", "1day"):
            single = single.unionByName(traffic.rollup(facts, grain, by_event))
        together = traffic.rollup_all(facts, by_event)
        assert together.columns == single.columns
        assert together.exceptAll(single).count() == single.exceptAll(together).count() == 0


def test_hour_end_comes_from_the_hour(spark):
    late = traffic.traffic_facts(status(spark, (T0 + 20 * 60 * SECOND_US, "bad", "Enter", "e")))
    hour = traffic.rollup(late, "1hr", by_event=False).select(
        "starttime", "endtime", F.col("enddt")
    )
    assert rows(hour) == [(T0 + BUCKET_US, T0 + 4 * BUCKET_US, "2024-01-01 00:30")]


@pytest.mark.parametrize("by_event", [True, False])
def test_grains_merged_from_sketches(spark, by_event):
    """Few rows: sketches are exact, so merged grains equal those of the facts."""
    events = []
    for i in range(40):
        data = seen({"class": "car", "detectedobjectid": i, "velocity": {"x": float(i % 9), "y": 0}}) if i % 5 else "na"
        events.append((T0 + i * 7 * 60 * SECOND_US, data, "Enter", f"in{i % 2}"))
    facts = traffic.traffic_facts(status(spark, *events)).cache()
    parts = traffic.sketched(facts, by_event)
    for grain in traffic.GRAINS:
        merged, plain = traffic.merged_rollup(parts, grain, by_event), traffic.rollup(facts, grain, by_event)
        assert merged.columns == plain.columns
        near = [F.round(c, 9).alias(c) if c in ("avgvelocity", "avgdwell") else F.col(c) for c in plain.columns]
        assert sorted(map(repr, merged.select(*near).collect())) == sorted(map(repr, plain.select(*near).collect()))


def test_merged_percentiles_keep_their_rank(spark):
    n = 20_000
    facts = spark.range(n).select(
        F.lit("s").alias("siteid"), F.lit("e").alias("eventid"), F.lit("Enter").alias("eventtype"), F.lit("car").alias("objectclass"),
        F.lit("x").alias("eventname"), F.lit("n").alias("nodeid"), F.lit(0.0).alias("dwell"),
        (F.lit(T0) + F.col("id") % 96 * BUCKET_US).alias("starttime"), (F.col("id") * 7919 % n + 1).cast("double").alias("objectvelocity"),
    )
    row = traffic.merged_rollup(traffic.sketched(facts, False), "1day", False).first()
    assert row.eventcnt == n
    assert abs(row.medianvelocity / n - 0.5) < 0.02 and abs(row.p85velocity / n - 0.85) < 0.02
