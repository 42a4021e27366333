"""Parking buckets against a direct evaluation of the occupancy step function."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US, HOUR_US
from kerbflow.operators.grids import Grid
from kerbflow.operators.intervals import bucket_overlap
from kerbflow.operators.sequences import with_next
from kerbflow.plans import capacity, parking, runs
from tests.conftest import rows

G0 = 1_704_070_800_000_000
EVENTS = "parkingspotid string, since bigint, occupancy boolean, parkingzoneid string"
PRIOR = "parkingspotid string, occupancy boolean"


def buckets(spark, changes, prior=(), n=4, until=None):
    events = spark.createDataFrame([(s, t, o, "z") for s, t, o in changes], EVENTS)
    states = spark.createDataFrame(list(prior), PRIOR)
    grid = Grid(G0, until or G0 + n * BUCKET_US)
    out = parking.spot_buckets(parking.spot_spans(events, states, grid), grid)
    return {
        (r.parkingspotid, (r.starttime - G0) // BUCKET_US): (r.occduration, r.turnovers, r.occupancy)
        for r in out.collect()
    }


def brute_force(changes, initial, n):
    changes = sorted(changes)
    result = {}
    for i in range(n):
        start, end = G0 + i * BUCKET_US, G0 + (i + 1) * BUCKET_US
        steps = [(-(10**18), initial), *changes, (10**18, None)]
        covered = sum(
            max(0, min(end, nxt) - max(start, t))
            for (t, state), (nxt, _) in zip(steps, steps[1:])
            if state
        )
        turns = sum(
            1
            for (_, before), (t, state) in zip(steps, steps[1:-1])
            if start <= t < end and state and not before
        )
        last = [state for t, state in steps[:-1] if t < end][-1]
        result[i] = (covered, turns, last)
    return result


@pytest.mark.parametrize("seed", range(4))
def test_random_changes_match_definition(spark, seed):
    rng = random.Random(seed)
    n = 12
    changes, prior, expected = [], [], {}
    for s in range(6):
        spot = f"p{s}"
        count = 120 if s == 0 else rng.randrange(1, 12)
        ts = rng.sample(range(G0 - BUCKET_US, G0 + (n + 1) * BUCKET_US), count)
        own = [(t, rng.random() < 0.6) for t in ts]
        initial = rng.choice([None, True, False])
        if initial is not None:
            prior.append((spot, initial))
        changes += [(spot, t, o) for t, o in own]
        expected |= {(spot, i): v for i, v in brute_force(own, bool(initial), n).items()}
    assert buckets(spark, changes, prior, n) == expected


def test_total_occupied_time_equals_interval_overlap(spark):
    rng = random.Random(9)
    ts = rng.sample(range(G0, G0 + 10 * BUCKET_US), 60)
    changes = [("p", t, rng.random() < 0.5) for t in ts]
    got = buckets(spark, changes, n=10)
    grid = Grid(G0, G0 + 10 * BUCKET_US)
    events = spark.createDataFrame([(s, t, o, "z") for s, t, o in changes], EVENTS)
    stretches = with_next(events, ["parkingspotid"], ["since"], [], levels=(BUCKET_US,)).filter("occupancy")
    stretches = stretches.withColumn("until_us", F.coalesce("following.since", F.lit(grid.end_us)))
    overlap = bucket_overlap(stretches, ["parkingspotid"], "since", "until_us", grid)
    assert {(G0 + i * BUCKET_US, v[0]) for (_, i), v in got.items() if v[0]} == set(
        rows(overlap, "starttime", "covered_us")
    )
    assert all(0 <= v[0] <= BUCKET_US for v in got.values())


@pytest.mark.parametrize("slices", [15, 900])
def test_number_of_slices_does_not_matter(spark, slices):
    rng = random.Random(4)
    own = [(t, rng.random() < 0.6) for t in rng.sample(range(G0, G0 + 6 * BUCKET_US), 80)]
    grid = Grid(G0, G0 + 6 * BUCKET_US)
    events = spark.createDataFrame([("p", t, o, "z") for t, o in own], EVENTS)
    spans = parking.spot_spans(events, spark.createDataFrame([], PRIOR), grid, slices)
    got = rows(parking.spot_buckets(spans, grid), "starttime", "occduration", "turnovers", "occupancy")
    assert got == [(G0 + i * BUCKET_US, *v) for i, v in brute_force(own, False, 6).items()]


def test_bucket_edges_and_repeated_rows(spark):
    got = buckets(
        spark,
        [
            ("p", G0, True),
            ("p", G0 + 100, True),  # repeated: time counts, turnover does not
            ("p", G0 + BUCKET_US, False),  # exactly at the next bucket's start
            ("q", G0 - 5, True),  # before the grid: sets the state only
        ],
        n=2,
    )
    assert got[("p", 0)] == (BUCKET_US, 1, True)
    assert got[("p", 1)] == (0, 0, False)
    assert got[("q", 0)] == (BUCKET_US, 0, True)


def test_tail_rows_do_not_touch_the_last_bucket(spark):
    got = buckets(spark, [("p", G0 + 2 * BUCKET_US + 7, True)], until=G0 + 3 * BUCKET_US - 1)
    assert got == {("p", 0): (0, 0, False), ("p", 1): (0, 0, False)}


def test_silent_occupied_spot_is_full_without_turnover(spark):
    grid = Grid(G0, G0 + 2 * BUCKET_US)
    events = spark.createDataFrame([("p1", G0 + 5, True, "z1")], EVENTS)
    prior = spark.createDataFrame([("p1", True), ("p2", True), ("p3", False)], PRIOR)
    spots = spark.createDataFrame(
        [(f"p{i}", "z1") for i in (1, 2, 3)], "parkingspotid string, parkingzoneid string"
    )
    zones = spark.createDataFrame(
        [("z1", "s", "Demarcated", 3)], "parkingzoneid string, siteid string, ptype string, capacity bigint"
    )
    bridge = spark.createDataFrame(
        [("z1", "g2"), ("z1", "g1")], "parkingzoneid string, parkinggroupid string"
    )
    facts = parking.spot_15min(events, prior, spots, zones, bridge, grid)
    got = rows(facts, "parkingspotid", "starttime", "occduration", "turnovers", "groupid", "occpercent")
    assert got == [
        ("p1", G0, BUCKET_US, 0, "g1", 100.0),
        ("p1", G0 + BUCKET_US, BUCKET_US, 0, "g1", 100.0),
        ("p2", G0, BUCKET_US, 0, "g1", 100.0),
        ("p2", G0 + BUCKET_US, BUCKET_US, 0, "g1", 100.0),
    ]
    zone = parking.zone_rollup(facts)
    assert rows(zone, "starttime", "occpercent", "filled_cnt", "turnovers") == [
        (G0, 66.7, 2, 0),
        (G0 + BUCKET_US, 66.7, 2, 0),
    ]
    site = parking.area_rollup(zone, "siteid")
    assert rows(site, "siteid", "starttime", "occduration", "occpercent") == [
        ("s", G0, float(BUCKET_US), 66.7),
        ("s", G0 + BUCKET_US, float(BUCKET_US), 66.7),
    ]


def test_null_spot_ids_do_not_hide_silent_spots(spark):
    grid = Grid(G0, G0 + BUCKET_US)
    events = spark.createDataFrame([(None, G0, True, "z")], EVENTS)
    prior = spark.createDataFrame([("p", True)], PRIOR)
    spots = spark.createDataFrame([("p", "z")], "parkingspotid string, parkingzoneid string")
    assert rows(parking.silent_occupied(events, prior, spots, grid), "parkingspotid") == [("p",)]


def test_grid_start_is_strictly_before_the_mark():
    exact = runs.parking_grid(G0 + 2 * BUCKET_US, G0 + HOUR_US, buckets_back=0)
    later = runs.parking_grid(G0 + 2 * BUCKET_US + 1, G0 + HOUR_US, buckets_back=0)
    assert exact.start_us == G0 + BUCKET_US
    assert later.start_us == G0 + 2 * BUCKET_US


def test_capacity(spark):
    def box(*corners):
        import json

        return json.dumps({"roi": {"world_bounding_box": [list(corners)]}})

    a, mid = {"latitude": 37.0, "longitude": -122.0}, {"latitude": 0, "longitude": 0}
    configs = {
        "same point": box(a, mid, a),
        "49 m": box(a, mid, {"latitude": 37.0 + 49 / 111194.92664, "longitude": -122.0}),
        "quoted": box(
            {"latitude": "37.0", "longitude": "-122.0"},
            mid,
            {"latitude": "37.000440667", "longitude": "-122.0"},
        ),
        "missing corner": box(a, mid),
        "broken": '{"roi":',
        "none": "na",
    }
    zones = spark.createDataFrame(
        [("s", name, "NonDemarcated", c) for name, c in configs.items()]
        + [("s", "marked", "Demarcated", "na"), ("s", "empty", "Demarcated", "na"), ("s", "x", "Street", "na")],
        "siteid string, parkingzoneid string, type string, config string",
    )
    spots = spark.createDataFrame(
        [("1", "marked", True, True), ("2", "marked", True, False), ("3", "marked", False, True)],
        "parkingspotid string, parkingzoneid string, demarcated boolean, active boolean",
    )
    held = capacity.zone_capacity(zones, spots)
    assert dict(held.dtypes)["capacity"] == "bigint"
    assert {r.parkingzoneid: r.capacity for r in held.collect()} == {
        "same point": 0,
        "49 m": 10,
        "quoted": 10,
        "missing corner": 0,
        "broken": 0,
        "none": None,
        "marked": 1,
        "empty": None,
    }


def test_zero_capacity_gives_no_percentage(spark):
    grid = Grid(G0, G0 + BUCKET_US)
    zones = spark.createDataFrame(
        [("z", "s", "NonDemarcated", 0)], "parkingzoneid string, siteid string, ptype string, capacity bigint"
    )
    spots = spark.createDataFrame([("p", "z")], "parkingspotid string, parkingzoneid string")
    bridge = spark.createDataFrame([], "parkingzoneid string, parkinggroupid string")
    events = spark.createDataFrame([("p", G0, True, "z")], EVENTS)
    facts = parking.spot_15min(events, spark.createDataFrame([], PRIOR), spots, zones, bridge, grid)
    zone = parking.zone_rollup(facts)
    assert rows(zone, "groupid", "occpercent", "capacity") == [("na", None, 0)]
    assert rows(parking.area_rollup(zone, "siteid"), "occpercent") == [(None,)]
