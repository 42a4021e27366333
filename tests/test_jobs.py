"""Whole runs over a store: outputs, carried state, marks and repeatability."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US, DAY_US, HOUR_US, SECOND_US
from kerbflow.plans import energy, parking, recompute, runs
from kerbflow.sources.schemas import schema_of
from tests.conftest import rows

DAY0 = 1_704_067_200_000_000
T0 = DAY0 + 10 * HOUR_US


def put(store, name, data):
    store.replace(name, store.spark.createDataFrame(data, schema_of(name)))


def test_run_window():
    assert runs.run_window(10, 100) == runs.RunWindow(10, 100)
    # A backlog is worked off from the mark on, in pieces that touch.
    assert runs.run_window(10, 100, max_lag_us=50) == runs.RunWindow(10, 60)
    assert runs.run_window(60, 100, max_lag_us=50) == runs.RunWindow(60, 100)
    assert runs.run_window(80, 100, max_lag_us=30) == runs.RunWindow(80, 100)
    assert runs.run_window(10, 100, start_us=50).partial
    assert runs.run_window(10, 100, only_key=True).partial
    assert runs.traffic_start(T0 + 5, daily=False) == T0
    assert runs.traffic_start(T0 + 5, daily=True) == DAY0 - DAY_US


@pytest.fixture
def traffic_store(store):
    car = json.dumps({"detected_objects": [{"class": "car", "detectedobjectid": 1, "velocity": {"x": 3, "y": 4}}]})
    put(
        store,
        "traffic_status",
        [
            ("n", T0 + i * 50 * SECOND_US, None, None, None, car, f"e{i}", "Enter", "o", "s", None, "d", None)
            for i in range(3)
        ],
    )
    return store


def test_traffic_run(traffic_store):
    jobs = runs.Jobs(traffic_store)
    window = runs.RunWindow(T0 + 5, T0 + HOUR_US)
    jobs.traffic(window, keep_facts=True)
    by_event = traffic_store.read("aggregation_traffic_events")
    assert rows(by_event, "aggregation_type", "type", "eventid", "eventcnt") == sorted(
        [(g, "Enter", "d", 3) for g in ("15min", "1hr")]
        + [(g, "COMBO", f"n==>e{i}==>e{i + 1}", 1) for g in ("15min", "1hr") for i in (0, 1)]
    )
    assert traffic_store.read("job_traffic_events").count() == 5
    assert jobs.mark("traffic", 0) == T0 + HOUR_US
    assert jobs.window("traffic", T0 + 9 * HOUR_US) == runs.RunWindow(T0 + HOUR_US, T0 + 9 * HOUR_US)
    jobs.control.put(jobs.shared_parameters, runs.LAG_LIMIT_KEY, "120", stamp=1)
    assert jobs.window("traffic", T0 + 9 * HOUR_US) == runs.RunWindow(T0 + HOUR_US, T0 + 3 * HOUR_US)
    before = rows(by_event)
    jobs.traffic(runs.RunWindow(T0, T0 + HOUR_US, partial=True), daily=True)
    again = traffic_store.read("aggregation_traffic_events")
    assert rows(again.filter("aggregation_type <> '1day'")) == before
    assert again.filter("aggregation_type = '1day'").count() == 3
    assert rows(traffic_store.read("aggregation_traffic_events_site"), "aggregation_type", "type", "eventcnt") == sorted(
        (g, t, c) for g in ("15min", "1hr", "1day") for t, c in (("Enter", 3), ("COMBO", 2))
    )


def test_partial_run_keeps_the_mark(traffic_store):
    jobs = runs.Jobs(traffic_store)
    jobs.traffic(jobs.window("traffic", T0 + HOUR_US, start_us=T0, only_key=True), only="n")
    assert jobs.mark("traffic", T0 + HOUR_US) == T0
    assert traffic_store.read("aggregation_traffic_events").count() == 6
    jobs.traffic(jobs.window("traffic", T0 + HOUR_US, only_key=True), only="other")
    assert traffic_store.read("aggregation_traffic_events").count() == 6


def status_row(node, us, event):
    car = json.dumps({"detected_objects": [{"class": "car", "detectedobjectid": 1, "velocity": {"x": 3, "y": 4}}]})
    return (node, us, None, None, None, car, event, "Enter", "o", "s", None, "d", None)


def test_two_hourly_runs_equal_one(store):
    put(store, "traffic_status", [status_row("n", T0 + HOUR_US + s * SECOND_US, e) for s, e in ((-10, "a"), (5, "b"))])
    jobs = runs.Jobs(store)
    jobs.traffic(runs.RunWindow(T0, T0 + HOUR_US))
    jobs.traffic(runs.RunWindow(T0 + HOUR_US, T0 + 2 * HOUR_US))
    parts = rows(store.read("aggregation_traffic_events"))
    jobs.traffic(runs.RunWindow(T0, T0 + 2 * HOUR_US))
    assert rows(store.read("aggregation_traffic_events")) == parts
    assert store.read("aggregation_traffic_events").filter("type = 'COMBO'").count() == 2


def test_late_earlier_bucket_replaces_the_hour(store):
    put(store, "traffic_status", [status_row("n", T0 + 2 * BUCKET_US, "a")])
    jobs = runs.Jobs(store)
    jobs.traffic(runs.RunWindow(T0, T0 + HOUR_US))
    put(store, "traffic_status", [status_row("n", T0 + i * BUCKET_US, "a") for i in (0, 2)])
    jobs.traffic(runs.RunWindow(T0, T0 + HOUR_US))
    hour = store.read("aggregation_traffic_events_site").filter("aggregation_type = '1hr'")
    assert rows(hour, "starttime", "eventcnt") == [(T0, 2)]


def test_single_node_run_leaves_mark_and_site(store):
    put(store, "traffic_status", [status_row(n, T0, "a") for n in ("m", "n", "o")])
    jobs = runs.Jobs(store)
    jobs.traffic(runs.RunWindow(T0, T0 + HOUR_US))
    jobs.traffic(runs.RunWindow(T0, T0 + 2 * HOUR_US), only="n")
    assert jobs.mark("traffic", 0) == T0 + HOUR_US
    site = store.read("aggregation_traffic_events_site").filter("aggregation_type = '1hr'")
    assert rows(site, "eventcnt") == [(3,)]


def test_refresh_keeps_rows_whose_staging_is_retired(store):
    jobs = runs.Jobs(store)
    window = runs.RunWindow(T0, T0 + HOUR_US)

    def batch(*minutes):
        data = [status_row("n", T0 + m * 60 * SECOND_US, "a") for m in minutes]
        return store.spark.createDataFrame(data, schema_of("traffic_status"))

    jobs.refresh("traffic_status", batch(1, 2), window, run_s=1)
    assert jobs.retire_staging("traffic_status", "2024-01-09") == ["2024-01-01"]
    merged = jobs.refresh("traffic_status", batch(2, 3), window, run_s=2)
    assert rows(merged.withColumn("m", F.expr(f"(time - {T0}) div 60000000")), "m", "ts") == [(1, 1), (2, 2), (3, 2)]


def test_energy_run(store):
    put(
        store,
        "device_sensor_samples",
        [("n", "w", None, DAY0 + i * BUCKET_US + 7, 15.0 * i) for i in range(8)],
    )
    put(store, "device_energy_settings", [("s", "n", 100.0, 40.0)])
    jobs = runs.Jobs(store)
    window = runs.RunWindow(DAY0 + DAY_US, DAY0 + 2 * HOUR_US)
    assert jobs.energy_rules() == energy.EnergyRules(6000, 0.1)
    jobs.energy(window)
    node = store.read("aggregation_energy_savings_node")
    quarter = node.filter("aggregation_type = '15min'").orderBy("starttime")
    assert [r.actual_energy_consumption for r in quarter.collect()] == [0.0] + [60.0] * 7
    hours = node.filter("aggregation_type = '1hr'").orderBy("starttime")
    assert [r.actual_energy_consumption for r in hours.collect()] == [45.0, 60.0]
    site = store.read("aggregation_energy_savings_site").filter("aggregation_type = '1day'").first()
    assert site.actual_energy_consumption == pytest.approx(7 * 60 * 0.25)
    before = rows(node)
    jobs.energy(window)
    assert rows(store.read("aggregation_energy_savings_node")) == before
    jobs.energy(runs.RunWindow(window.from_us, window.until_us, partial=True), only="elsewhere")
    assert rows(store.read("aggregation_energy_savings_node")) == before


def parking_tables(store, changes):
    put(store, "parking_spot_historic", [("s", t, 0, "n", "o", occ, "o", "g", p, "z") for p, t, occ in changes])
    put(store, "parking_zone_status", [("s", "o", "g", "z", "Demarcated", None)])
    current = store.spark.createDataFrame(
        [(p, "z", True, True) for p in ("p", "q")],
        "parkingspotid string, parkingzoneid string, demarcated boolean, active boolean",
    )
    full = schema_of("parking_spot_current")
    have = set(current.columns)
    store.replace(
        "parking_spot_current",
        current.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in full)),
    )
    put(store, "parking_zone_group", [("z", "g1")])


def test_parking_state_is_carried_to_the_next_run(store):
    changes = [("p", T0 + 5 * BUCKET_US, True), ("q", T0 + BUCKET_US, True), ("q", T0 + 2 * BUCKET_US, False)]
    parking_tables(store, changes)
    jobs = runs.Jobs(store)
    jobs.parking(runs.RunWindow(T0 + BUCKET_US, T0 + 6 * BUCKET_US))
    assert jobs.mark("parking", 0) == T0 + 6 * BUCKET_US
    # Nothing arrives any more; "p" stays occupied through the carried state alone.
    jobs.parking(runs.RunWindow(T0 + 9 * BUCKET_US, T0 + 12 * BUCKET_US), buckets_back=1)
    spot = store.read("aggregation_parking_spot").filter("parkingspotid = 'p'").orderBy("starttime")
    got = {(r.starttime - T0) // BUCKET_US: (r.occduration, r.turnovers) for r in spot.collect()}
    assert got[4] == (0, 0) and got[5] == (BUCKET_US, 1)
    grid = runs.parking_grid(T0 + 9 * BUCKET_US, T0 + 12 * BUCKET_US)
    assert grid.start_us == T0 + 8 * BUCKET_US
    # No run wrote the bucket before that grid; the last known state holds.
    assert {b: got[b] for b in got if b > 5} == {b: (BUCKET_US, 0) for b in range(8, 12)}
    jobs.parking(runs.RunWindow(T0 + 8 * BUCKET_US, T0 + 10 * BUCKET_US), buckets_back=1)
    spot = store.read("aggregation_parking_spot").filter("parkingspotid = 'p'")
    assert rows(spot.filter(F.col("starttime") >= T0 + 6 * BUCKET_US), "occduration", "turnovers") == [
        (BUCKET_US, 0)
    ] * 6
    zone = store.read("aggregation_parking_zone").filter(F.col("starttime") == T0 + 6 * BUCKET_US)
    assert rows(zone, "zoneid", "groupid", "occpercent", "capacity") == [("z", "g1", 50.0, 2)]
    states = store.read("aggregation_parking_status")
    assert states.count() == states.select("parkingspotid", "starttime").distinct().count()


def test_parking_rerun_changes_nothing(store):
    parking_tables(store, [("p", T0 + BUCKET_US, True), ("q", T0 + 2 * BUCKET_US, True)])
    jobs = runs.Jobs(store)
    window = runs.RunWindow(T0 + BUCKET_US, T0 + 6 * BUCKET_US)
    names = [f"aggregation_parking_{n}" for n in ("status", "spot", "zone", "group", "site")]
    jobs.parking(window)
    before = [rows(store.read(n)) for n in names]
    jobs.parking(window)
    assert [rows(store.read(n)) for n in names] == before
    assert all(before)


def test_refresh_counters_snapshots_and_dimensions(traffic_store):
    store, spark = traffic_store, traffic_store.spark
    jobs = runs.Jobs(store)
    status = store.read_input("traffic_status", schema_of("traffic_status"))
    window = runs.RunWindow(T0 + 60 * SECOND_US, T0 + HOUR_US)
    assert jobs.refresh("traffic_status", status, window, run_s=1).count() == 3
    assert jobs.refresh("traffic_status", status, window, run_s=2).select("ts").distinct().collect()[0][0] == 2
    put(store, "traffic_current_status", [(5, None, "d"), (3, 9, "x")])
    first_seen = status.withColumn("trafficdetectioneventid", F.lit("new"))
    counted = jobs.update_counters(status.unionByName(first_seen), window)
    assert rows(counted, "trafficdetectioneventid", "aggregated_count", "count") == [
        ("d", 6, 5),
        ("new", 1, 0),
        ("x", 9, 3),
    ]
    with pytest.raises(ValueError):
        jobs.refresh("aggregation_parking_spot", status.withColumn("starttime", F.col("time")), window, 1)
    parking_tables(store, [("p", T0, True)])
    jobs.snapshots(run_s=3)
    assert rows(store.read("fs_parking_zone_status"), "zoneid", "capacity", "config", "ts") == [("z", 2, "na", 3)]
    assert store.read("fs_parking_spot").columns[-1] == "ts"
    jobs.copy_dimensions({"site": spark.createDataFrame([("a",)], "siteid string")})
    jobs.copy_dimensions({"site": spark.createDataFrame([("b",)], "siteid string")})
    assert rows(store.read("fs_site")) == [("b",)]
    assert jobs.retire_staging("traffic_status", "2024-01-09") == ["2024-01-01"]


def test_end_states_feed_the_next_grid(spark):
    states = spark.createDataFrame([("s", 1, "p", True, 5)], "siteid string, starttime bigint, parkingspotid string, occupancy boolean, x int")
    assert parking.end_states(states).columns == ["siteid", "starttime", "parkingspotid", "occupancy"]


def test_states_are_found_without_reading_all_days(store):
    """Runs days apart: the last known state holds, and old partitions are not opened."""
    day = DAY_US
    parking_tables(store, [("p", T0 + BUCKET_US, True), ("q", T0 + BUCKET_US, True), ("q", T0 + 2 * BUCKET_US, False)])
    jobs = runs.Jobs(store)
    jobs.parking(runs.RunWindow(T0 + BUCKET_US, T0 + 4 * BUCKET_US))
    # A run over two midnights stores the states at both.
    jobs.parking(runs.RunWindow(T0 + day, T0 + 3 * day))
    assert store.days(runs.DAY_STATES) == ["2024-01-03", "2024-01-04"]
    start = T0 + 3 * day + 2 * HOUR_US
    prior = jobs.states_before(start)
    assert rows(prior, "parkingspotid", "occupancy") == [("p", True), ("q", False)]
    plan = prior._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 2
    assert "startday#" in filters[0] and all(">= 2024-01-04" in f or "= 2024-01-04" in f for f in filters)
    jobs.parking(runs.RunWindow(start + BUCKET_US, start + 3 * BUCKET_US))
    spot = store.read("aggregation_parking_spot").filter(F.col("starttime") >= start)
    assert rows(spot, "parkingspotid", "occduration") == [("p", BUCKET_US)] * 3
    # A late change is in the window of a repeated run, which corrects the stored states.
    store.append(
        "parking_spot_historic",
        store.spark.createDataFrame([("s", T0 + day + HOUR_US, 0, "n", "o", False, "o", "g", "p", "z")], schema_of("parking_spot_historic")),
    )
    jobs.parking(runs.RunWindow(T0 + day + BUCKET_US, T0 + 3 * day, partial=True))
    assert rows(jobs.states_before(start), "parkingspotid", "occupancy") == [("p", False), ("q", False)]


def test_late_detections_touch_their_periods_only(traffic_store):
    """A late event splits a transition; other sites and days are neither read nor written."""
    store, spark = traffic_store, traffic_store.spark
    jobs = runs.Jobs(store)
    status = store.read_input("traffic_status", schema_of("traffic_status"))
    other = status.withColumns({"siteid": F.lit("far"), "nodeid": F.lit("m"), "time": F.col("time") + 5 * DAY_US})
    window = runs.RunWindow(T0, T0 + 9 * DAY_US)
    jobs.refresh("traffic_status", status.unionByName(other), window, run_s=1)
    jobs.late_traffic(status.unionByName(other))
    table = "aggregation_traffic_events"

    def combos():
        return rows(store.read(table).filter("type = 'COMBO' and aggregation_type = '1hr'"), "siteid", "eventid")

    far = [("far", f"m==>e{i}==>e{i + 1}") for i in (0, 1)]
    assert combos() == far + [("s", f"n==>e{i}==>e{i + 1}") for i in (0, 1)]
    untouched = set(store.read(table).filter("siteid = 'far'").select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    late = status.limit(1).withColumns({"time": F.lit(T0 + 10 * SECOND_US), "name": F.lit("late")})
    jobs.refresh("traffic_status", late, window, run_s=2)
    jobs.late_traffic(late)
    # The transition that the late event splits is gone.
    assert combos() == far + [("s", "n==>e0==>late"), ("s", "n==>e1==>e2"), ("s", "n==>late==>e1")]
    assert untouched == set(store.read(table).filter("siteid = 'far'").select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    daily = store.read(table).filter("siteid = 's' and type <> 'COMBO' and aggregation_type = '1day'")
    assert daily.agg(F.sum("eventcnt")).first()[0] == 4


def test_rows_of_periods_opens_only_their_days(spark, store):
    facts = spark.createDataFrame([(s, DAY0 + d * DAY_US + b * BUCKET_US, f"2024-01-0{d + 1}") for s in "ab" for d in range(4) for b in (0, 1, 5)], "siteid string, time bigint, startday string")
    stored = store.append("t", facts, by=["startday"])
    late = spark.createDataFrame([("a", DAY0 + 2 * DAY_US + 7), ("a", None)], "siteid string, time bigint")
    buckets = recompute.touched_buckets(late, ["siteid"], "time", ahead=1)
    periods = recompute.touched_periods(buckets, ["siteid"], BUCKET_US)
    got = recompute.rows_of_periods(stored, periods, ["siteid"], "time", BUCKET_US, before=1)
    assert rows(got, "siteid", "time") == [("a", DAY0 + 2 * DAY_US), ("a", DAY0 + 2 * DAY_US + BUCKET_US)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [startday" in plan and "2024-01-03" in plan and "2024-01-04" not in plan
