"""Energy buckets against a direct evaluation of their definition."""

from __future__ import annotations

import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US, DAY_US, SECOND_US
from kerbflow.operators.grids import Grid
from kerbflow.plans import energy, runs
from tests.conftest import rows

SAMPLES = "nodeid string, sensor string, time bigint, value double"
SETTINGS = "siteid string, nodeid string, legacy_power double, max_led_power double"
G0 = 1_704_067_200_000_000


def from_rates(spark, points, until=G0 + 8 * BUCKET_US, rules=energy.EnergyRules()):
    """Buckets for rates given directly, as {bucket: actual power}."""
    rates = spark.createDataFrame([("n", t, float(r)) for t, r in points], "nodeid string, time bigint, rate double")
    settings = spark.createDataFrame([("s", "n", 100.0, 40.0)], SETTINGS)
    grid = Grid(G0, until)
    summary = energy.neighbour_summary(rates, grid, rules.zero_watts).join(settings, "nodeid")
    out = energy.savings(energy.with_power(energy.bucket_neighbours(summary, grid), rules), grid)
    return {(r.starttime - G0) // BUCKET_US: r for r in out.collect()}


def brute_force(points, n, rules=energy.EnergyRules()):
    points = sorted(points)
    ts = [t for t, _ in points]
    result = []
    for i in range(n):
        start, end = G0 + i * BUCKET_US, G0 + (i + 1) * BUCKET_US
        live = [r for t, r in points if start <= t < end and r > rules.zero_watts]
        if live:
            result.append(sum(live) / len(live))
            continue
        q = bisect_left(ts, end)
        value = 0.0
        if 0 < q < len(points):
            (pt, pr), (qt, qr) = points[q - 1], points[q]
            if (qt - pt) // SECOND_US <= 2 * rules.interval_s and (pr + qr) / 2 > rules.zero_watts:
                value = (pr + qr) / 2
        result.append(value)
    return result


@pytest.mark.parametrize("seed", range(4))
def test_random_rates_match_definition(spark, seed):
    rng = random.Random(seed)
    rules = energy.EnergyRules(interval_s=rng.choice([600, 1500, 6000]))
    n = 40
    times_ = rng.sample(range(G0 - 5 * BUCKET_US, G0 + 44 * BUCKET_US), 30)
    points = [(t, rng.choice([0.05, 0.1, rng.random() * 200])) for t in times_]
    got = from_rates(spark, points, G0 + n * BUCKET_US + 5, rules)
    expected = brute_force(points, n, rules)
    assert sorted(got) == list(range(n))
    for i, value in enumerate(expected):
        assert got[i].actual_energy_consumption == pytest.approx(value, abs=1e-9)
        on = value > 0
        assert got[i].legacy_energy_consumption == (100.0 if on else 0.0)
        assert got[i].led_energy_consumption == (40.0 if on else 0.0)
        assert got[i].savings_legacy_vs_led == (15.0 if on else 0.0)


def test_gap_of_twice_the_interval_is_filled_and_one_second_more_is_not(spark):
    rules = energy.EnergyRules(interval_s=1800)
    near = from_rates(spark, [(G0, 10), (G0 + 3600 * SECOND_US + 999_999, 30)], rules=rules)
    far = from_rates(spark, [(G0, 10), (G0 + 3601 * SECOND_US, 30)], rules=rules)
    assert [near[i].actual_energy_consumption for i in range(1, 4)] == [20.0] * 3
    assert [far[i].actual_energy_consumption for i in range(1, 4)] == [0.0] * 3


def test_low_bucket_counts_as_gap_and_trailing_gap_stays_empty(spark):
    got = from_rates(spark, [(G0, 10), (G0 + BUCKET_US + 5, 0.05), (G0 + 2 * BUCKET_US, 30)])
    assert got[1].actual_energy_consumption == pytest.approx((0.05 + 30) / 2)
    assert [got[i].actual_energy_consumption for i in range(3, 8)] == [0.0] * 5


def test_rows_on_bucket_edges_and_grid_size(spark):
    got = from_rates(spark, [(G0 + BUCKET_US, 50)], until=G0 + 3 * BUCKET_US - 1)
    assert sorted(got) == [0, 1]  # the third bucket does not end by `until`
    assert got[0].actual_energy_consumption == 0.0
    assert got[1].actual_energy_consumption == 50.0
    assert Grid(G0, G0 + 1).size == 1


def test_only_rows_after_the_grid_still_give_all_buckets(spark):
    got = from_rates(spark, [(G0 + 8 * BUCKET_US, 50)])
    assert len(got) == 8
    assert all(r.actual_energy_consumption == 0 for r in got.values())


def test_node_without_settings_is_left_out_and_order_does_not_matter(spark):
    rng = random.Random(3)
    data = [
        (f"n{rng.randrange(3)}", "w", G0 + rng.randrange(DAY_US), rng.random() * 1e6) for _ in range(200)
    ]
    settings = spark.createDataFrame([("s", "n0", 90.0, 40.0), ("s", "n1", 80.0, 30.0)], SETTINGS)
    grid = runs.energy_grid(G0 + DAY_US + 5, G0 + DAY_US)
    assert grid.start_us == G0
    results = [
        rows(
            energy.node_15min(
                spark.createDataFrame(d, SAMPLES).repartition(p), settings, grid
            ).withColumn("actual_energy_consumption", F.round("actual_energy_consumption", 6)).drop(
                "savings_legacy_vs_actual"
            )
        )
        for d, p in ((data, 1), (data[::-1], 5))
    ]
    assert results[0] == results[1]
    assert len(results[0]) == 2 * 96


def test_rollup_units(spark):
    got = from_rates(spark, [(G0, 10), (G0 + BUCKET_US, 30)])
    frame = spark.createDataFrame(list(got.values()))
    node = energy.node_rollup(frame, "1hr").orderBy("starttime").first()
    site = energy.site_rollup(frame, "1hr").orderBy("starttime").first()
    quarter = energy.site_rollup(frame, "15min").orderBy("starttime").first()
    assert node.actual_energy_consumption == 10.0  # mean W of four buckets, two empty
    assert site.actual_energy_consumption == 10.0  # Wh: (10 + 30) * 0.25
    assert quarter.actual_energy_consumption == 10.0
    assert node.savings_legacy_vs_led == site.savings_legacy_vs_led == 30.0


def test_lamps_of_a_node_add_up(spark, store):
    """Two fixtures on one node, one of them reached over two sites."""
    fixtures = spark.createDataFrame([("f1", "100W", "40W"), ("f2", "200 w", "60w"), ("f3", "10W", "20W")], "fixtureid string, LegacyPowerDraw string, PowerDraw string")
    at_site = spark.createDataFrame([("f1", "s2"), ("f2", "s1"), ("f2", "s2"), ("f3", "s1")], "fixtureid string, siteid string")
    to_node = spark.createDataFrame([("f1", "n"), ("f2", "n"), ("f3", "n")], "fixtureid string, nodeid string")
    settings = runs.Jobs(store).energy_settings(at_site, fixtures, to_node)
    assert rows(settings) == [("s1", "n", 300.0, 100.0)]


def test_several_settings_rows_of_a_node_are_refused(spark):
    twice = spark.createDataFrame([("s", "n", 100.0, 40.0), ("s", "n", 200.0, 40.0)], SETTINGS)
    samples = spark.createDataFrame([("n", "w", G0, 1.0), ("n", "w", G0 + 60 * SECOND_US, 2.0)], SAMPLES)
    with pytest.raises(Exception, match="several settings rows for node n"):
        energy.node_15min(samples, twice, Grid(G0, G0 + 8 * BUCKET_US)).collect()


def test_a_long_grid_is_emitted_in_pieces(spark):
    """One key with two samples far apart: its buckets are dealt out over all tasks."""
    n = 200_000
    grid = Grid(G0, G0 + n * BUCKET_US)
    rates = spark.createDataFrame([("n", G0, 5.0), ("n", G0 + (n - 1) * BUCKET_US, 7.0)], "nodeid string, time bigint, rate double")
    emitted = energy.bucket_neighbours(energy.neighbour_summary(rates, grid, 0.1), grid)
    sizes = [r["count"] for r in emitted.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n and len(sizes) == 4 and max(sizes) < n / 2
    assert emitted.agg(F.min("grid_bucket"), F.max("grid_bucket"), F.count_distinct("grid_bucket")).first() == (0, n - 1, n)
