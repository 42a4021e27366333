"""Runs that go on from a checkpoint: late rows, repeated batches, carried state."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US, DAY_US, HOUR_US
from kerbflow.operators.grids import Grid
from kerbflow.sources.day_versions import DayVersions
from kerbflow.streaming import carry, keyed_state
from kerbflow.streaming.resumable import Pace, WindowTable, count_and_extremes, paced_stream
from tests.conftest import rows

T0 = 1_704_067_200_000_000
SCHEMA = "kind string, time bigint, value double"
COLUMNS = ("kind", "starttime", "endtime", "eventcnt", "total", "low", "high")


@pytest.fixture
def windows(spark, tmp_path):
    return WindowTable(
        spark, str(tmp_path / "windows"), str(tmp_path / "progress"), ["kind"], "time", count_and_extremes("value"), pace=Pace(max_files=1)
    )


def events(spark, first, last, n, seed):
    rng = random.Random(seed)
    made = [(rng.choice(["a", "b", None]), rng.randrange(first, last), float(rng.randrange(100))) for _ in range(n)]
    return spark.createDataFrame(made + [("a", None, 1.0)], SCHEMA)


def feed(df, folder, files=2):
    df.repartition(files).write.mode("append").parquet(str(folder))


def plain(df):
    timed = df.where("time is not null").withColumn("starttime", F.col("time") - F.col("time") % BUCKET_US)
    return timed.groupBy("kind", "starttime").agg(
        (F.col("starttime") + BUCKET_US).alias("endtime"),
        F.count("*").alias("eventcnt"),
        F.sum("value").alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def sorted_rows(df):
    return sorted(map(repr, rows_of(df)))


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_late_rows_reach_windows_stored_long_ago(spark, tmp_path, windows):
    """Three runs; the last one brings rows of the first day, two days behind."""
    source = tmp_path / "in"
    parts = [
        events(spark, T0, T0 + DAY_US, 60, 1),
        events(spark, T0 + DAY_US, T0 + 3 * DAY_US, 60, 2),
        events(spark, T0, T0 + 3 * HOUR_US, 20, 3),
    ]
    for k, part in enumerate(parts):
        feed(part, source)
        got = windows.run(paced_stream(spark, str(source), SCHEMA, windows.pace))
        expected = parts[0]
        for other in parts[1 : k + 1]:
            expected = expected.unionByName(other)
        assert sorted_rows(got) == sorted_rows(plain(expected))
    # Two files in each feed, one in each batch.
    table = DayVersions(spark, windows.path, windows.summed(parts[0]).schema)
    assert table.newest() >= 5
    assert all(len(v) <= 3 for v in table.versions().values())
    # A run without news changes nothing.
    assert sorted_rows(windows.run(paced_stream(spark, str(source), SCHEMA, windows.pace))) == sorted_rows(plain(expected))


@pytest.mark.parametrize("written", [False, True])
def test_a_batch_that_failed_counts_once(spark, tmp_path, windows, written, monkeypatch):
    """A run dies in the second batch, before or after its windows were written."""
    source = tmp_path / "in"
    df = events(spark, T0, T0 + 2 * DAY_US, 80, 4)
    feed(df, source, files=3)
    whole = WindowTable.merge_batch

    def dying(self, batch, number):
        if number == 1 and not written:
            raise RuntimeError("lost")
        whole(self, batch, number)
        if number == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(WindowTable, "merge_batch", dying)
    with pytest.raises(Exception, match="lost"):
        windows.run(paced_stream(spark, str(source), SCHEMA, windows.pace))
    monkeypatch.setattr(WindowTable, "merge_batch", whole)
    assert sorted_rows(windows.run(paced_stream(spark, str(source), SCHEMA, windows.pace))) == sorted_rows(plain(df))


def test_a_half_written_version_does_not_count(spark, tmp_path):
    table = DayVersions(spark, str(tmp_path / "t"), spark.createDataFrame([], "x int, startday string").schema)
    assert table.read().collect() == [] and table.newest() is None
    table.write(spark.createDataFrame([(1, "d1"), (2, "d2")], table.schema), 0)
    table.write(spark.createDataFrame([(3, "d2")], table.schema), 1)
    # A version without its mark is one whose job did not finish.
    table.write(spark.createDataFrame([(9, "d1"), (9, "d3")], table.schema), 2)
    (tmp_path / "t" / "version=2" / "_SUCCESS").unlink()
    assert rows(table.read()) == [(1, "d1"), (3, "d2")]
    assert rows(table.read(days=["d2"])) == [(3, "d2")]
    assert rows(table.read(before=1)) == [(1, "d1"), (2, "d2")]
    table.write(spark.createDataFrame([], table.schema), 2)
    assert rows(table.read()) == [(1, "d1"), (3, "d2")] and table.newest() == 2
    for version in (3, 4):
        table.write(spark.createDataFrame([(version, "d2")], table.schema), version)
    table.clean(before=5)
    assert table.versions() == {"d1": [0], "d2": [4, 3]}
    assert rows(table.read()) == [(1, "d1"), (4, "d2")]


def test_a_table_of_another_stream_is_refused(spark, tmp_path, windows):
    source = tmp_path / "in"
    feed(events(spark, T0, T0 + HOUR_US, 9, 5), source, files=1)
    windows._table(events(spark, T0, T0 + HOUR_US, 1, 5)).write(
        windows.summed(events(spark, T0, T0 + HOUR_US, 9, 5)), 7
    )
    with pytest.raises(Exception, match="not of one stream"):
        windows.run(paced_stream(spark, str(source), SCHEMA, windows.pace))


SPOTS = "parkingspotid string, since bigint, occupancy boolean"


def test_state_goes_on_between_runs(spark, tmp_path):
    """Feeds of four buckets, a busy spot, silent spots, rows before the start."""
    rng = random.Random(9)
    times = sorted(rng.sample(range(T0, T0 + 12 * BUCKET_US), 150))
    made = [("p0" if rng.random() < 0.6 else f"p{rng.randrange(1, 5)}", t, rng.choice([True, False, None])) for t in times]
    made += [("edge", T0 + 4 * BUCKET_US, True), ("edge", T0 + 5 * BUCKET_US - 1, False)]
    df = spark.createDataFrame(made, SPOTS)
    prior = spark.createDataFrame([("p1", True), ("silent", True), ("free", None), (None, True)], "parkingspotid string, occupancy boolean")
    grid = Grid(T0 + BUCKET_US, T0 + 12 * BUCKET_US)
    source, path, checkpoint = (str(tmp_path / x) for x in ("in", "out", "progress"))
    seen = 0
    for k in range(3):
        low, high = T0 + 4 * k * BUCKET_US, T0 + 4 * (k + 1) * BUCKET_US
        df.where((F.col("since") >= low) & (F.col("since") < high)).coalesce(2).write.mode("append").parquet(source)
        got = keyed_state.run_carried(paced_stream(spark, source, SPOTS), prior, grid.start_us, path, checkpoint, late="0 seconds")
        assert got.count() >= seen
        seen = got.count()
    assert seen > 0 and got.agg(F.max("starttime")).first()[0] < grid.end_us - BUCKET_US
    tick = spark.createDataFrame([(None, grid.end_us, None)], SPOTS)
    tick.write.mode("append").parquet(source)
    got = keyed_state.run_carried(paced_stream(spark, source, SPOTS), prior, grid.start_us, path, checkpoint, late="0 seconds")
    known = df.withColumn("occupancy", F.coalesce("occupancy", F.lit(False)))
    heard = carry.carried_states(known, prior, grid)
    silent = [(s, grid.start_us + i * BUCKET_US, s == "silent") for s in ("silent", "free") for i in range(grid.size)]
    assert rows(got) == sorted(rows(heard) + silent)


def test_silent_spots_share_calls_and_spans(spark, tmp_path):
    """What is stored follows the blocks and the changes, not spots times buckets."""
    grid = Grid(T0, T0 + 40 * BUCKET_US)
    prior = spark.range(6000).selectExpr("concat('s', id) as parkingspotid", "id % 3 = 0 as occupancy")
    made = [("s0", T0 + 5 * BUCKET_US, False), ("s0", T0 + 6 * BUCKET_US, False), ("s0", T0 + 9 * BUCKET_US, True)]
    made += [("new", T0 + 7 * BUCKET_US, True), (None, grid.end_us, None)]
    source, path, checkpoint = (str(tmp_path / x) for x in ("in", "out", "progress"))
    spark.createDataFrame(made, SPOTS).write.parquet(source)
    got = keyed_state.run_carried(paced_stream(spark, source, SPOTS), prior, grid.start_us, path, checkpoint, late="0 seconds")
    stored = spark.read.parquet(path).groupBy("batch_id").count().agg(F.max("count")).first()[0]
    # A block is called for its rows and for its timers.
    assert stored <= 2 * keyed_state.BLOCKS
    changed = {"s0": [True] * 5 + [False] * 4 + [True] * 31, "new": [False] * 7 + [True] * 33}
    spots = {f"s{i}": [i % 3 == 0] * grid.size for i in range(6000)} | changed
    assert rows(got) == sorted((s, grid.start_us + i * BUCKET_US, x) for s, xs in spots.items() for i, x in enumerate(xs))
