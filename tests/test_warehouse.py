"""Versions, upserts, staging, local days, retention and the control table."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.operators import numbering, scans, versions
from kerbflow.operators.counters import running_counter
from kerbflow.plans import warehouse
from kerbflow.session import scratch_path
from kerbflow.sources import schemas
from kerbflow.sources.control import ControlTable
from tests.conftest import rows

T0 = 1_704_067_200_000_000  # 2024-01-01 00:00 UTC


def facts(spark, *data):
    return spark.createDataFrame(list(data), "k string, ts bigint, v string, startday string")


def test_latest_version_with_equal_stamps_keeps_one_row(spark):
    staged = facts(spark, ("a", 1, "x", "d"), ("a", 2, "y", "d"), ("a", 2, "z", "d"), ("b", 1, "x", "d"))
    assert rows(warehouse.latest_version(staged, ["k"]), "k", "v") == [("a", "z"), ("b", "x")]
    assert rows(versions.latest_with_ties(staged, ["k"], "ts"), "k", "v") == [
        ("a", "y"),
        ("a", "z"),
        ("b", "x"),
    ]


def test_upsert_twice_is_once_and_leaves_other_days(spark, store):
    first = facts(spark, ("a", 1, "old", "2024-01-01"), ("b", 1, "old", "2024-01-02"), ("c", 1, "old", "2024-01-03"))
    second = facts(spark, ("b", 2, "new", "2024-01-02"), ("d", 2, "new", "2024-01-04"))
    store.upsert("t", first, ["k"])
    before = rows(store.read("t", first.schema).filter("k = 'a'").select(F.input_file_name()))
    once = rows(store.upsert("t", second, ["k"]))
    again = rows(store.upsert("t", second, ["k"], days=("2024-01-02", "2024-01-04")))
    assert once == again
    assert [(r[0], r[2]) for r in once] == [("a", "old"), ("b", "new"), ("c", "old"), ("d", "new")]
    assert before == rows(store.read("t", first.schema).filter("k = 'a'").select(F.input_file_name()))


def test_refresh_replay_and_late_row_for_older_day(spark, store):
    table = warehouse.FactTable("t", ("k",), "ts")
    warehouse.refresh_warehouse(store, table, facts(spark, ("a", 1, "x", "2024-01-01"), ("b", 1, "x", "2024-01-02")))
    late = facts(spark, ("a", 5, "late", "2024-01-01"), ("e", 5, "late", "2024-01-01"))
    once = rows(warehouse.refresh_warehouse(store, table, late))
    replayed = rows(warehouse.refresh_warehouse(store, table, late))
    assert once == replayed
    assert [(r[0], r[2]) for r in once] == [("a", "late"), ("b", "x"), ("e", "late")]
    only_today = warehouse.refresh_warehouse(
        store, table, facts(spark, ("a", 9, "z", "2024-01-01"), ("b", 9, "z", "2024-01-02")), days=["2024-01-02"]
    )
    assert [(r[0], r[2]) for r in rows(only_today)] == [("a", "late"), ("b", "z"), ("e", "late")]


def test_staging_retention_drops_whole_days(spark, store):
    store.append("stg_t", facts(spark, *[("a", 1, "x", f"2024-01-0{d}") for d in range(1, 6)]), by=["startday"])
    assert store.drop_days_before("stg_t", "2024-01-03") == ["2024-01-01", "2024-01-02"]
    kept = rows(store.read("stg_t").select("startday"))
    assert kept == [("2024-01-03",), ("2024-01-04",), ("2024-01-05",)]


def test_local_day_differs_from_utc_on_both_sides_and_across_dst(spark):
    sites = spark.createDataFrame(
        [("la", "America/Los_Angeles"), ("syd", "Australia/Sydney")], "siteid string, time_zone string"
    )
    moments = {
        "winter": 1_704_081_600_000_000,  # 2024-01-01 04:00 UTC
        "before change": 1_710_064_500_000_000,  # 2024-03-10 09:55 UTC
        "after change": 1_710_064_800_000_000,  # 2024-03-10 10:00 UTC
        "evening": 1_704_121_200_000_000,  # 2024-01-01 15:00 UTC
    }
    base = spark.createDataFrame(
        [(s, n, t) for n, t in moments.items() for s in ("la", "syd", "unknown")],
        "siteid string, n string, starttime bigint",
    ).withColumn("endtime", F.col("starttime") + times.BUCKET_US)
    staged = warehouse.stage_local(base.withColumns(times.bucket_labels()), sites, 7)
    got = {(r.siteid, r.n): (r.startdt, r.startday, r.startday_utc) for r in staged.collect()}
    assert ("unknown", "winter") not in got
    assert got[("la", "winter")] == ("2023-12-31 20:00:00", "2023-12-31", "2024-01-01")
    assert got[("la", "before change")][0] == "2024-03-10 01:55:00"
    assert got[("la", "after change")][0] == "2024-03-10 03:00:00"
    assert got[("syd", "evening")] == ("2024-01-02 02:00:00", "2024-01-02", "2024-01-01")


def test_units_of_time_columns(spark):
    both = spark.createDataFrame([(T0, T0 // 1000)], "us bigint, ms bigint")
    assert rows(both, warehouse.utc_day(F.col("us"), "us"), warehouse.utc_day(F.col("ms"), "ms")) == [
        ("2024-01-01", "2024-01-01")
    ]


def test_refresh_span():
    day = 86_400
    assert warehouse.refresh_span(day + 3600) == ["1970-01-01", "1970-01-02"]
    assert warehouse.refresh_span(day + 3599) == warehouse.refresh_span(day + 7200) == ["1970-01-02"]


def test_fact_keys_are_complete(spark):
    row = spark.createDataFrame(
        [("s", "e", "15min", t, c, 1) for t in ("Enter", "Leave") for c in ("car", "bike")],
        "siteid string, eventid string, aggregation_type string, type string, objectclass string, endtime bigint",
    ).withColumn("ts", F.lit(1))
    keys = warehouse.FACT_TABLES["aggregation_traffic_events"].keys
    assert warehouse.latest_version(row, keys).count() == 4
    assert len(warehouse.FACT_TABLES) == 9


def test_running_counter_ignores_the_overlap(spark):
    totals = spark.createDataFrame(
        [(7, 0, "fresh"), (7, 20, "known"), (1, 2, "silent")],
        "count bigint, aggregated_count bigint, trafficdetectioneventid string",
    )
    events = spark.createDataFrame(
        [("fresh", 99), ("fresh", 100), ("known", 100), ("known", 150), ("other", 150)],
        "trafficdetectioneventid string, time bigint",
    )
    assert rows(running_counter(totals, events, "trafficdetectioneventid", "time", 100)) == [
        ("fresh", 8),
        ("known", 22),
        ("silent", 2),
    ]


def test_control_table(store):
    control = ControlTable(store)
    assert control.get("hwm", "traffic") == "na"
    control.seed("hwm", "traffic", "first")
    control.seed("hwm", "traffic", "second")
    assert control.get("hwm", "traffic") == "first"
    control.put("hwm", "traffic", "later", stamp=5)
    control.put("hwm", "traffic", "earlier", stamp=4)
    control.put("hwm", "other", "x", stamp=9)
    assert control.get("hwm", "traffic") == "later"


def test_window_bounds_and_lookback(spark):
    df = spark.createDataFrame([(i,) for i in (8, 9, 10, 19, 20)], "t bigint")
    assert rows(scans.time_window(df, "t", 10, 20)) == [(10,), (19,)]
    assert rows(scans.time_window(df, "t", 10, 20, 1)) == [(9,), (10,), (19,)]


def test_key_batches_are_full_but_the_last(spark):
    keys = spark.createDataFrame([(f"n{i:03d}",) for i in range(25)] * 2, "k string").repartition(5)
    batches = {r.batch_no: r.grp.split(",") for r in numbering.key_batches(keys, "k", 10).collect()}
    assert [len(batches[i]) for i in range(3)] == [10, 10, 5]
    assert [x for i in range(3) for x in batches[i]] == [f"'n{i:03d}'" for i in range(25)]


def test_defaults_and_schemas(spark):
    for name in schemas.known_tables():
        assert schemas.schema_of(name).fields
    df = spark.createDataFrame([(None, None)], "config string, other string")
    assert rows(scans.with_defaults(df, schemas.NULL_DEFAULTS["parking_zone_status"])) == [("na", None)]
    assert len(schemas.SENSOR_CODES) == 47 and len(schemas.ALARM_CODES) == 35


def test_scratch_stays_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_reading_a_missing_table_fails_but_or_empty_does_not(store):
    with pytest.raises(AnalysisException):
        store.read("absent").count()
    assert store.read_or_empty("absent", "a int").count() == 0


def test_rows_that_move_to_another_day_stay_once(spark, store):
    """The first bucket of a day's row moves back over the local midnight."""
    table = warehouse.FactTable("daily", ("siteid", "endtime"), "starttime", local=True)
    sites = spark.createDataFrame([("ny", "America/New_York"), ("syd", "Australia/Sydney")], "siteid string, time_zone string")

    def refresh(run_s, *facts):
        df = spark.createDataFrame([(s, e * times.DAY_US, int(t * times.HOUR_US), n) for s, e, t, n in facts], "siteid string, endtime bigint, starttime bigint, n int")
        staged = warehouse.stage_local(df.withColumns(times.bucket_labels()), sites, run_s)
        return rows(warehouse.refresh_warehouse(store, table, staged), "siteid", "endtime", "n", "startday")

    # 10:00 UTC is the same day in New York, 02:00 the day before.
    first = refresh(1, ("ny", 1, 10, 5), ("ny", 2, 34, 7), ("syd", 1, 20, 1))
    assert first == [("ny", times.DAY_US, 5, "1970-01-01"), ("ny", 2 * times.DAY_US, 7, "1970-01-02"), ("syd", times.DAY_US, 1, "1970-01-02")]
    moved = [("ny", times.DAY_US, 6, "1969-12-31"), ("ny", 2 * times.DAY_US, 7, "1970-01-02"), ("syd", times.DAY_US, 1, "1970-01-02")]
    assert refresh(2, ("ny", 1, 2, 6)) == moved
    # Played again, and after an old version came back from staging, it stays so.
    assert refresh(2, ("ny", 1, 2, 6)) == moved
    assert refresh(1, ("ny", 1, 10, 5)) == moved
    # A day that lost its only row is gone, and one that was not touched is as before.
    assert not store.drop_days("fs_daily", ["1970-01-01"])
    assert refresh(3, ("ny", 2, 26, 8)) == [("ny", times.DAY_US, 6, "1969-12-31"), ("ny", 2 * times.DAY_US, 8, "1970-01-01"), ("syd", times.DAY_US, 1, "1970-01-02")]


def test_days_around():
    assert warehouse.days_around(["2024-03-01"], 1) == ["2024-02-29", "2024-03-01", "2024-03-02"]
    assert warehouse.days_around([], 2) == [] and warehouse.days_around(["2024-01-01"], 0) == ["2024-01-01"]
