"""Neighbour look-ups: slices must give what one window over the whole key gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbflow.functions.times import HOUR_US, SECOND_US
from kerbflow.operators import sequences
from kerbflow.operators.counters import counter_rate
from tests.conftest import rows

MINUTE = 60 * SECOND_US


def sequence(spark, seed=1, n=600):
    rng = random.Random(seed)
    # One key holds half of all rows; gaps range from seconds to many slices.
    data = []
    for i in range(n):
        key = "busy" if rng.random() < 0.5 else f"k{rng.randrange(8)}"
        data.append((key, rng.randrange(0, 40 * HOUR_US), i, rng.random() * 100))
    return spark.createDataFrame(data, "key string, time bigint, id int, value double")


def shuffles(df):
    """Shuffles that ran, and uses of one that had already run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    reused = final.count("ReusedExchange")  # such a line names the shuffle again
    return final.count(" Exchange hashpartitioning") - reused, reused


@pytest.mark.parametrize("levels", [(), (MINUTE,), (HOUR_US, 24 * HOUR_US), (MINUTE, HOUR_US, 24 * HOUR_US)])
@pytest.mark.parametrize("partitions", [1, 7])
def test_previous_and_next_equal_plain_window(spark, levels, partitions):
    df = sequence(spark).repartition(partitions)
    whole = Window.partitionBy("key").orderBy("time", "id")
    expected = df.withColumns(
        {"before": F.lag("value").over(whole), "after": F.lead("value").over(whole)}
    )
    with_before = sequences.with_previous(df, ["key"], ["time", "id"], ["value"], levels=levels)
    with_after = sequences.with_next(df, ["key"], ["time", "id"], ["value"], levels=levels)
    assert rows(expected.select("id", F.coalesce("before", F.lit(-1.0)))) == rows(
        with_before.select("id", F.coalesce("previous.value", F.lit(-1.0)))
    )
    assert rows(expected.select("id", F.coalesce("after", F.lit(-1.0)))) == rows(
        with_after.select("id", F.coalesce("following.value", F.lit(-1.0)))
    )


@pytest.mark.parametrize("slice_us", [MINUTE, 15 * MINUTE])
def test_recent_previous_equals_filtered_window(spark, slice_us):
    df = sequence(spark, seed=2, n=3000)
    gap = MINUTE
    whole = Window.partitionBy("key").orderBy("time", "id")
    expected = df.withColumn("t", F.lag("time").over(whole)).filter(F.col("time") - F.col("t") < gap)
    got = sequences.with_recent_previous(
        df, ["key"], ["time", "id"], [], gap, slice_us=slice_us
    ).filter("previous is not null")
    assert rows(expected, "id", "t") == rows(got.select("id", "previous.time"))
    assert expected.count() > 50


def test_a_key_that_holds_nearly_all_rows_is_spread(spark):
    """Nine of ten rows on one key: no window sees more than one hour of it, raw rows are
    shuffled once, and the answer is that of one window."""
    rng = random.Random(6)
    made = [("hot" if rng.random() < 0.9 else f"k{i % 7}", rng.randrange(0, 48 * HOUR_US), i, rng.random()) for i in range(6000)]
    df = spark.createDataFrame(made, "key string, time bigint, id int, value double")
    whole = Window.partitionBy("key").orderBy("time", "id")
    expected = df.withColumn("before", F.lag("value").over(whole))
    got = sequences.with_previous(df, ["key"], ["time", "id"], ["value"], levels=sequences.DENSE_LEVELS)
    assert rows(expected.select("id", F.coalesce("before", F.lit(-1.0)))) == rows(
        got.select("id", F.coalesce("previous.value", F.lit(-1.0)))
    )
    # Each of the three levels is shuffled once; what is used twice is read again.
    assert shuffles(got) == (3, 2)
    assert shuffles(sequences.with_previous(df, ["key"], ["time", "id"], ["value"])) == (2, 1)
    hourly = df.groupBy("key", (F.col("time") / HOUR_US).cast("int")).count().agg(F.max("count")).first()[0]
    assert hourly < 6000 / 20


def test_a_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, t * HOUR_US, t, float(t)) for t in range(5)], "key string, time bigint, id int, value double")
    got = sequences.with_previous(df, ["key"], ["time", "id"], ["value"])
    assert [v for _, v in rows(got.select("id", F.coalesce("previous.value", F.lit(-1.0))))] == [-1.0, 0.0, 1.0, 2.0, 3.0]


@pytest.mark.parametrize("fine", [SECOND_US // 10, SECOND_US, 7 * SECOND_US])
def test_busy_keys_are_cut_below_the_gap(spark, fine):
    """A key with many rows a second, with pauses around the gap, beside calm ones."""
    rng = random.Random(3)
    made, at = [], 0
    for i in range(4000):
        at += rng.choice([0, 1_000, 40_000, SECOND_US // 3, SECOND_US * 2, MINUTE - 1, MINUTE, MINUTE + 1]) if i % 50 == 0 else rng.randrange(1, 200_000)
        made.append(("busy", at, i, float(i)))
    made += [(f"k{i % 5}", rng.randrange(0, at), 10_000 + i, float(i)) for i in range(300)]
    df = spark.createDataFrame(made, "key string, time bigint, id int, value double")
    whole = Window.partitionBy("key").orderBy("time", "id")
    expected = df.withColumn("t", F.lag("time").over(whole)).filter(F.col("time") - F.col("t") < MINUTE)
    got = sequences.with_recent_previous(
        df, ["key"], ["time", "id"], [], MINUTE, busy=F.col("key") == "busy", busy_slice_us=fine
    )
    assert got.count() == df.count()
    assert rows(expected, "id", "t") == rows(got.filter("previous is not null").select("id", "previous.time"))
    # Both branches read one shuffle of the rows.
    assert shuffles(got) == (2, 1)


def test_counter_rate_edges(spark):
    samples = spark.createDataFrame(
        [
            ("a", "w", 0, 10.0),
            ("a", "w", HOUR_US, 15.0),  # 5 per hour
            ("a", "w", 2 * HOUR_US, 3.0),  # reset
            ("b", "mw", 7, 1.0),  # first sample
            ("c", "mw", 5, 1.0),
            ("c", "w", 5, 9.0),  # no time passed
        ],
        "nodeid string, sensor string, time bigint, value double",
    )
    got = {(r.nodeid, r.sensor, r.time): r.rate for r in counter_rate(samples).collect()}
    assert got == {
        ("a", "w", 0): None,
        ("a", "w", HOUR_US): 5.0,
        ("a", "w", 2 * HOUR_US): -12.0,
        ("b", "mw", 7): None,
        ("c", "mw", 5): None,
        ("c", "w", 5): None,
    }
    per_sensor = counter_rate(samples, ("nodeid", "sensor"), ties=())
    assert per_sensor.filter("nodeid = 'c' and rate is not null").count() == 0
