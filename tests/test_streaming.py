"""Streams fed file by file must end where one batch over all rows ends."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from kerbflow.functions.times import BUCKET_US
from kerbflow.operators.grids import Grid
from kerbflow.plans import parking
from kerbflow.session import scratch_path
from kerbflow.streaming import carry, tumbling
from tests.conftest import rows

T0 = 1_704_067_200_000_000
SCHEMA = "parkingspotid string, since bigint, occupancy boolean, parkingzoneid string"


def changes(spark, n=200):
    rng = random.Random(5)
    ts = rng.sample(range(T0, T0 + 12 * BUCKET_US), n)
    return spark.createDataFrame(
        [("p0" if rng.random() < 0.5 else f"p{rng.randrange(5)}", t, rng.random() < 0.5, "z") for t in sorted(ts)],
        SCHEMA,
    )


def feed(df, folder, first, last):
    part = df.filter((F.col("since") >= first) & (F.col("since") < last))
    part.coalesce(1).write.mode("append").parquet(folder)


def test_counts_over_several_runs_equal_the_batch(spark, tmp_path):
    df = changes(spark)
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(3):
        feed(df, source, T0 + i * 4 * BUCKET_US, T0 + (i + 1) * 4 * BUCKET_US)
        stream = tumbling.file_stream(spark, source, df.schema).withColumn("one", F.lit(1.0))
        counts = tumbling.tumbling_counts(stream, "since", ["parkingspotid"], "one")
        query = tumbling.keep_batches(counts, target, state)
        assert query.awaitTermination(120)
    got = tumbling.latest_batches(spark, target, ["parkingspotid", "starttime"])
    expected = df.groupBy(
        "parkingspotid", (F.col("since") - F.col("since") % BUCKET_US).alias("starttime")
    ).agg(F.count("*").alias("n"))
    assert rows(got, "parkingspotid", "starttime", "eventcnt") == rows(expected)


def test_carried_state_equals_the_batch(spark):
    df = changes(spark)
    grid = Grid(T0 + BUCKET_US, T0 + 12 * BUCKET_US + 5)
    prior = spark.createDataFrame([("p1", True), ("p2", False)], "parkingspotid string, occupancy boolean")
    source = scratch_path(spark, "changes")
    df.repartition(3).write.parquet(source)
    stream = tumbling.file_stream(spark, source, df.schema)
    streamed = carry.run_state_carry(stream, prior, grid, late="1 day")
    batch = parking.spot_buckets(parking.spot_spans(df, prior, grid), grid)
    assert rows(streamed) == rows(batch, "parkingspotid", "starttime", "occupancy")
