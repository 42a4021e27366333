"""Keyed state carried between micro-batches: the last state of every spot and bucket.

The state is one row per spot and bucket, kept by a streaming ``max_by``.  Rows are
combined per task before they reach the state, so a busy spot does not load one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.operators.grids import Grid, emit_to_next
from kerbflow.operators.versions import latest_per_key
from kerbflow.session import scratch_path
from kerbflow.streaming.tumbling import BATCH, drain, keep_batches


def last_states(stream: DataFrame, grid: Grid, late: str = "1 hour") -> DataFrame:
    """Streaming state: last (since, occupancy) per spot and grid bucket."""
    return (
        stream.withColumn("moment", F.timestamp_micros(F.col("since")))
        .withWatermark("moment", late)
        .groupBy("parkingspotid", F.window("moment", f"{grid.width_us // 1000} milliseconds"))
        .agg(F.max(F.struct("since", "occupancy")).alias("last"))
        .select("parkingspotid", "last.since", "last.occupancy")
    )


def carried_states(changes: DataFrame, prior: DataFrame, grid: Grid) -> DataFrame:
    """End-of-bucket state of every spot for all grid buckets, empty ones included."""
    rows = changes.withColumn("bucket", grid.index(F.col("since")))
    newest = latest_per_key(
        rows, ["parkingspotid", "bucket"], [F.col("since").desc(), F.col("occupancy").desc()]
    )
    initial = prior.select("parkingspotid", F.col("occupancy").alias("initial"))
    spread = emit_to_next(newest, ["parkingspotid"], "bucket", grid).join(
        initial, "parkingspotid", "left"
    )
    state = F.when(
        F.col("is_lead_in"), F.coalesce("initial", F.lit(False))
    ).otherwise(F.col("occupancy"))
    return spread.select(
        "parkingspotid",
        grid.start_of(F.col("grid_bucket")).alias("starttime"),
        state.alias("occupancy"),
    )


def run_state_carry(
    stream: DataFrame, prior: DataFrame, grid: Grid, late: str = "1 hour", timeout_s: int | None = None
) -> DataFrame:
    """Drain what is available now and return the end-of-bucket states.

    One run over a grid that is known; :mod:`kerbflow.streaming.keyed_state` goes on from
    run to run.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, "states"), scratch_path(spark, "states-state")
    drain(keep_batches(last_states(stream, grid, late), path, checkpoint), timeout_s)
    return carried_states(spark.read.parquet(path).drop(BATCH), prior, grid)
