"""Overlap of keyed intervals with a bucket grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.operators.grids import Grid


def bucket_overlap(
    intervals: DataFrame, keys: Sequence[str], start: str, end: str, grid: Grid
) -> DataFrame:
    """Covered time per key and touched bucket.

    Each interval is clipped to the grid and expanded only to the buckets it touches.
    Intervals of one key are expected not to overlap each other.
    """
    clipped = (
        intervals.withColumn("_from", F.greatest(F.col(start), F.lit(grid.start_us)))
        .withColumn("_to", F.least(F.col(end), F.lit(grid.end_us)))
        .filter(F.col("_from") < F.col("_to"))
    )
    touched = clipped.withColumn(
        "bucket", F.explode(F.sequence(grid.index(F.col("_from")), grid.index(F.col("_to") - 1)))
    )
    bucket_from = grid.start_of(F.col("bucket"))
    overlap = F.least(F.col("_to"), bucket_from + F.lit(grid.width_us)) - F.greatest(
        F.col("_from"), bucket_from
    )
    return (
        touched.groupBy(*keys, "bucket")
        .agg(F.sum(overlap).alias("covered_us"))
        .withColumn("starttime", grid.start_of(F.col("bucket")))
        .drop("bucket")
    )
