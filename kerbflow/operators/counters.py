"""Rates from cumulative meters, and running event counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.times import HOUR_US
from kerbflow.operators.sequences import LEVELS, with_previous


def counter_rate(
    samples: DataFrame,
    keys: Sequence[str] = ("nodeid",),
    time: str = "time",
    value: str = "value",
    ties: Sequence[str] = ("sensor",),
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Hourly rate between each sample and the one before it.

    The first sample of a key and equal times give null; a reset gives a negative rate.
    Pass ``keys=("nodeid", "sensor")`` to keep several meters of a node apart.
    """
    paired = with_previous(samples, keys, [time, *ties], [value], levels=levels)
    change = F.col(value) - F.col(f"previous.{value}")
    elapsed = F.col(time) - F.col(f"previous.{time}")
    rate = F.try_divide(change, elapsed) * F.lit(float(HOUR_US))
    return paired.withColumn("rate", rate).drop("previous")


def running_counter(
    totals: DataFrame, events: DataFrame, key: str, time: str, mark_us: int
) -> DataFrame:
    """New totals: previous total (or the plain count when that is 0) plus new events.

    Only events at or after the mark are counted, so re-reading an overlap adds nothing
    twice.
    """
    batch = (
        events.filter(F.col(time) >= F.lit(mark_us)).groupBy(key).agg(F.count("*").alias("_new"))
    )
    previous = F.when(F.col("aggregated_count") == 0, F.col("count")).otherwise(
        F.col("aggregated_count")
    )
    return totals.join(batch, key, "left").select(
        key, (previous + F.coalesce("_new", F.lit(0))).alias("aggregated_count")
    )


def merged_counter(
    totals: DataFrame, events: DataFrame, key: str, time: str, mark_us: int
) -> DataFrame:
    """:func:`running_counter` with the plain counts, and with ids first seen among the events.

    Totals and events are added up in one grouping, so neither side is joined to itself.
    New ids have a plain count of 0; events without an id are left out.
    """
    fresh = events.filter((F.col(time) >= F.lit(mark_us)) & F.col(key).isNotNull())
    previous = F.when(F.col("aggregated_count") == 0, F.col("count")).otherwise(F.col("aggregated_count"))
    known = totals.select(key, "count", F.coalesce(previous, "count").alias("_total"))
    one = fresh.select(key, F.lit(0).cast("long").alias("count"), F.lit(1).cast("long").alias("_total"))
    return known.unionByName(one).groupBy(key).agg(
        F.max("count").alias("count"), F.sum("_total").alias("aggregated_count")
    )
