"""Rebuilding only what late rows change.

Late rows name the sites and buckets whose facts they touch; from these follow the periods
of each grain.  Raw rows of those periods are read, by literal days and a join on the
touched keys, and the periods' aggregates are put in place of the stored ones, so that
aggregates whose rows are gone (a transition that another row now splits) go too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.plans import traffic
from kerbflow.sources.day_versions import days_of
from kerbflow.sources.store import DAY, TableStore


def touched_buckets(late: DataFrame, keys: Sequence[str], time: str, ahead: int = 0) -> DataFrame:
    """Distinct keys and bucket starts of some rows, and of ``ahead`` buckets behind each.

    Rows without a time touch nothing.
    """
    own = times.bucket_start(F.col(time))
    reached = F.array(*(own + F.lit(k * times.BUCKET_US) for k in range(ahead + 1)))
    timed = late.where(F.col(time).isNotNull())
    return timed.select(*keys, F.explode(reached).alias("bucket")).distinct()


def touched_periods(buckets: DataFrame, keys: Sequence[str], width_us: int) -> DataFrame:
    return buckets.select(*keys, times.bucket_start(F.col("bucket"), width_us).alias("period")).distinct()


def rows_of_periods(
    rows: DataFrame, periods: DataFrame, keys: Sequence[str], time: str, width_us: int, before: int = 0
) -> DataFrame:
    """The rows of some keys and periods, and of ``before`` buckets ahead of each period.

    ``rows`` is partitioned by the UTC day of ``time``; other days are not opened.
    """
    shift = F.array(*(F.col("period") - F.lit(k * times.BUCKET_US) for k in range(before + 1)))
    # Each wanted bucket once per key, so that the join keeps the number of rows.
    step = F.sequence(F.array_min(shift), F.col("period") + F.lit(width_us - times.BUCKET_US), F.lit(times.BUCKET_US))
    wanted = periods.select(*keys, F.explode(step).alias("_bucket")).distinct()
    days = days_of(wanted.select(times.day_label(F.col("_bucket")).alias(DAY)))
    placed = rows.filter(F.col(DAY).isin(*days)).withColumn("_bucket", times.bucket_start(F.col(time)))
    return placed.join(wanted, [*keys, "_bucket"], "left_semi").drop("_bucket")


def replace_periods(
    store: TableStore, name: str, rebuilt: DataFrame, touched: DataFrame, on: Sequence[str], days: Sequence[str]
) -> DataFrame:
    """Put rebuilt aggregates in place of all stored ones with a touched ``on``.

    ``days`` are the day partitions they lie in; no other is read or written.
    """
    if store.exists(name):
        stored = store.read(name, rebuilt.schema).filter(F.col(DAY).isin(*days))
        rebuilt = rebuilt.unionByName(stored.join(touched, list(on), "left_anti"))
    return store.overwrite_days(name, rebuilt)


def rebuild_traffic(
    store: TableStore, status: DataFrame, late: DataFrame, grains: Sequence[str] = tuple(traffic.GRAINS)
) -> None:
    """Bring the traffic aggregates up to date with late detections.

    ``status`` holds all detections by UTC day, the late ones among them.  A detection
    changes the facts of its bucket and, by transitions, of the next; a bucket's facts need
    the bucket before.  Aggregates of one site are built from all its nodes.
    """
    keys = ["siteid"]
    buckets = touched_buckets(late, keys, "time", ahead=1)
    for grain in grains:
        width = traffic.GRAINS[grain]
        periods = touched_periods(buckets, keys, width)
        rows = rows_of_periods(status, periods, keys, "time", width, before=1)
        facts = traffic.traffic_facts(rows).withColumn("period", times.bucket_start(F.col("starttime"), width))
        facts = facts.join(periods, [*keys, "period"], "left_semi").drop("period")
        days = days_of(periods.select(times.day_label(F.col("period")).alias(DAY)))
        touched = periods.select(
            *keys, F.lit(grain).alias("aggregation_type"), (F.col("period") + F.lit(width)).alias("endtime")
        )
        for by_event, name in ((True, "aggregation_traffic_events"), (False, "aggregation_traffic_events_site")):
            rolled = traffic.rollup(facts, grain, by_event)
            replace_periods(store, name, rolled, touched, ["siteid", "aggregation_type", "endtime"], days)
