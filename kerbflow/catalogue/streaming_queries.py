"""Streams drained once, compared with their batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.parking_queries import prior_states
from kerbflow.catalogue.standins import BENCHMARK_TABLES, PARKING_SIZE, PARKING_START, ctes, parking_grid, table
from kerbflow.functions import times
from kerbflow.session import scratch_path
from kerbflow.streaming import carry, keyed_state, tumbling
from kerbflow.streaming.resumable import Pace, WindowTable, count_and_extremes, paced_stream

FEEDS = 3
LATE_EVERY = 50  # of the first feed's events one in so many comes with the last feed


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling.file_stream(spark, sf_dir, BENCHMARK_TABLES["events"], "events.parquet")


@register(
    "stream_tumbling",
    "with "
    + ctes("ticks")
    + """
select event_type, time - time % 900000000 as starttime, time - time % 900000000 + 900000000 as endtime,
  count(*) as eventcnt, round(sum(value), 4) as total, min(value) as low, max(value) as high
from ticks group by 1, 2""",
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = table(spark, sf_dir, "ticks", given={"events": event_stream(spark, sf_dir)})
    counts = tumbling.run_tumbling(ticks, "time", ["event_type"], "value")
    return counts.withColumn("total", F.round("total", 4))


def _carried_sql(spots: str) -> str:
    """End-of-bucket states of some spots by an as-of join."""
    return (
        "with "
        + ctes("occupancy", "spots", "bounds")
        + f""",
spine as (select parkingspotid, {PARKING_START} + r.i * 900000000 as starttime,
    {PARKING_START} + (r.i + 1) * 900000000 as endtime from ({spots}) o
  cross join (select unnest(range({PARKING_SIZE})) as i) r),
latest as (
  select b.parkingspotid, b.starttime, s.occupancy from spine b asof left join occupancy s
    on b.parkingspotid = s.parkingspotid and b.endtime > s.since)
select l.parkingspotid, cast(starttime as bigint) as starttime,
  coalesce(l.occupancy, cast(substr(p.parkingspotid, 2) as bigint) % 3 = 0, false) as occupancy
from latest l left join spots p on l.parkingspotid = p.parkingspotid"""
    )


@register("state_carry", _carried_sql("select distinct parkingspotid from occupancy"))
def state_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "occupancy", given={"events": event_stream(spark, sf_dir)})
    return carry.run_state_carry(changes, prior_states(spark, sf_dir), parking_grid(spark, sf_dir))


def _fed(rows: DataFrame, time: str, late_if: str = "false") -> list[DataFrame]:
    """The rows in feeds, by equal stretches of time; some of the first feed come last."""
    first, last = rows.agg(F.min(time), F.max(time)).first()
    if first is None:
        return [rows]
    feed = F.floor((F.col(time) - F.lit(first)) * FEEDS / F.lit(last - first + 1))
    numbered = rows.withColumn("_feed", F.when((feed == 0) & F.expr(late_if), FEEDS - 1).otherwise(feed))
    return [numbered.where(F.col("_feed") == k).drop("_feed") for k in range(FEEDS)]


@register(
    "stream_resumed",
    "with "
    + ctes("ticks")
    + """
select event_type, time - time % 900000000 as starttime, time - time % 900000000 + 900000000 as endtime,
  count(*) as eventcnt, round(sum(value), 4) as total, min(value) as low, max(value) as high
from ticks group by 1, 2""",
)
def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds, each drained by a run of its own from the same checkpoint; rows of the
    first feed's windows still come with the last one."""
    ticks = table(spark, sf_dir, "ticks").select("event_id", "event_type", "time", "value")
    source, path, checkpoint = (scratch_path(spark, f"resumed-{x}") for x in ("in", "windows", "progress"))
    windows = WindowTable(spark, path, checkpoint, ["event_type"], "time", count_and_extremes("value"), pace=Pace(max_files=4))
    for feed in _fed(ticks, "time", f"event_id % {LATE_EVERY} = 0"):
        feed.write.mode("append").parquet(source)
        result = windows.run(paced_stream(spark, source, ticks.schema, windows.pace))
    return result.withColumn("total", F.round("total", 4))


@register(
    "state_carry_stream",
    _carried_sql("select parkingspotid from occupancy union select parkingspotid from spots"),
)
def state_carry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds and a last tick, each drained by a run that goes on from the state before."""
    grid = parking_grid(spark, sf_dir)
    changes = table(spark, sf_dir, "occupancy").select("parkingspotid", "since", "occupancy")
    source, path, checkpoint = (scratch_path(spark, f"carried-{x}") for x in ("in", "states", "progress"))
    # A row without a spot, late enough to close all buckets of the grid.
    tick = spark.range(1).select(
        F.lit(None).cast("string").alias("parkingspotid"),
        F.lit(grid.end_us + times.HOUR_US).alias("since"),
        F.lit(None).cast("boolean").alias("occupancy"),
    )
    for feed in [*_fed(changes, "since"), tick]:
        feed.write.mode("append").parquet(source)
        stream = paced_stream(spark, source, changes.schema)
        states = keyed_state.run_carried(stream, prior_states(spark, sf_dir), grid.start_us, path, checkpoint)
    return states
