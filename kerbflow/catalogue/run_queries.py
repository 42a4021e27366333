"""Whole runs over a store: gaps between runs, late rows, and the rules of a refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.parking_queries import CAPACITY
from kerbflow.catalogue.standins import BASE_US, GRID_END, PARKING_START, ctes, parking_grid, table
from kerbflow.catalogue.storage_queries import store
from kerbflow.catalogue.traffic_queries import FACTS, rollup_select, rounded
from kerbflow.functions import times
from kerbflow.plans.runs import Jobs, RunWindow
from kerbflow.sources import schemas

# Quarter hours after the grid start at which the first parking run ends, and the second
# begins (on the hour).
_FIRST_END, _SECOND = 40, 87

_VISIBLE = (
    CAPACITY
    + f""",
run_times as (
  select {PARKING_START} + {_FIRST_END * times.BUCKET_US} as first_end, {PARKING_START} + {_SECOND * times.BUCKET_US} as again,
    {GRID_END} as run_end),
visible as (
  select o.* from occupancy o, run_times where since < first_end or (since >= again - 900000000 and since < run_end)),
last_before as (
  select parkingspotid, arg_max(occupancy, (since, occupancy)) as occupancy
  from occupancy, run_times where since < first_end
  and parkingzoneid in (select parkingzoneid from capacities) group by 1),
emitted as (
  select distinct parkingspotid from (
    select parkingspotid, parkingzoneid from occupancy, run_times where since >= again - 900000000 and since < run_end
    union all
    select s.parkingspotid, s.parkingzoneid from last_before l join spots s on l.parkingspotid = s.parkingspotid
    where l.occupancy) e
  where parkingzoneid in (select parkingzoneid from capacities)),
spine as (
  select parkingspotid, again + i * 900000000 as starttime, again + (i + 1) * 900000000 as endtime
  from emitted, run_times, (select unnest(range(1000)) as i) n where again + (i + 1) * 900000000 <= run_end)"""
)


@register(
    "parking_after_gap",
    _VISIBLE
    + """
select b.parkingspotid, cast(b.starttime as bigint) as starttime, coalesce(v.occupancy, false) as occupancy
from spine b asof left join visible v on b.parkingspotid = v.parkingspotid and b.endtime > v.since""",
)
def parking_after_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of a run that begins hours after the last one ended."""
    target = store(spark, "gap")
    for name, source in (
        ("parking_spot_historic", "occupancy"),
        ("parking_spot_current", "spots"),
        ("parking_zone_status", "zones"),
    ):
        target.replace(name, table(spark, sf_dir, source))
    jobs = Jobs(target)
    jobs.zone_groups(table(spark, sf_dir, "parking_groups"))
    grid = parking_grid(spark, sf_dir)
    start, width = grid.start_us, grid.width_us
    jobs.parking(RunWindow(start + 2 * width, start + _FIRST_END * width))
    jobs.parking(RunWindow(start + (_SECOND + 1) * width, grid.end_us))
    states = target.read("aggregation_parking_status")
    return states.filter(F.col("starttime") >= start + _SECOND * width).select("parkingspotid", "starttime", "occupancy")


_LATE = f"time // 1000 % 40 = 0 and time < {BASE_US + 20 * times.HOUR_US}"


@register(
    "late_touched_only",
    FACTS + rollup_select("15min", True) + "\nunion all by name" + rollup_select("1day", True),
)
def late_touched_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates of all but the late detections, then rebuilt where those touch them."""
    status = table(spark, sf_dir, "traffic_status")
    late = status.filter(F.expr(_LATE.replace("//", "div")))
    on_time = status.exceptAll(late)
    jobs = Jobs(store(spark, "late"))
    end = status.agg(F.max("time")).first()[0]
    window = RunWindow(BASE_US, (end or BASE_US) + 1)
    for run_s, rows in ((1, on_time), (2, late)):
        jobs.refresh("traffic_status", rows, window, run_s)
        jobs.late_traffic(rows, ("15min", "1day"))
    return rounded(jobs.store.read("aggregation_traffic_events"))


_DAY1 = BASE_US // times.SECOND_US
# Run time and end of the window of each run: the third is the one that rewrites two days.
_RUNS = ((23, 23), (24.5, 24.5), (25, 25), (36, 36))


def _hours(hours: float) -> int:
    return int(hours * times.HOUR_US)


_STAMPS = " ".join(
    f"when time >= {BASE_US + _hours(before) - times.MINUTE_US} then {_DAY1 + _hours(run) // times.SECOND_US}"
    for (_, before), (run, _) in reversed(list(zip(_RUNS, _RUNS[1:])))
)


@register(
    "refresh_samples",
    "with "
    + ctes("samples", "filters")
    + f""",
codes(sensor) as (values {", ".join(f"('{c}')" for c in schemas.SENSOR_CODES)})
select nodeid, sensor, time, value, cast(case {_STAMPS} else {_DAY1 + 23 * 3600} end as bigint) as ts,
  strftime(make_timestamp(time), '%Y-%m-%d') as startday
from samples where sensor in (select sensor from codes)
  and nodeid in (select obj from filters where type = 'connection_nodes')
  and time < {BASE_US + _hours(36)}""",
)
def refresh_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over two days: listed codes of connection nodes, days by the hour of the run."""
    target = store(spark, "samples")
    target.replace("aggregation_filters", table(spark, sf_dir, "filters"))
    jobs = Jobs(target)
    samples = table(spark, sf_dir, "samples")
    begin = BASE_US
    for run, until in _RUNS:
        window = RunWindow(begin, BASE_US + _hours(until))
        result = jobs.refresh("device_sensor_samples", samples, window, _DAY1 + _hours(run) // times.SECOND_US)
        begin = window.until_us
    return result
