"""Tables written under the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.parking_queries import CAPACITY, zone_capacity
from kerbflow.catalogue.standins import BASE_US, ctes, table
from kerbflow.functions import times
from kerbflow.operators import scans, versions
from kerbflow.plans import runs, warehouse
from kerbflow.session import scratch_path
from kerbflow.sources.control import ControlTable
from kerbflow.sources.store import TableStore

RUN_S = 1_704_200_000
_MARK_US = BASE_US + 22 * times.HOUR_US
_UNTIL_US = BASE_US + 36 * times.HOUR_US - times.SECOND_US  # of the pruned scan
_DAY = "strftime(make_timestamp({}), '%Y-%m-%d')"


def store(spark: SparkSession, label: str, fmt: str = "parquet") -> TableStore:
    return TableStore(spark, scratch_path(spark, label), fmt)


def _staged_alarms(spark: SparkSession, sf_dir: str, message: str | None = None) -> DataFrame:
    alarms = table(spark, sf_dir, "alarms").select(
        "nodeid", "alarmtype", "alarmdate", "dateuuid", "message"
    )
    if message:
        alarms = alarms.withColumn("message", F.lit(message))
    return warehouse.stage_utc(alarms, "alarmdate", "ms", RUN_S)


_STAGED = (
    "with "
    + ctes("alarms")
    + f""",
staged as (select nodeid, alarmtype, alarmdate, dateuuid, message, cast({RUN_S} as bigint) as ts,
  {_DAY.format("alarmdate * 1000")} as startday from alarms)"""
)


@register("stage_utc", _STAGED + "\nselect * from staged")
def stage_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged_alarms(spark, sf_dir)


_LOCAL = (
    "with "
    + ctes("sites", "ticks")
    + f""",
facts as (select 's' || user_id as siteid, k as n, time - time % 900000000 as starttime from ticks),
staged as (select f.siteid, n, starttime, starttime + 900000000 as endtime,
  strftime(make_timestamp(starttime), '%Y-%m-%d %H:%M') as startdt_utc,
  strftime(make_timestamp(starttime + 900000000), '%Y-%m-%d %H:%M') as enddt_utc,
  strftime(make_timestamp(starttime), '%Y-%m-%d %H') as starthr_utc,
  strftime(make_timestamp(starttime), '%Y-%m-%d') as startday_utc,
  strftime(timezone(time_zone, timezone('UTC', make_timestamp(starttime))), '%Y-%m-%d %H:%M:%S') as startdt,
  strftime(timezone(time_zone, timezone('UTC', make_timestamp(starttime + 900000000))),
    '%Y-%m-%d %H:%M:%S') as enddt,
  strftime(timezone(time_zone, timezone('UTC', make_timestamp(starttime))), '%Y-%m-%d %H') as starthr,
  cast({RUN_S} as bigint) as ts,
  strftime(timezone(time_zone, timezone('UTC', make_timestamp(starttime))), '%Y-%m-%d') as startday
  from facts f join sites s on f.siteid = s.siteid)"""
)


@register("stage_local", _LOCAL + "\nselect * from staged")
def stage_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = times.bucket_start(F.col("time"))
    facts = (
        table(spark, sf_dir, "ticks")
        .select(
            F.concat(F.lit("s"), "user_id").alias("siteid"),
            F.col("k").alias("n"),
            start.alias("starttime"),
            (start + F.lit(times.BUCKET_US)).alias("endtime"),
        )
        .withColumns(times.bucket_labels())
    )
    return warehouse.stage_local(facts, table(spark, sf_dir, "sites"), RUN_S)


@register("staging_append", _STAGED + "\nselect * from staged")
def staging_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "staging")
    staged = _staged_alarms(spark, sf_dir)
    first = F.col("alarmdate") < _MARK_US // 1000
    target.append("stg_device_alarms", staged.filter(first), by=["startday"])
    return target.append("stg_device_alarms", staged.filter(~first), by=["startday"])


@register(
    "scan_pruned",
    _STAGED
    + f"""
select * from staged where startday between {_DAY.format(f"cast({_MARK_US} as bigint)")} and '2024-01-03'
  and alarmdate >= {_MARK_US // 1000} and alarmdate < {_UNTIL_US // 1000}""",
)
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = store(spark, "pruned").append(
        "fs_device_alarms", _staged_alarms(spark, sf_dir), by=["startday"]
    )
    return scans.day_pruned_window(written, "alarmdate", "startday", _MARK_US, _UNTIL_US, unit_us=1000)


@register(
    "upsert_latest",
    _STAGED
    + f"""
select nodeid, alarmtype, alarmdate, dateuuid,
  case when alarmdate >= {_MARK_US // 1000} then 'late' else message end as message, ts, startday
from staged""",
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "upsert")
    keys = warehouse.FACT_TABLES["device_alarms"].keys
    until = (BASE_US + 30 * times.HOUR_US) // 1000
    target.upsert(
        "device_alarms", _staged_alarms(spark, sf_dir).filter(F.col("alarmdate") < until), keys
    )
    late = _staged_alarms(spark, sf_dir, "late").filter(F.col("alarmdate") >= _MARK_US // 1000)
    target.upsert("device_alarms", late, keys)
    return target.upsert("device_alarms", late, keys)


@register(
    "refresh_recent",
    _STAGED
    + f"""
select nodeid, alarmtype, alarmdate, dateuuid, case when alarmdate >= {_MARK_US // 1000} then 'again' else message end
  as message, cast(case when alarmdate >= {_MARK_US // 1000} then {RUN_S + 900} else ts end as bigint) as ts,
  startday from staged""",
)
def refresh_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "refresh")
    alarms = warehouse.FACT_TABLES["device_alarms"]
    warehouse.refresh_warehouse(target, alarms, _staged_alarms(spark, sf_dir))
    again = _staged_alarms(spark, sf_dir, "again").withColumn("ts", F.lit(RUN_S + 900).cast("long"))
    return warehouse.refresh_warehouse(
        target, alarms, again.filter(F.col("alarmdate") >= _MARK_US // 1000)
    )


_DAILY = (
    "with "
    + ctes("sites", "ticks")
    + f""",
daily as (select 's' || user_id as siteid, time - time % 86400000000 + 86400000000 as endtime,
  min(time - time % 900000000) as starttime, count(*) as n from ticks group by 1, 2)"""
)


@register(
    "refresh_moved_day",
    _DAILY
    + f"""
select d.siteid, d.endtime, starttime, n, cast({RUN_S + 900} as bigint) as ts,
  strftime(timezone(time_zone, timezone('UTC', make_timestamp(starttime))), '%Y-%m-%d') as startday
from daily d join sites s on d.siteid = s.siteid""",
)
def refresh_moved_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows whose first bucket comes late: at first from six hours on, then all.

    The first bucket decides the site-local day a row is filed under, so many rows move to
    the day before.
    """
    ticks = table(spark, sf_dir, "ticks").withColumn("siteid", F.concat(F.lit("s"), "user_id"))
    sites = table(spark, sf_dir, "sites")
    daily = warehouse.FactTable("daily", ("siteid", "endtime"), "starttime", local=True)
    target = store(spark, "moved")
    morning = F.col("time") % times.DAY_US < 6 * times.HOUR_US
    for run_s, seen in ((RUN_S, ticks.filter(~morning)), (RUN_S + 900, ticks)):
        period = times.bucket_start(F.col("time"), times.DAY_US) + F.lit(times.DAY_US)
        facts = seen.groupBy("siteid", period.alias("endtime")).agg(
            F.min(times.bucket_start(F.col("time"))).alias("starttime"), F.count("*").alias("n")
        )
        staged = warehouse.stage_local(facts.withColumns(times.bucket_labels()), sites, run_s)
        result = warehouse.refresh_warehouse(target, daily, staged)
    return result.select("siteid", "endtime", "starttime", "n", "ts", "startday")


@register(
    "append_or_replace",
    "with "
    + ctes("samples")
    + """
select nodeid, sensor, time, 'appended' as how from samples
union all select nodeid, sensor, time, 'appended' as how from samples where sensor = 'w'
union all select nodeid, sensor, time, 'replaced' as how from samples where sensor = 'mw'""",
)
def append_or_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "modes")
    samples = table(spark, sf_dir, "samples").select("nodeid", "sensor", "time")
    watt, milliwatt = (samples.filter(F.col("sensor") == s) for s in ("w", "mw"))
    target.append("appended", samples)
    appended = target.append("appended", watt)
    target.replace("replaced", samples)
    replaced = target.replace("replaced", milliwatt)
    return appended.withColumn("how", F.lit("appended")).unionByName(
        replaced.withColumn("how", F.lit("replaced"))
    )


@register(
    "dim_overwrite",
    "with " + ctes("sites") + "\nselect siteid, upper(name) as name, time_zone from sites",
)
def dim_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "dimension")
    sites = table(spark, sf_dir, "sites").select("siteid", "name", "time_zone")
    target.replace("fs_site", sites)
    return target.replace("fs_site", sites.withColumn("name", F.upper("name")))


@register(
    "snapshot_reload",
    CAPACITY
    + f"""
select siteid, orgid, parkinggroupid as groupid, parkingzoneid as zoneid, ptype as parkingtype,
  nullif(capacity, 0) as capacity, config, cast({RUN_S} as bigint) as ts from capacities""",
)
def snapshot_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = store(spark, "snapshot")
    zones = zone_capacity(spark, sf_dir)
    target.replace("fs_parking_zone_status", warehouse.zone_status_snapshot(zones, RUN_S - 3600))
    return target.replace(
        "fs_parking_zone_status", warehouse.zone_status_snapshot(zones, RUN_S)
    )


@register(
    "format_roundtrip",
    "with "
    + ctes("samples")
    + """
select s.*, f.fmt from samples s cross join (select unnest(['csv', 'orc', 'parquet']) as fmt) f""",
)
def format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples")
    copies = [
        store(spark, f"as-{fmt}", fmt).replace("samples", samples).withColumn("fmt", F.lit(fmt))
        for fmt in ("csv", "orc", "parquet")
    ]
    return copies[0].unionByName(copies[1]).unionByName(copies[2])


@register(
    "hwm_window",
    f"""
select event_id, user_id, value from events
where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-29 00:00:00'""",
)
def hwm_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog longer than the lag limit, worked off in two runs that miss no row."""
    marks = ControlTable(store(spark, "control"))
    marks.seed("events", runs.MARK_KEY, "2024-01-01 00:00")
    marks.put("events", runs.MARK_KEY, "2024-01-10 00:00", stamp=1)
    events = table(spark, sf_dir, "events")
    parts = []
    for _ in range(2):
        window = runs.run_window(
            times.epoch_us(marks.get("events", runs.MARK_KEY)),
            now_us=times.epoch_us("2024-01-29 00:00"),
            max_lag_us=12 * times.DAY_US,
        )
        parts.append(scans.time_window(events, "ts", window.from_us, window.until_us))
        marks.put("events", runs.MARK_KEY, runs.minute_text(window.until_us), stamp=window.until_us)
    return parts[0].unionByName(parts[1]).select("event_id", "user_id", "value")


@register(
    "late_overlap",
    "with "
    + ctes("traffic_status")
    + f"""
select nodeid, time, case when time >= {_MARK_US - 900_000_000} then 2 else 1 end as run_no, siteid
from traffic_status""",
)
def late_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = table(spark, sf_dir, "traffic_status").select("nodeid", "time", "siteid")
    overlap = warehouse.FACT_TABLES["traffic_status"].overlap_us
    begin, end = status.agg(F.min("time"), F.max("time") + 1).first()
    first = scans.time_window(status, "time", begin or 0, _MARK_US).withColumn("run_no", F.lit(1))
    second = scans.time_window(status, "time", _MARK_US, end or 0, overlap).withColumn(
        "run_no", F.lit(2)
    )
    return versions.upsert(first, second, ["nodeid", "time"])
