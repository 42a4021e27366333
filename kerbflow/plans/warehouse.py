"""Day-partitioned warehouse tables: stage, keep the latest version, retire old staging."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.functions.values import zero_as_null
from kerbflow.operators import scans, versions
from kerbflow.sources.day_versions import days_of
from kerbflow.sources.schemas import ALARM_CODES, SENSOR_CODES
from kerbflow.sources.store import DAY, TableStore

STAGING_PREFIX = "stg_"
WAREHOUSE_PREFIX = "fs_"
STAGING_DAYS = 3
CONNECTION_NODES = "connection_nodes"  # fixed value: a type in the filter table

LOCAL_COLUMNS = ("startdt", "enddt", "starthr", "startday")


@dataclass(frozen=True)
class FactTable:
    """How one fact table is staged and versioned.

    ``keys`` identify a row completely: versions are settled to one row per key, so a key
    that left out, say, the object class would lose rows.  ``time`` is in ``unit`` ("us" or
    "ms").  ``overlap_us`` is how far before the mark a
    run reads again to pick up late rows.  Tables with ``local`` get site-local display
    times and are partitioned by the site's own day.  ``day_reach`` is how many days
    apart the versions of one key can lie: a local row is filed under the local day of the
    first bucket seen in its UTC period, which differs by less than a day between versions.
    ``codes`` names a column and the values that are copied, ``connected_only`` restricts
    rows to connection nodes, and ``hourly_span`` rewrites only today, and yesterday too in
    the run at one o'clock.
    """

    name: str
    keys: tuple[str, ...]
    time: str
    unit: str = "us"
    overlap_us: int = times.MINUTE_US
    local: bool = False
    codes: tuple[str, tuple[str, ...]] | None = None
    connected_only: bool = False
    hourly_span: bool = False

    @property
    def day_reach(self) -> int:
        return 1 if self.local else 0


FACT_TABLES = {
    t.name: t
    for t in (
        FactTable("traffic_status", ("nodeid", "time"), "time", overlap_us=15 * times.MINUTE_US),
        FactTable(
            "parking_spot_historic",
            ("siteid", "parkingspotid", "since"),
            "since",
            overlap_us=5 * times.MINUTE_US,
        ),
        FactTable(
            "aggregation_parking_spot",
            ("parkingspotid", "starttime"),
            "starttime",
            overlap_us=times.HOUR_US,
            local=True,
        ),
        FactTable(
            "aggregation_traffic_events",
            ("siteid", "eventid", "aggregation_type", "type", "objectclass", "endtime"),
            "starttime",
            overlap_us=times.HOUR_US,
            local=True,
        ),
        FactTable(
            "aggregation_energy_savings_node",
            ("nodeid", "aggregation_type", "starttime"),
            "starttime",
            overlap_us=times.DAY_US,
            local=True,
        ),
        FactTable(
            "device_sensor_samples",
            ("nodeid", "sensor", "time"),
            "time",
            codes=("sensor", SENSOR_CODES),
            connected_only=True,
            hourly_span=True,
        ),
        FactTable(
            "device_alarms",
            ("nodeid", "alarmtype", "alarmdate", "dateuuid"),
            "alarmdate",
            unit="ms",
            codes=("alarmtype", ALARM_CODES),
            connected_only=True,
        ),
        FactTable("connection_status", ("nodeid", "since"), "since", unit="ms", connected_only=True),
        FactTable(
            "aggregation_connection_node",
            ("nodeid", "starttime"),
            "starttime",
            overlap_us=times.HOUR_US,
        ),
    )
}


def copied_rows(facts: DataFrame, table: FactTable, filters: DataFrame | None = None) -> DataFrame:
    """The rows of a fact table that are copied.

    ``filters`` is the filter table (type, obj), whose connection nodes restrict tables
    that ask for it; without it all nodes count.
    """
    if table.codes is not None:
        column, codes = table.codes
        facts = facts.filter(F.col(column).isin(*dict.fromkeys(codes)))
    if table.connected_only and filters is not None:
        nodes = filters.filter(F.col("type") == CONNECTION_NODES).select(F.col("obj").alias("nodeid"))
        facts = scans.only_keys(facts, "nodeid", nodes)
    return facts


def utc_day(time: Column, unit: str) -> Column:
    return times.day_label(time) if unit == "us" else times.day_of_millis(time)


def stage_utc(facts: DataFrame, time: str, unit: str, run_s: int) -> DataFrame:
    """Add the row stamp (run time in epoch seconds) and the UTC day partition."""
    stamp = F.lit(run_s).cast("long")
    return facts.withColumn("ts", stamp).withColumn(DAY, utc_day(F.col(time), unit))


def stage_local(
    facts: DataFrame, sites: DataFrame, run_s: int, start: str = "starttime", end: str = "endtime"
) -> DataFrame:
    """Add site-local display times and day; keep the UTC ones as ``*_utc``.

    ``sites`` has siteid and time_zone.  Facts of unknown sites are left out.
    """
    zone = F.col("time_zone")
    local_start = times.localize(F.col(start), zone)
    renamed = facts.withColumnsRenamed({c: f"{c}_utc" for c in LOCAL_COLUMNS})
    return (
        renamed.join(sites.select("siteid", "time_zone"), "siteid")
        .withColumns(
            {
                "startdt": local_start,
                "enddt": times.localize(F.col(end), zone),
                "starthr": F.substring(local_start, 1, 13),
                "ts": F.lit(run_s).cast("long"),
                DAY: F.substring(local_start, 1, 10),
            }
        )
        .drop("time_zone")
    )


def latest_version(staged: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest ``ts``, then the highest tie breakers.

    Without explicit tie breakers the whole remaining row decides, so that the choice
    does not depend on file or task order.
    """
    rest = ties or [c for c in staged.columns if c not in {*keys, "ts"}]
    newest_first = [F.col("ts").desc(), *(F.col(c).desc() for c in rest)]
    return versions.latest_per_key(staged, keys, newest_first)


def refresh_span(run_s: int) -> list[str]:
    """Days a run rewrites: yesterday and today at one o'clock UTC, else today."""
    now = datetime.fromtimestamp(run_s, timezone.utc)
    today, yesterday = (f"{now - timedelta(days=k):%Y-%m-%d}" for k in (0, 1))
    return [yesterday, today] if now.hour == 1 else [today]


def days_around(days: Sequence[str], reach: int) -> list[str]:
    """The days and those up to ``reach`` before and after each."""
    shifts = [timedelta(days=k) for k in range(-reach, reach + 1)]
    return sorted({f"{date.fromisoformat(day) + shift}" for day in days for shift in shifts})


def refresh_warehouse(
    store: TableStore, table: FactTable, batch: DataFrame, days: Sequence[str] | None = None
) -> DataFrame:
    """Append a staged batch, then rewrite the warehouse days it touched.

    Every rewritten day is settled from its staged rows and the rows it already holds, so
    replaying a batch changes nothing and days whose staging was retired lose nothing.
    ``days`` restricts the rewrite to these days and their neighbours; staging keeps the
    rest for later.

    Where a new version of a row can lie on another day than the one it replaces, the
    days around the touched ones are rewritten too, settled with the days around those, so
    every key that is rewritten is seen with all its versions and stays in one day.  A day
    that has lost all its rows is removed.  Touched days come to the driver as labels and
    prune the partitions that are read.
    """
    staging, name = STAGING_PREFIX + table.name, WAREHOUSE_PREFIX + table.name
    store.append(staging, batch, by=[DAY])
    touched = days_of(batch) if days is None else list(days)
    rewritten = days_around(touched, table.day_reach)
    seen = F.col(DAY).isin(*days_around(touched, 2 * table.day_reach))
    # Read with the batch's schema, so that the day column is not inferred as a date.
    recent = store.read(staging, batch.schema).filter(seen)
    if store.exists(name):
        recent = recent.unionByName(store.read(name, batch.schema).filter(seen))
    current = latest_version(recent, table.keys).filter(F.col(DAY).isin(*rewritten))
    if not table.day_reach or not rewritten:
        return store.overwrite_days(name, current)
    kept = Observation()
    counts = [F.count_if(F.col(DAY) == day).alias(day) for day in rewritten]
    store.overwrite_days(name, current.observe(kept, *counts))
    held = kept.get
    store.drop_days(name, [day for day in rewritten if not held[day]])
    return store.read(name, batch.schema)


def retained(staged: DataFrame, first_kept: str) -> DataFrame:
    """Staged rows whose day is not yet retired."""
    return staged.filter(F.col(DAY) >= F.lit(first_kept))


def snapshot(rows: DataFrame, run_s: int, null_if_zero: Sequence[str] = ()) -> DataFrame:
    """A full snapshot stamped with the run time."""
    cleaned = {c: zero_as_null(F.col(c)) for c in null_if_zero}
    return rows.withColumns({**cleaned, "ts": F.lit(run_s).cast("long")})


def zone_status_snapshot(capacity: DataFrame, run_s: int) -> DataFrame:
    """The parking zone table: capacity 0 becomes null."""
    columns = capacity.select(
        "siteid",
        "orgid",
        F.col("parkinggroupid").alias("groupid"),
        F.col("parkingzoneid").alias("zoneid"),
        F.col("ptype").alias("parkingtype"),
        "capacity",
        "config",
    )
    return snapshot(columns, run_s, null_if_zero=["capacity"])
