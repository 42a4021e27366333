"""One incremental run of each job: window, compute once, write every output, move the mark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.operators import counters, scans, sequences, versions
from kerbflow.operators.grids import Grid
from kerbflow.plans import capacity, dimensions, energy, parking, recompute, traffic, warehouse
from kerbflow.session import remove_path, scratch_path
from kerbflow.sources.control import ControlTable
from kerbflow.sources.schemas import NULL_DEFAULTS, schema_of
from kerbflow.sources.store import DAY, TableStore

# Names in the control table.
MARK_KEY = "last_agg_min"
LAG_LIMIT_KEY = "hwmlimitmins"
ZERO_POWER_KEY = "threshold_zero_power"
INTERVAL_KEY = "power_sampling_interval_sec"

GRAINS = tuple(traffic.GRAINS)
DAY_STATES = "parking_day_state"  # states of spots at the start of days


@dataclass(frozen=True)
class RunWindow:
    """Half-open window ``[from_us, until_us)``; partial runs do not move the mark."""

    from_us: int
    until_us: int
    partial: bool = False


def run_window(
    mark_us: int,
    now_us: int,
    max_lag_us: int | None = None,
    start_us: int | None = None,
    until_us: int | None = None,
    only_key: bool = False,
) -> RunWindow:
    """Window from the last mark to now.

    With ``max_lag_us`` a run covers at most so much time after the mark, so a backlog is
    worked off in several runs and no row is skipped.  Fixed bounds or a single key make
    the run partial.
    """
    if max_lag_us is not None:
        now_us = min(now_us, mark_us + max_lag_us)
    partial = only_key or start_us is not None or until_us is not None
    return RunWindow(
        mark_us if start_us is None else start_us,
        now_us if until_us is None else until_us,
        partial,
    )


def traffic_start(mark_us: int, daily: bool) -> int:
    """Top of the hour, or midnight of the day before for daily rollups."""
    if daily:
        return mark_us - mark_us % times.DAY_US - times.DAY_US
    return mark_us - mark_us % times.HOUR_US


def energy_grid(mark_us: int, until_us: int) -> Grid:
    """Grid from midnight of the day before the mark."""
    return Grid(mark_us - mark_us % times.DAY_US - times.DAY_US, until_us)


def parking_grid(mark_us: int, until_us: int, buckets_back: int = 1) -> Grid:
    """Grid from the last bucket start before the mark (moved back for late rows); a mark on
    the hour starts the grid itself."""
    from_us = mark_us - buckets_back * times.BUCKET_US
    if from_us % times.HOUR_US:
        from_us -= 1  # on a later quarter the grid starts one bucket early
    return Grid(from_us - from_us % times.BUCKET_US, until_us)


def minute_text(us: int) -> str:
    """Driver-side twin of ``times.minute_label`` for marks."""
    return f"{datetime.fromtimestamp(us // times.SECOND_US, timezone.utc):%Y-%m-%d %H:%M}"


def day_span(from_us: int, until_us: int) -> tuple[str, str]:
    """First and last UTC day label of a window, for pruning stored partitions."""
    first, last = (
        datetime.fromtimestamp(us // times.SECOND_US, timezone.utc) for us in (from_us, until_us)
    )
    return f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}"


def with_day(facts: DataFrame) -> DataFrame:
    """Aggregates carry ``startday`` already; raw facts get it from their time."""
    return facts if DAY in facts.columns else facts.withColumn(DAY, times.day_label(F.col("starttime")))


class Jobs:
    """The four jobs over one store.

    The current time is always passed in, so a run can be repeated with the same result.
    ``only`` restricts a run to one node (traffic) or site (parking, energy); such a run
    never moves the mark and never writes a grain wider than its key.
    """

    def __init__(self, store: TableStore, shared_parameters: str = "warehouse"):
        """``shared_parameters`` is the control-table type that holds the lag limit."""
        self.store = store
        self.shared_parameters = shared_parameters
        self.spark = store.spark
        self.control = ControlTable(store)

    def mark(self, job: str, now_us: int) -> int:
        """The job's high-water mark; an hour ago if it never ran."""
        self.control.seed(job, MARK_KEY, minute_text(now_us - times.HOUR_US))
        return times.epoch_us(self.control.get(job, MARK_KEY))

    def move_mark(self, job: str, window: RunWindow) -> None:
        if not window.partial:
            self.control.put(job, MARK_KEY, minute_text(window.until_us), stamp=window.until_us)

    def window(
        self,
        job: str,
        now_us: int,
        start_us: int | None = None,
        until_us: int | None = None,
        only_key: bool = False,
    ) -> RunWindow:
        """The next window of a job; the stored lag limit caps how much time it covers."""
        limit = self.control.get(self.shared_parameters, LAG_LIMIT_KEY)
        max_lag_us = None if limit == "na" else int(limit) * times.MINUTE_US
        mark_us = self.mark(job, now_us)
        return run_window(mark_us, now_us, max_lag_us, start_us, until_us, only_key)

    def energy_rules(self) -> energy.EnergyRules:
        """Rules from the control table, which is seeded with the defaults."""
        defaults = energy.EnergyRules()
        self.control.seed("energy", INTERVAL_KEY, str(defaults.interval_s))
        self.control.seed("energy", ZERO_POWER_KEY, str(defaults.zero_watts))
        return energy.EnergyRules(
            int(self.control.get("energy", INTERVAL_KEY)),
            float(self.control.get("energy", ZERO_POWER_KEY)),
        )

    @contextmanager
    def _scratch(self) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
        """A function that writes a frame several outputs share and reads it back.

        Outputs then start from a table in the shared folder: nothing is computed twice,
        and lost executors cost a re-read.  The tables are removed once the run has
        succeeded; a failed run leaves them for recovery.
        """
        paths: list[str] = []

        def written(df: DataFrame, label: str) -> DataFrame:
            path = scratch_path(self.spark, label)
            paths.append(path)
            df.write.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        yield written
        for path in paths:
            remove_path(self.spark, path)

    def _input(
        self, name: str, time: str, from_us: int, until_us: int, lookback_us: int = 0
    ) -> DataFrame:
        """An input table's rows in a window; day partitions are pruned where it has them."""
        rows = self.store.read_input(name, schema_of(name))
        if DAY in rows.columns:
            return scans.day_pruned_window(rows, time, DAY, from_us, until_us, lookback_us)
        return scans.time_window(rows, time, from_us, until_us, lookback_us)

    def traffic(
        self,
        window: RunWindow,
        daily: bool = False,
        keep_facts: bool = False,
        only: str | None = None,
    ) -> None:
        start = traffic_start(window.from_us, daily)
        # The bucket before is read too, for transitions that began in it.
        status = self._input("traffic_status", "time", start, window.until_us, times.BUCKET_US)
        if only is not None:
            window = replace(window, partial=True)
            status = status.filter(F.col("nodeid") == only)
        with self._scratch() as written:
            facts = traffic.traffic_facts(status).filter(F.col("eventtime") >= start)
            facts = written(facts, "traffic-facts")
            if keep_facts:
                self.store.append("job_traffic_events", with_day(facts), by=[DAY])
            grains = ("15min", "1hr", "1day") if daily else ("15min", "1hr")
            for by_event, table in ((True, "aggregation_traffic_events"), (False, "aggregation_traffic_events_site")):
                if only is not None and not by_event:
                    continue  # one node's facts are not the site's
                keys = ["siteid", *(["eventid"] if by_event else []), "type", "objectclass"]
                self.store.upsert(
                    table,
                    traffic.rollup_all(facts, by_event, grains),
                    # The period's own end: its first bucket with rows may still change.
                    [*keys, "aggregation_type", "endtime"],
                    days=day_span(start, window.until_us),
                )
            self.move_mark("traffic", window)

    def energy(
        self,
        window: RunWindow,
        rules: energy.EnergyRules | None = None,
        only: str | None = None,
        levels: Sequence[int] = sequences.LEVELS,
    ) -> None:
        """``levels`` cut the time lines of meters; ``sequences.DENSE_LEVELS`` suits meters
        with many samples a second."""
        rules = rules or self.energy_rules()
        grid = energy_grid(window.from_us, window.until_us)
        samples = self._input(
            "device_sensor_samples", "time", grid.start_us, window.until_us, rules.lookback_us
        )
        settings = self.store.read("device_energy_settings", schema_of("device_energy_settings"))
        if only is not None:
            window = replace(window, partial=True)
            settings = settings.filter(F.col("siteid") == only)
            samples = scans.only_keys(samples, "nodeid", settings)
        with self._scratch() as written:
            buckets = written(energy.node_15min(samples, settings, grid, rules, levels=levels), "energy-buckets")
            node = buckets
            site = energy.site_rollup(buckets, "15min")
            for grain in ("1hr", "1day"):
                node = node.unionByName(energy.node_rollup(buckets, grain))
                site = site.unionByName(energy.site_rollup(buckets, grain))
            for table, facts, keys in (
                ("aggregation_energy_savings_node", node, ["siteid", "nodeid"]),
                ("aggregation_energy_savings_site", site, ["siteid"]),
            ):
                self.store.upsert(
                    table,
                    facts,
                    [*keys, "aggregation_type", "starttime"],
                    days=day_span(grid.start_us, grid.end_us),
                )
            self.move_mark("energy", window)

    def parking(self, window: RunWindow, buckets_back: int = 1, only: str | None = None) -> None:
        grid = parking_grid(window.from_us, window.until_us, buckets_back)
        events = self._input(
            "parking_spot_historic", "since", grid.start_us, window.until_us, grid.width_us
        )
        spots = self.store.read_input("parking_spot_current", schema_of("parking_spot_current"))
        areas = self.store.read_input("parking_zone_status", schema_of("parking_zone_status"))
        if only is not None:
            window = replace(window, partial=True)
            areas = areas.filter(F.col("siteid") == only)
        with self._scratch() as written:
            zones = written(capacity.zone_capacity(areas, spots), "zone-capacity")
            prior = written(self.states_before(grid.start_us), "parking-prior")
            bridge = self.store.read("parking_zone_group", schema_of("parking_zone_group"))
            spot = written(parking.spot_15min(events, prior, spots, zones, bridge, grid), "parking-spots")
            zone = written(parking.zone_rollup(spot), "parking-zones")
            outputs: Sequence[tuple[str, DataFrame, list[str]]] = (
                ("aggregation_parking_status", with_day(parking.end_states(spot)), ["parkingspotid"]),
                ("aggregation_parking_spot", spot.drop("occupancy", "capacity"), ["parkingspotid"]),
                ("aggregation_parking_zone", zone, ["zoneid", "siteid"]),
                (
                    "aggregation_parking_group",
                    parking.area_rollup(zone, "groupid"),
                    ["groupid", "parkingtype", "siteid"],
                ),
                ("aggregation_parking_site", parking.area_rollup(zone, "siteid"), ["siteid", "parkingtype"]),
            )
            for table, facts, keys in outputs:
                self.store.upsert(
                    table, facts, [*keys, "starttime"], days=day_span(grid.start_us, grid.end_us)
                )
            self._keep_day_states(prior, parking.end_states(spot), grid)
            self.move_mark("parking", window)

    def states_before(self, start_us: int) -> DataFrame:
        """The last known state of each spot before a bucket start, however long ago.

        The states at the start of a day hold all that was known then, so only the newest
        such day and the states stored since are read; partitions are pruned by literals.
        """
        day = day_span(start_us, start_us)[0]
        starts = [d for d in self.store.days(DAY_STATES) if d <= day]
        schema = schema_of("aggregation_parking_status").add(DAY, "string")
        states = self.store.read_or_empty("aggregation_parking_status", schema).filter(
            (F.col(DAY) <= day) & (F.col("starttime") < start_us)
        )
        if starts:
            newest = max(starts)
            states = states.filter(F.col(DAY) >= newest)
            states = states.unionByName(self.store.read(DAY_STATES, schema).filter(F.col(DAY) == newest))
        return versions.latest_per_key(
            states.drop(DAY), ["parkingspotid"], [F.col("starttime").desc(), F.col("occupancy").desc()]
        )

    def _keep_day_states(self, prior: DataFrame, states: DataFrame, grid: Grid) -> None:
        """Store the states at the start of each day that begins in the grid.

        A run over days that were stored before replaces them, as late rows may have
        changed what they say.
        """
        known = prior.select(*states.columns).unionByName(states)
        first = -(-grid.start_us // times.DAY_US) * times.DAY_US
        parts = [
            versions.latest_per_key(
                known.filter(F.col("starttime") < midnight),
                ["parkingspotid"],
                [F.col("starttime").desc(), F.col("occupancy").desc()],
            ).withColumn(DAY, F.lit(day_span(midnight, midnight)[0]))
            for midnight in range(first, grid.end_us + 1, times.DAY_US)
        ]
        for part in parts:
            self.store.overwrite_days(DAY_STATES, part)

    def refresh(
        self, name: str, source: DataFrame, window: RunWindow, run_s: int, sites: DataFrame | None = None
    ) -> DataFrame:
        """Copy one fact table's new and late rows into the warehouse.

        Codes, the connection nodes of the stored filter table, and the days a run may
        rewrite follow the table's rules; days that are left out wait in staging.
        """
        table = warehouse.FACT_TABLES[name]
        filters = None
        if table.connected_only and self.store.exists("aggregation_filters"):
            filters = self.store.read("aggregation_filters", schema_of("aggregation_filters"))
        source = warehouse.copied_rows(source, table, filters)
        rows = scans.time_window(
            source,
            table.time,
            window.from_us,
            window.until_us,
            table.overlap_us,
            unit_us=1 if table.unit == "us" else 1000,
        )
        if table.local:
            if sites is None:
                raise ValueError(f"{name} needs the site dimension for local times")
            batch = warehouse.stage_local(rows, sites, run_s)
        else:
            batch = warehouse.stage_utc(rows, table.time, table.unit, run_s)
        days = warehouse.refresh_span(run_s) if table.hourly_span else None
        with self._scratch() as written:
            return warehouse.refresh_warehouse(self.store, table, written(batch, name), days)

    def late_traffic(self, late: DataFrame, grains: Sequence[str] = GRAINS) -> None:
        """Rebuild the traffic aggregates that late detections change.

        ``late`` are detections that the warehouse already holds.
        """
        defaults = NULL_DEFAULTS["traffic_status"]
        status = self.store.read(
            f"{warehouse.WAREHOUSE_PREFIX}traffic_status",
            schema_of("traffic_status").add(DAY, "string"),
        )
        with self._scratch() as written:
            named = written(scans.with_defaults(late, defaults).select("siteid", "time"), "late-traffic")
            recompute.rebuild_traffic(self.store, scans.with_defaults(status, defaults), named, grains)

    def update_counters(self, events: DataFrame, window: RunWindow) -> DataFrame:
        """Add the window's events to the running totals per detection event.

        An event id that is first seen in the window starts a total of its own.
        """
        name = "traffic_current_status"
        totals = self.store.read_input(name, schema_of(name))
        fresh = scans.time_window(events, "time", window.from_us, window.until_us)
        merged = counters.merged_counter(
            totals, fresh, "trafficdetectioneventid", "time", window.from_us
        ).select(*totals.columns)
        with self._scratch() as written:
            # The table is read and replaced, so the new rows are written elsewhere first.
            return self.store.replace(name, written(merged, name))

    def snapshots(self, run_s: int) -> None:
        """Reload the zone and spot snapshots."""
        spots = self.store.read_input("parking_spot_current", schema_of("parking_spot_current"))
        zones = self.store.read_input("parking_zone_status", schema_of("parking_zone_status"))
        held = capacity.zone_capacity(zones, spots)
        prefix = warehouse.WAREHOUSE_PREFIX
        self.store.replace(
            f"{prefix}parking_zone_status", warehouse.zone_status_snapshot(held, run_s)
        )
        self.store.replace(f"{prefix}parking_spot", warehouse.snapshot(spots, run_s))

    def energy_settings(self, site_fixture: DataFrame, fixtures: DataFrame, fixture_node: DataFrame) -> DataFrame:
        """Replace the settings table that energy runs read, one row per node."""
        paths = dimensions.fixture_paths(site_fixture, fixtures, fixture_node)
        return self.store.replace("device_energy_settings", dimensions.node_energy_settings(paths))

    def zone_groups(self, parking_groups: DataFrame) -> DataFrame:
        """Replace the bridge from zones to groups that parking runs read."""
        return self.store.replace("parking_zone_group", dimensions.zone_group_bridge(parking_groups))

    def copy_dimensions(self, tables: dict[str, DataFrame]) -> None:
        """Replace the given dimensions; a missing table is created."""
        for name, rows in tables.items():
            self.store.replace(warehouse.WAREHOUSE_PREFIX + name, rows)

    def retire_staging(self, name: str, today: str, keep_days: int = warehouse.STAGING_DAYS) -> list[str]:
        """Drop a table's staged days older than ``keep_days`` before ``today``."""
        first_kept = datetime.strptime(today, "%Y-%m-%d") - timedelta(days=keep_days)
        return self.store.drop_days_before(
            warehouse.STAGING_PREFIX + name, f"{first_kept:%Y-%m-%d}"
        )
