"""Occupancy changes to per-spot bucket occupancy, then zone, group and site rollups.

Occupied time is an associative summary: slices of a spot's time line are summarised
first (so a busy spot spreads over many tasks), slices are merged to buckets, and the
last state of a bucket is carried over the empty buckets behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.functions.values import zero_as_null
from kerbflow.operators import scans
from kerbflow.operators.grids import Grid, emit_spans, spread_by_key, with_spans

SLICES = 15  # of a bucket, summed up on their own first


def silent_occupied(events: DataFrame, prior: DataFrame, spots: DataFrame, grid: Grid) -> DataFrame:
    """An occupied row at the grid start for spots that were occupied and sent nothing."""
    carried = scans.without_keys(prior.filter("occupancy"), "parkingspotid", events)
    return carried.join(spots.select("parkingspotid", "parkingzoneid"), "parkingspotid").select(
        "parkingspotid",
        F.lit(grid.start_us).alias("since"),
        F.lit(True).alias("occupancy"),
        "parkingzoneid",
    )


def _slice_summary(events: DataFrame, grid: Grid, slices: int) -> DataFrame:
    """Occupied time and turnovers between the rows of each (spot, slice)."""
    slice_us = grid.width_us // slices
    order = Window.partitionBy("parkingspotid", "slice").orderBy("since", "occupancy")
    before = F.lag("occupancy").over(order)
    following = F.lead("since").over(order)
    sliced = times.bucket_start(F.col("since"), slice_us, grid.start_us)
    paired = (
        events.withColumn("bucket", grid.index(F.col("since")))
        .withColumn("slice", sliced)
        .repartition("parkingspotid", "slice")
        .withColumns(
            {
                "held": F.when(F.col("occupancy"), F.coalesce(following - F.col("since"), F.lit(0)))
                .otherwise(F.lit(0)),
                "turned": F.when(F.col("occupancy") & ~before, 1).otherwise(0),
            }
        )
    )
    moment = F.struct("since", "occupancy")
    return paired.groupBy("parkingspotid", "bucket", "slice").agg(
        F.min(moment).alias("first"),
        F.max(moment).alias("last"),
        F.min_by("parkingzoneid", "since").alias("parkingzoneid"),
        F.sum("held").alias("held"),
        F.sum("turned").alias("turned"),
    )


def _merge_slices(slices: DataFrame) -> DataFrame:
    """Slices of a bucket merged; the stretch between two slices keeps the earlier state."""
    order = Window.partitionBy("parkingspotid", "bucket").orderBy("slice")
    before = F.lag("last").over(order)
    bridge = F.when(before["occupancy"], F.col("first.since") - before["since"]).otherwise(0)
    turn = F.when(F.col("first.occupancy") & ~before["occupancy"], 1).otherwise(0)
    # One shuffle by spot serves this window, the grouping and the carry that follows.
    by_spot = spread_by_key(slices, "parkingspotid")
    return (
        by_spot.withColumns({"bridge": bridge, "turn": turn})
        .groupBy("parkingspotid", "bucket")
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.min_by("parkingzoneid", "slice").alias("parkingzoneid"),
            F.sum(F.col("held") + F.col("bridge")).alias("held"),
            F.sum(F.col("turned") + F.col("turn")).alias("turned"),
        )
    )


def spot_spans(
    events: DataFrame, prior: DataFrame, grid: Grid, slices: int = SLICES
) -> DataFrame:
    """Per spot and bucket with rows: the bucket's summary and the state it begins with.

    ``events`` carries parkingspotid, since, occupancy and parkingzoneid; ``prior`` the
    state at the end of the bucket before the grid.  Rows before the grid only set the
    state.  The zone is the one of the spot's first row.
    """
    merged = _merge_slices(_slice_summary(events, grid, slices))
    order = Window.partitionBy("parkingspotid").orderBy("bucket")
    initial = prior.select("parkingspotid", F.col("occupancy").alias("initial"))
    states = (
        merged.join(initial, "parkingspotid", "left")
        .withColumn(
            "state_in",
            F.coalesce(F.lag("last.occupancy").over(order), F.col("initial"), F.lit(False)),
        )
        .withColumn("parkingzoneid", F.first("parkingzoneid").over(order))
    )
    return with_spans(states, ["parkingspotid"], "bucket", grid)


def spot_buckets(spans: DataFrame, grid: Grid, *attributes: str) -> DataFrame:
    """Per spot and grid bucket: occupied µs, turnovers and the state at its end.

    A spot with any row gets all buckets.  ``attributes`` are columns of the spans to keep.
    """
    rows = emit_spans(spans, "bucket", grid)
    start = grid.start_of(F.col("grid_bucket"))
    end = start + F.lit(grid.width_us)
    own, lead_in = F.col("is_own"), F.col("is_lead_in")
    head = F.when(F.col("state_in"), F.col("first.since") - start).otherwise(0)
    tail = F.when(F.col("last.occupancy"), end - F.col("last.since")).otherwise(0)
    first_turn = F.when(F.col("first.occupancy") & ~F.col("state_in"), 1).otherwise(0)
    end_state = F.when(lead_in, F.col("state_in")).otherwise(F.col("last.occupancy"))
    occupied = (
        F.when(own, head + F.col("held") + tail)
        .when(end_state, F.lit(grid.width_us))
        .otherwise(0)
        .cast("long")
    )
    turnovers = F.when(own, F.col("turned") + first_turn).otherwise(0).cast("int")
    return rows.select(
        "parkingspotid",
        "parkingzoneid",
        *attributes,
        start.alias("starttime"),
        end.alias("endtime"),
        occupied.alias("occduration"),
        turnovers.alias("turnovers"),
        end_state.alias("occupancy"),
    )


def zone_groups(bridge: DataFrame) -> DataFrame:
    """One group per zone (the smallest id if a zone is in several)."""
    return bridge.groupBy("parkingzoneid").agg(F.min("parkinggroupid").alias("groupid"))


def spot_15min(
    events: DataFrame,
    prior: DataFrame,
    spots: DataFrame,
    zones: DataFrame,
    bridge: DataFrame,
    grid: Grid,
    slices: int = SLICES,
) -> DataFrame:
    """Spot facts with zone, group and site, the end state and the zone's capacity.

    ``zones`` is the capacity table (siteid, parkingzoneid, ptype, capacity); rows of
    zones it does not list are dropped.
    """
    columns = ["parkingspotid", "since", "occupancy", "parkingzoneid"]
    known = scans.only_keys(
        events.select(*columns).unionByName(silent_occupied(events, prior, spots, grid)),
        "parkingzoneid",
        zones,
        unique=True,
    )
    zone_columns = zones.select("parkingzoneid", "siteid", "ptype", "capacity")
    placed = (
        spot_spans(known, prior, grid, slices)
        .join(zone_columns, "parkingzoneid")
        .join(zone_groups(bridge), "parkingzoneid", "left")
    )
    facts = spot_buckets(placed, grid, "siteid", "ptype", "capacity", "groupid")
    share = F.col("occduration").cast("double") / F.lit(float(grid.width_us)) * 100.0
    return facts.select(
        "siteid",
        "parkingspotid",
        "starttime",
        F.coalesce("groupid", F.lit("na")).alias("groupid"),
        F.col("parkingzoneid").alias("zoneid"),
        F.col("ptype").alias("parkingtype"),
        "endtime",
        "occduration",
        "turnovers",
        share.alias("occpercent"),
        "occupancy",
        "capacity",
        *(c.alias(n) for n, c in times.bucket_labels().items()),
    )


def end_states(spot_facts: DataFrame) -> DataFrame:
    """The carry-over table the next run starts from."""
    return spot_facts.select("siteid", "starttime", "parkingspotid", "occupancy")


def zone_rollup(spot_facts: DataFrame, width_us: int = times.BUCKET_US) -> DataFrame:
    """Zone facts.

    Site, type, group and capacity follow from the zone; as grouping keys they need no
    aggregate and no join.
    """
    zone = ("zoneid", "starttime", "siteid", "parkingtype", "groupid", "capacity")
    grouped = spot_facts.groupBy(*zone).agg(
        F.min("endtime").alias("endtime"),
        F.avg(zero_as_null(F.col("occduration"))).alias("occduration"),
        F.sum("occduration").alias("_occupied"),
        F.sum("turnovers").alias("turnovers"),
        F.sum(F.when(F.col("occduration") == 0, 0).otherwise(1)).alias("filled_cnt"),
    )
    room = zero_as_null(F.col("capacity")).cast("long") * F.lit(width_us).cast("long")
    percent = F.round(F.try_divide(F.lit(100) * F.col("_occupied"), room), 1)
    return grouped.select(
        "zoneid",
        "starttime",
        "siteid",
        "groupid",
        "parkingtype",
        "endtime",
        "occduration",
        "turnovers",
        percent.alias("occpercent"),
        "capacity",
        "filled_cnt",
        *(c.alias(n) for n, c in times.bucket_labels().items()),
    )


def area_rollup(zone_facts: DataFrame, area: str) -> DataFrame:
    """Group (``area="groupid"``) or site (``area="siteid"``) facts from zone facts.

    Occupied time is weighted by filled spots, the percentage by capacity.
    """
    keys = list(dict.fromkeys([area, "starttime", "parkingtype", "siteid"]))
    filled, capacity = F.col("filled_cnt"), F.col("capacity")
    occupied = F.try_divide(F.sum(F.col("occduration") * filled), F.sum(zero_as_null(filled)))
    percent = F.try_divide(F.sum(F.col("occpercent") * capacity), F.sum(zero_as_null(capacity)))
    rolled = zone_facts.groupBy(*keys).agg(
        F.min("endtime").alias("endtime"),
        F.round(occupied, 0).alias("occduration"),
        F.sum("turnovers").alias("turnovers"),
        F.round(percent, 1).alias("occpercent"),
    )
    return rolled.withColumns(times.bucket_labels())
