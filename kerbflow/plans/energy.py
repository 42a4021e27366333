"""Cumulative meter samples to gap-filled 15-minute buckets and savings.

Rows are combined to one summary per node and non-empty bucket before anything is
ordered by node; the ordered pass sees at most one row per node and bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions import times
from kerbflow.operators.counters import counter_rate
from kerbflow.operators.grids import Grid, emit_to_next, spread_by_key
from kerbflow.operators.sequences import LEVELS
from kerbflow.sources.schemas import ENERGY_SENSORS

BUCKET_HOURS = 0.25
POWER_COLUMNS = (
    "actual_energy_consumption", "led_energy_consumption", "legacy_energy_consumption",
)
SAVING_COLUMNS = ("savings_legacy_vs_actual", "savings_legacy_vs_led")


@dataclass(frozen=True)
class EnergyRules:
    """Expected sampling interval in seconds, and the power that counts as off."""

    interval_s: int = 6000
    zero_watts: float = 0.1

    @property
    def lookback_us(self) -> int:
        return self.interval_s * times.SECOND_US


def positive_rates(
    samples: DataFrame, per_sensor: bool = False, levels: Sequence[int] = LEVELS
) -> DataFrame:
    """Power per sample.  First samples, resets and flat readings drop out."""
    keys = ("nodeid", "sensor") if per_sensor else ("nodeid",)
    ties = () if per_sensor else ("sensor",)
    meters = samples.filter(F.col("sensor").isin(*ENERGY_SENSORS))
    rates = counter_rate(meters, keys, ties=ties, levels=levels).filter(F.col("rate") > 0)
    return rates.select("nodeid", "time", "rate")


def neighbour_summary(rates: DataFrame, grid: Grid, zero_watts: float) -> DataFrame:
    """First, last and mean qualifying rate per node and bucket that has rows."""
    live = F.when(F.col("rate") > zero_watts, F.col("rate"))
    return (
        rates.withColumn("bucket", grid.index(F.col("time")))
        .groupBy("nodeid", "bucket")
        .agg(
            F.min("time").alias("first_time"),
            F.min_by("rate", "time").alias("first_rate"),
            F.max("time").alias("last_time"),
            F.max_by("rate", "time").alias("last_rate"),
            F.avg(live).alias("mean_rate"),
        )
    )


def bucket_neighbours(summary: DataFrame, grid: Grid) -> DataFrame:
    """Per node and grid bucket: the last row before the bucket's end (``p_``) and the
    first row at or after it (``q_``); null where there is none."""
    order = Window.partitionBy("nodeid").orderBy("bucket")
    paired = spread_by_key(summary, "nodeid").withColumns(
        {
            "q_time": F.lead("first_time").over(order),
            "q_rate": F.lead("first_rate").over(order),
        }
    )
    emitted = emit_to_next(paired, ["nodeid"], "bucket", grid)
    lead_in = F.col("is_lead_in")
    return emitted.withColumns(
        {
            "p_time": F.when(~lead_in, F.col("last_time")),
            "p_rate": F.when(~lead_in, F.col("last_rate")),
            "q_time": F.when(lead_in, F.col("first_time")).otherwise(F.col("q_time")),
            "q_rate": F.when(lead_in, F.col("first_rate")).otherwise(F.col("q_rate")),
            "own_rate": F.when(F.col("is_own"), F.col("mean_rate")),
        }
    )


def one_per_node(settings: DataFrame) -> DataFrame:
    """The settings, checked to hold each node once when they are read."""
    rows = F.count("*")
    held = [F.first(c).alias(c) for c in settings.columns if c != "nodeid"]
    twice = F.raise_error(F.concat(F.lit("several settings rows for node "), "nodeid")).cast("int")
    checked = settings.groupBy("nodeid").agg(rows.alias("_rows"), *held)
    return checked.filter(F.when(F.col("_rows") > 1, twice).otherwise(1) == 1).drop("_rows")


def node_15min(
    samples: DataFrame,
    settings: DataFrame,
    grid: Grid,
    rules: EnergyRules = EnergyRules(),
    per_sensor: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """One row per node and bucket; empty buckets between near neighbours are filled.

    ``settings`` has one row per node (``dimensions.node_energy_settings`` makes them so;
    several for one node fail the run rather than lose a lamp); nodes without settings are
    left out.  It joins the summaries, not the samples: there is at most one summary per
    node and bucket, so a busy node does not make a heavy join key.
    """
    rates = positive_rates(samples, per_sensor, levels)
    summary = neighbour_summary(rates, grid, rules.zero_watts).join(one_per_node(settings), "nodeid")
    return savings(with_power(bucket_neighbours(summary, grid), rules), grid)


def with_power(rows: DataFrame, rules: EnergyRules) -> DataFrame:
    """Add the bucket's power: the mean of its own rates, else that of near neighbours, else
    null."""
    gap_s = F.floor((F.col("q_time") - F.col("p_time")) / F.lit(times.SECOND_US))
    between = (F.col("p_rate") + F.col("q_rate")) / 2
    fillable = (gap_s <= F.lit(2 * rules.interval_s)) & (between > rules.zero_watts)
    power = F.coalesce("own_rate", F.when(fillable, between))
    return rows.withColumn("power", power)


def savings(rows: DataFrame, grid: Grid) -> DataFrame:
    """Node rows with a power (null = off) to the fact columns."""
    on = F.col("power").isNotNull()

    def when_on(value: Column) -> Column:
        return F.when(on, value).otherwise(0.0)

    start = grid.start_of(F.col("grid_bucket"))
    timed = rows.select(
        "siteid",
        "nodeid",
        F.lit("15min").alias("aggregation_type"),
        start.alias("starttime"),
        (start + F.lit(grid.width_us)).alias("endtime"),
        when_on(F.col("power")).alias("actual_energy_consumption"),
        when_on(F.col("max_led_power")).alias("led_energy_consumption"),
        when_on(F.col("legacy_power")).alias("legacy_energy_consumption"),
    )
    legacy = F.col("legacy_energy_consumption")
    return timed.withColumns(
        {
            "savings_legacy_vs_actual": F.lit(BUCKET_HOURS)
            * (legacy - F.col("actual_energy_consumption")),
            "savings_legacy_vs_led": F.lit(BUCKET_HOURS)
            * (legacy - F.col("led_energy_consumption")),
            **times.bucket_labels(),
        }
    )


def _period_rollup(
    buckets: DataFrame, keys: list[str], grain: str, measure, factor: float
) -> DataFrame:
    width = {"15min": times.BUCKET_US, "1hr": times.HOUR_US, "1day": times.DAY_US}[grain]
    rolled = (
        buckets.withColumn("period", times.bucket_start(F.col("starttime"), width))
        .groupBy(*keys, "period")
        .agg(
            F.min("starttime").alias("starttime"),
            F.max("endtime").alias("endtime"),
            *((measure(c) * F.lit(factor)).alias(c) for c in POWER_COLUMNS),
            *(F.sum(c).alias(c) for c in SAVING_COLUMNS),
        )
    )
    return rolled.select(
        *keys,
        F.lit(grain).alias("aggregation_type"),
        "starttime",
        "endtime",
        *POWER_COLUMNS,
        *SAVING_COLUMNS,
        *(c.alias(n) for n, c in times.bucket_labels().items()),
    )


def node_rollup(buckets: DataFrame, grain: str) -> DataFrame:
    """Node hour or day: mean power (W) and summed savings (Wh)."""
    return _period_rollup(buckets, ["siteid", "nodeid"], grain, F.avg, 1.0)


def site_rollup(buckets: DataFrame, grain: str) -> DataFrame:
    """Site bucket: summed power (W); site hour or day: energy (Wh)."""
    factor = 1.0 if grain == "15min" else BUCKET_HOURS
    return _period_rollup(buckets, ["siteid"], grain, F.sum, factor)
