"""Energy: counter rates, as-of neighbours, gap-filled buckets and savings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.standins import ENERGY_SIZE, ENERGY_START, LABELS, ctes, energy_grid, table
from kerbflow.operators.counters import counter_rate
from kerbflow.plans import energy

RATES = (
    "with "
    + ctes("samples", "settings", "bounds")
    + """,
meters as (select * from samples where sensor in ('w', 'mw')),
paired as (
  select *, lag(value) over seen as prev_value, lag(time) over seen as prev_time
  from meters window seen as (partition by nodeid order by time, sensor)),
all_rates as (
  select nodeid, sensor, time, value,
    (value - prev_value) / nullif(time - prev_time, 0) * 3.6e9 as rate
  from paired),
rates as (
  select r.nodeid, r.time, r.rate, s.siteid, s.legacy_power, s.max_led_power
  from all_rates r join settings s on r.nodeid = s.nodeid where r.rate > 0)"""
)

# Written over buckets and rows, not over neighbours as the Spark plan is.
BUCKETS = (
    RATES
    + f""",
node_list as (select distinct siteid, nodeid, legacy_power, max_led_power from rates),
spine as (
  select n.*, {ENERGY_START} + b.i * 900000000 as starttime, {ENERGY_START} + (b.i + 1) * 900000000 as endtime
  from node_list n cross join (select unnest(range({ENERGY_SIZE})) as i) b),
before_end as (
  select s.nodeid, s.starttime, r.time as p_time, r.rate as p_rate
  from spine s asof left join rates r on s.nodeid = r.nodeid and s.endtime > r.time),
after_end as (
  select s.nodeid, s.starttime, r.time as q_time, r.rate as q_rate
  from spine s asof left join rates r on s.nodeid = r.nodeid and s.endtime <= r.time),
own as (
  select nodeid, time - time % 900000000 as starttime, avg(rate) as mean_rate
  from rates where rate > 0.1 group by 1, 2),
powered as (
  select s.*, p_time, p_rate, q_time, q_rate,
    coalesce(mean_rate, case when (q_time - p_time) // 1000000 <= 12000
      and (p_rate + q_rate) / 2 > 0.1 then (p_rate + q_rate) / 2 end) as power
  from spine s
  join before_end p on s.nodeid = p.nodeid and s.starttime = p.starttime
  join after_end q on s.nodeid = q.nodeid and s.starttime = q.starttime
  left join own o on s.nodeid = o.nodeid and s.starttime = o.starttime),
buckets as (
  select siteid, nodeid, '15min' as aggregation_type, starttime, endtime,
    coalesce(power, 0) as actual_energy_consumption,
    case when power is null then 0 else max_led_power end as led_energy_consumption,
    case when power is null then 0 else legacy_power end as legacy_energy_consumption
  from powered),
saved as (
  select *, 0.25 * (legacy_energy_consumption - actual_energy_consumption) as savings_legacy_vs_actual,
    0.25 * (legacy_energy_consumption - led_energy_consumption) as savings_legacy_vs_led
  from buckets)"""
)

_MEASURES = (*energy.POWER_COLUMNS, *energy.SAVING_COLUMNS)
_ROUNDED = ", ".join(f"round({c}, 5) as {c}" for c in _MEASURES)


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 5) for c in _MEASURES})


def node_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return energy.node_15min(
        table(spark, sf_dir, "samples"), table(spark, sf_dir, "settings"), energy_grid(spark, sf_dir)
    )


@register("counter_rate", RATES + "\nselect nodeid, sensor, time, round(rate, 6) as rate from all_rates")
def rates_of_all_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    meters = table(spark, sf_dir, "samples").filter(F.col("sensor").isin("w", "mw"))
    return counter_rate(meters).select("nodeid", "sensor", "time", F.round("rate", 6).alias("rate"))


@register(
    "asof_neighbours",
    BUCKETS
    + """
select nodeid, starttime, p_time, round(p_rate, 6) as p_rate, q_time, round(q_rate, 6) as q_rate
from powered""",
)
def asof_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = energy_grid(spark, sf_dir)
    rates = energy.positive_rates(table(spark, sf_dir, "samples"))
    summary = energy.neighbour_summary(rates, grid, energy.EnergyRules().zero_watts)
    known = summary.join(table(spark, sf_dir, "settings").select("nodeid"), "nodeid")
    return energy.bucket_neighbours(known, grid).select(
        "nodeid",
        grid.start_of(F.col("grid_bucket")).alias("starttime"),
        "p_time",
        F.round("p_rate", 6).alias("p_rate"),
        "q_time",
        F.round("q_rate", 6).alias("q_rate"),
    )


@register(
    "energy_15min_node",
    BUCKETS
    + f"""
select siteid, nodeid, aggregation_type, starttime, endtime, {_ROUNDED}, {LABELS} from saved""",
)
def energy_15min_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(node_buckets(spark, sf_dir))


def _rollup_sql(keys: str, grain: str, measure: str, factor: str) -> str:
    width = {"15min": 900_000_000, "1hr": 3_600_000_000, "1day": 86_400_000_000}[grain]
    powers = ", ".join(f"{measure}({c}) * {factor} as {c}" for c in energy.POWER_COLUMNS)
    sums = ", ".join(f"sum({c}) as {c}" for c in energy.SAVING_COLUMNS)
    return f"""
select {keys}, '{grain}' as aggregation_type, starttime, endtime, {_ROUNDED}, {LABELS}
from (
  select {keys}, min(starttime) as starttime, max(endtime) as endtime, {powers}, {sums}
  from saved group by {keys}, saved.starttime - saved.starttime % {width}) rolled"""


def _register_rollup(name: str, grain: str, by_node: bool) -> None:
    factor = "1.0" if by_node or grain == "15min" else "0.25"
    keys, measure = ("siteid, nodeid", "avg") if by_node else ("siteid", "sum")

    @register(name, BUCKETS + _rollup_sql(keys, grain, measure, factor))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = energy.node_rollup if by_node else energy.site_rollup
        return rounded(rollup(node_buckets(spark, sf_dir), grain))


for _grain in ("1hr", "1day"):
    _register_rollup(f"energy_{_grain}_node", _grain, by_node=True)
for _grain in ("15min", "1hr", "1day"):
    _register_rollup(f"energy_{_grain}_site", _grain, by_node=False)
