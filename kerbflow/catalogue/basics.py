"""Scans, predicates, joins, windows, ordering and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.standins import BASE_US, absent, ctes, table
from kerbflow.functions import detections, times, values
from kerbflow.operators import counters, numbering, scans, versions
from kerbflow.plans import dimensions, warehouse
from kerbflow.sources import control
from kerbflow.sources.schemas import ALARM_CODES, NULL_DEFAULTS, SENSOR_CODES

_FROM_US = BASE_US + 4 * times.DAY_US
_UNTIL_US = BASE_US + 25 * times.DAY_US


def _quoted(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{c}'" for c in codes)


# --- scans ---------------------------------------------------------------------------


@register(
    "scan_window",
    f"""
select event_id, user_id, epoch_us(ts) as time, value from events
where epoch_us(ts) >= {_FROM_US} and epoch_us(ts) < {_UNTIL_US}
  and user_id in (select c_custkey from customer where c_mktsegment <> 'BUILDING')""",
)
def scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    events = scans.time_window(table(spark, sf_dir, "events"), "ts", _FROM_US, _UNTIL_US)
    kept = scans.only_keys(events, "user_id", keys.withColumnRenamed("c_custkey", "user_id"))
    return kept.select(
        "event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("time"), "value"
    )


@register(
    "scan_lookback",
    f"""
select event_id, user_id, epoch_us(ts) as time, epoch_us(ts) < {_FROM_US} as is_prior from events
where epoch_us(ts) >= {_FROM_US - 6_000_000_000} and epoch_us(ts) < {_UNTIL_US}""",
)
def scan_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scans.time_window(
        table(spark, sf_dir, "events"), "ts", _FROM_US, _UNTIL_US, 6000 * times.SECOND_US
    )
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.select("event_id", "user_id", time.alias("time")).withColumn(
        "is_prior", F.col("time") < _FROM_US
    )


@register(
    "dim_scan",
    "with "
    + ctes("fixtures")
    + """
select fixtureid, coalesce(LegacyPowerDraw, '') as LegacyPowerDraw, coalesce(PowerDraw, '') as PowerDraw, """
    + absent(dimensions.FIXTURE_COLUMNS, "fixtureid", "LegacyPowerDraw", "PowerDraw")
    + " from fixtures",
)
def dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.fixture_dimension(table(spark, sf_dir, "fixtures"))


@register(
    "distinct_keys",
    "with " + ctes("traffic_status") + "\nselect distinct siteid, nodeid, type from traffic_status",
)
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "traffic_status").select("siteid", "nodeid", "type").distinct()


@register(
    "semi_filter_keys",
    "with "
    + ctes("alarms", "filters")
    + """
select * from alarms where nodeid in (select obj from filters where type = 'connection_nodes')""",
)
def semi_filter_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "filters").filter(F.col("type") == "connection_nodes")
    return scans.only_keys(
        table(spark, sf_dir, "alarms"), "nodeid", listed.withColumnRenamed("obj", "nodeid")
    )


@register(
    "key_batches",
    "with "
    + ctes("nodes")
    + """,
numbered as (select nodeid, row_number() over (order by nodeid) - 1 as n
  from (select distinct nodeid from nodes) d)
select n // 100 as batch_no, string_agg('''' || nodeid || '''', ',' order by n) as grp
from numbered group by 1""",
)
def key_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.key_batches(table(spark, sf_dir, "nodes"), "nodeid", 100)


@register(
    "null_defaults",
    "with "
    + ctes("status_with_gaps")
    + """
select nodeid, time, coalesce(active, true) as active, coalesce(channel, 0) as channel,
  coalesce(count, 0) as count, coalesce(data, 'na') as data, coalesce(name, 'na') as name,
  coalesce(type, 'na') as type, coalesce(orgid, 'na') as orgid, coalesce(siteid, 'na') as siteid,
  coalesce(trafficdetectioneventid, 'na') as trafficdetectioneventid,
  coalesce(updated, 'na') as updated
from status_with_gaps""",
)
def null_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.with_defaults(
        table(spark, sf_dir, "status_with_gaps"), NULL_DEFAULTS["traffic_status"]
    )


# --- predicates ----------------------------------------------------------------------


@register(
    "in_list_filter",
    "with "
    + ctes("samples")
    + f"\nselect nodeid, sensor, time from samples where sensor in ({_quoted(SENSOR_CODES)})",
)
def in_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples").filter(F.col("sensor").isin(*SENSOR_CODES))
    return samples.select("nodeid", "sensor", "time")


@register(
    "alarm_list_filter",
    "with "
    + ctes("alarms")
    + f"\nselect nodeid, alarmtype, alarmdate from alarms where alarmtype in ({_quoted(ALARM_CODES)})",
)
def alarm_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = table(spark, sf_dir, "alarms").filter(F.col("alarmtype").isin(*ALARM_CODES))
    return alarms.select("nodeid", "alarmtype", "alarmdate")


@register(
    "zero_as_null",
    "with "
    + ctes("ticks")
    + """
select user_id, round(avg(nullif(k % 4, 0)), 9) as mean_nonzero, count(nullif(k % 4, 0)) as n_nonzero
from ticks group by 1""",
)
def zero_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    nonzero = values.zero_as_null(F.col("k") % 4)
    return (
        table(spark, sf_dir, "ticks")
        .groupBy("user_id")
        .agg(
            F.round(F.avg(nonzero), 9).alias("mean_nonzero"),
            F.count(nonzero).alias("n_nonzero"),
        )
    )


# --- joins ---------------------------------------------------------------------------


@register(
    "join_inner_dim",
    "with "
    + ctes("samples", "settings")
    + """
select s.nodeid, s.sensor, s.time, siteid, legacy_power, max_led_power
from samples s join settings t on s.nodeid = t.nodeid""",
)
def join_inner_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples").select("nodeid", "sensor", "time")
    return samples.join(table(spark, sf_dir, "settings"), "nodeid")


@register(
    "join_left_default",
    "with "
    + ctes("spots", "zones")
    + """
select parkingspotid, s.parkingzoneid, coalesce(z.parkinggroupid, 'na') as parkinggroupid
from spots s left join (select * from zones where type <> 'Street') z
  on s.parkingzoneid = z.parkingzoneid""",
)
def join_left_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = table(spark, sf_dir, "zones").filter(F.col("type") != "Street")
    grouped = zones.select("parkingzoneid", "parkinggroupid")
    return (
        table(spark, sf_dir, "spots")
        .select("parkingspotid", "parkingzoneid")
        .join(grouped, "parkingzoneid", "left")
        .fillna({"parkinggroupid": "na"})
    )


@register(
    "join_multihop",
    "with "
    + ctes("site_group", "groups", "group_node")
    + """
select s.siteid, g.groupid, n.nodeid
from site_group s join groups g on s.groupid = g.groupid join group_node n on g.groupid = n.groupid""",
)
def join_multihop(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "groups").select("groupid")
    return (
        groups.join(table(spark, sf_dir, "site_group"), "groupid")
        .join(table(spark, sf_dir, "group_node"), "groupid")
        .select("siteid", "groupid", "nodeid")
    )


@register(
    "join_optional",
    "with "
    + ctes("nodes", "node_site", "site_org")
    + """
select n.nodeid, s.siteid, o.orgid
from nodes n left join node_site s on n.nodeid = s.nodeid left join site_org o on s.siteid = o.siteid""",
)
def join_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nodes")
        .select("nodeid")
        .join(table(spark, sf_dir, "node_site"), "nodeid", "left")
        .join(table(spark, sf_dir, "site_org"), "siteid", "left")
        .select("nodeid", "siteid", "orgid")
    )


# --- versions, order, sets -----------------------------------------------------------


@register(
    "last_time_per_key",
    """
select user_id, event_id, epoch_us(ts) as time, max(epoch_us(ts)) over (partition by user_id) as maxtime
from events""",
)
def last_time_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", time.alias("time"))
    return versions.with_key_maximum(rows, ["user_id"], "time", "maxtime")


_VERSIONS = (
    "with "
    + ctes("samples")
    + """,
staged as (select nodeid, sensor, time // 3600000000 as ts, time, value from samples)"""
)


def _staged_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.expr("time div 3600000000").alias("ts")
    return table(spark, sf_dir, "samples").select("nodeid", "sensor", hour, "time", "value")


@register(
    "latest_version",
    _VERSIONS
    + """
select nodeid, sensor, ts, time from (
  select *, row_number() over (partition by nodeid, sensor order by ts desc, time desc, value desc) as rn
  from staged) v where rn = 1""",
)
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = warehouse.latest_version(_staged_versions(spark, sf_dir), ["nodeid", "sensor"])
    return newest.drop("value")


@register(
    "latest_version_ties",
    _VERSIONS
    + """
select nodeid, sensor, ts, time from (
  select *, max(ts) over (partition by nodeid, sensor) as maxts from staged) v where ts = maxts""",
)
def latest_version_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged_versions(spark, sf_dir).drop("value")
    return versions.latest_with_ties(staged, ["nodeid", "sensor"], "ts")


@register(
    "sorted_partitions",
    "with " + ctes("occupancy") + "\nselect parkingspotid, since, occupancy from occupancy",
)
def sorted_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "occupancy").select("parkingspotid", "since", "occupancy")
    return numbering.sorted_by_key(rows, "parkingspotid", "since")


@register(
    "ordered_limit",
    "with "
    + ctes("traffic_status")
    + """
select nodeid, time, name from traffic_status order by time, nodeid, name limit 500""",
)
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = table(spark, sf_dir, "traffic_status").select("nodeid", "time", "name")
    return status.orderBy("time", "nodeid", "name").limit(500)


@register(
    "union_all",
    "with "
    + ctes("samples", "alarms")
    + """
select nodeid, time, 'sample' as kind from samples
union all select nodeid, alarmdate * 1000 as time, 'alarm' as kind from alarms""",
)
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "samples").select("nodeid", "time", F.lit("sample").alias("kind"))
    alarms = table(spark, sf_dir, "alarms").select(
        F.lit("alarm").alias("kind"), "nodeid", (F.col("alarmdate") * 1000).alias("time")
    )
    return samples.unionByName(alarms)


@register(
    "distinct_rows",
    "with "
    + ctes("parking_groups")
    + """
select parkinggroupid, coalesce(name, '') as name, coalesce(description, '') as description,
  coalesce(parkingzones, '') as parkingzones, '' as vehicle_types, '' as policy, '' as created
from parking_groups""",
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.parking_group_dimension(table(spark, sf_dir, "parking_groups"))


# --- scalar functions ----------------------------------------------------------------


@register(
    "time_bucket",
    """
with t as (select event_id, epoch_us(ts) as time from events)
select event_id, time - time % 900000000 as b15, time - time % 3600000000 as b60,
  time - time % 86400000000 as bday, time - (time - 420000000) % 900000000 as b15_at_7min from t""",
)
def time_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.bucket_start(time).alias("b15"),
        times.bucket_start(time, times.HOUR_US).alias("b60"),
        times.bucket_start(time, times.DAY_US).alias("bday"),
        times.bucket_start(time, origin_us=7 * times.MINUTE_US).alias("b15_at_7min"),
    )


@register(
    "time_labels",
    """
select event_id, strftime(ts, '%Y-%m-%d %H:%M') as startdt, strftime(ts, '%Y-%m-%d %H') as starthr,
  strftime(ts, '%Y-%m-%d') as startday from events""",
)
def time_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.minute_label(time).alias("startdt"),
        times.hour_label(time).alias("starthr"),
        times.day_label(time).alias("startday"),
    )


@register(
    "time_parse",
    """
select event_id,
  case when event_id % 9 = 0 then 0 when event_id % 9 = 1 then null
    else epoch_us(date_trunc('minute', ts)) end as parsed,
  epoch_us(date_trunc('hour', ts)) + 3600000000 as hour_end,
  epoch_us(date_trunc('day', ts)) + 86400000000 as day_end
from events""",
)
def time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.date_format("ts", "yyyy-MM-dd HH:mm")
    text = (
        F.when(F.col("event_id") % 9 == 0, "na")
        .when(F.col("event_id") % 9 == 1, F.concat(F.lit("x"), label))
        .otherwise(label)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.parse_minute(text).alias("parsed"),
        times.hour_end(F.substring(label, 1, 13)).alias("hour_end"),
        times.day_end(F.substring(label, 1, 10)).alias("day_end"),
    )


@register(
    "localize_time",
    "with "
    + ctes("sites")
    + """,
t as (select o_orderkey, time_zone, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as moment
  from orders join sites on siteid = 's' || o_custkey)
select o_orderkey, time_zone,
  strftime(timezone(time_zone, timezone('UTC', moment)), '%Y-%m-%d %H:%M:%S') as local_time from t""",
)
def localize_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "sites").select("siteid", "time_zone")
    hours = F.expr("o_orderkey % 24") * F.lit(times.HOUR_US)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("s"), "o_custkey").alias("siteid"),
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) + hours).alias("moment"),
    )
    return orders.join(sites, "siteid").select(
        "o_orderkey", "time_zone", times.localize(F.col("moment"), F.col("time_zone")).alias("local_time")
    )


@register(
    "epoch_day",
    """
select event_id, strftime(ts, '%Y-%m-%d') as day_us, strftime(ts, '%Y-%m-%d') as day_ms,
  strftime(ts - interval 1 day, '%Y-%m-%d') as day_before,
  strftime(ts + interval 1 day, '%Y-%m-%d') as day_after from events""",
)
def epoch_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    day = times.day_label(time)
    return table(spark, sf_dir, "events").select(
        "event_id",
        day.alias("day_us"),
        times.day_of_millis(F.floor(time / 1000)).alias("day_ms"),
        times.shift_day(day, -1).alias("day_before"),
        times.shift_day(day, 1).alias("day_after"),
    )


@register(
    "string_clean",
    "with "
    + ctes("fixtures")
    + """
select fixtureid, replace(replace(replace(LegacyPowerDraw, 'W', ''), 'w', ''), ' ', '') as bare,
  try_cast(replace(replace(replace(LegacyPowerDraw, 'W', ''), 'w', ''), ' ', '') as double) as watts,
  cast(length(LegacyPowerDraw) as integer) as n_chars, string_split(fixtureid, '-')[1] as head,
  fixtureid || '==>' || upper(coalesce(PowerDraw, 'na')) as path
from fixtures""",
)
def string_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = F.col("LegacyPowerDraw")
    return table(spark, sf_dir, "fixtures").select(
        "fixtureid",
        values.strip_watt_unit(legacy).alias("bare"),
        values.watts(legacy).alias("watts"),
        F.length(legacy).alias("n_chars"),
        F.split("fixtureid", "-")[0].alias("head"),
        F.concat_ws("==>", "fixtureid", F.upper(F.coalesce("PowerDraw", F.lit("na")))).alias("path"),
    )


@register(
    "vector_speed",
    "with " + ctes("ticks") + "\nselect event_id, round(sqrt(value * value + k * k), 6) as speed from ticks",
)
def vector_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = detections.vector_length(F.col("value"), F.col("k"))
    return table(spark, sf_dir, "ticks").select("event_id", F.round(speed, 6).alias("speed"))


@register(
    "geo_distance",
    """
with p as (select c_custkey, c_acctbal / 2e2 as lat1, c_nationkey * 7e0 as lon1,
  c_acctbal / 2e2 + c_custkey % 10 / 1e4 as lat2, c_nationkey * 7e0 + c_custkey % 7 / 1e4 as lon2
  from customer)
select c_custkey, round(6371000 * sqrt(pow(radians(lon2 - lon1) * cos((radians(lat1) + radians(lat2)) / 2), 2)
  + pow(radians(lat2) - radians(lat1), 2)), 3) as metres from p""",
)
def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = F.col("c_acctbal") / 2e2, F.col("c_nationkey") * 7e0
    metres = values.ground_distance_m(
        lat, lon, lat + F.col("c_custkey") % 10 / 1e4, lon + F.col("c_custkey") % 7 / 1e4
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(metres, 3).alias("metres"))


@register(
    "json_extract",
    "with "
    + ctes("traffic_status")
    + """
select nodeid, time,
  case when json_valid(data) then json_extract_string(data, '$.detected_objects[0].class') end as first_class,
  case when json_valid(data) then try_cast(json_extract_string(data,
    '$.detected_objects[1].velocity.y') as double) end as second_y
from traffic_status""",
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "traffic_status").select(
        "nodeid",
        "time",
        F.get_json_object("data", "$.detected_objects[0].class").alias("first_class"),
        F.get_json_object("data", "$.detected_objects[1].velocity.y")
        .try_cast("double")
        .alias("second_y"),
    )


# --- control table and counters ------------------------------------------------------


@register(
    "control_get",
    "with "
    + ctes("ticks")
    + """,
newest as (select * from (
  select event_type as type, cast(user_id as varchar) as key, 'v' || event_id as val,
    row_number() over (partition by event_type, user_id order by time desc, 'v' || event_id desc) as rn
  from ticks) n where rn = 1)
select 'click' as type, cast(c_custkey as varchar) as key, coalesce(val, 'na') as val
from customer left join newest on type = 'click' and key = cast(c_custkey as varchar)""",
)
def control_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "ticks").select(
        F.col("event_type").alias("type"),
        F.col("user_id").cast("string").alias("key"),
        F.concat(F.lit("v"), "event_id").alias("val"),
        F.col("time").alias("stamp"),
    )
    wanted = table(spark, sf_dir, "customer").select(
        F.lit("click").alias("type"), F.col("c_custkey").cast("string").alias("key")
    )
    return control.lookup(control.current_values(log), wanted)


@register(
    "seed_if_absent",
    "with "
    + ctes("settings", "samples")
    + """,
present as (select nodeid, 'seen' as val from samples group by nodeid)
select * from present union all
select nodeid, 'default' as val from settings where nodeid not in (select nodeid from present)""",
)
def seed_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = table(spark, sf_dir, "samples").select("nodeid").distinct().withColumn("val", F.lit("seen"))
    defaults = table(spark, sf_dir, "settings").select("nodeid", F.lit("default").alias("val"))
    return versions.seed_if_absent(present, defaults, ["nodeid"])


_MARK_US = BASE_US + 20 * times.HOUR_US


@register(
    "running_counter",
    "with "
    + ctes("traffic_status")
    + f""",
totals as (select trafficdetectioneventid, sum(count) as count,
  case when trafficdetectioneventid like '%1' then 0 else sum(count) + 5 end as aggregated_count
  from traffic_status group by 1),
batch as (select trafficdetectioneventid, count(*) as n from traffic_status
  where time >= {_MARK_US} and trafficdetectioneventid <> 'e3' group by 1)
select t.trafficdetectioneventid,
  cast(case when aggregated_count = 0 then count else aggregated_count end + coalesce(n, 0) as bigint)
    as aggregated_count
from totals t left join batch b on t.trafficdetectioneventid = b.trafficdetectioneventid""",
)
def running_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = table(spark, sf_dir, "traffic_status")
    key = F.col("trafficdetectioneventid")
    totals = (
        status.groupBy(key)
        .agg(F.sum("count").alias("count"))
        .withColumn("aggregated_count", F.when(key.like("%1"), 0).otherwise(F.col("count") + 5))
    )
    batch = status.filter(key != "e3")
    return counters.running_counter(totals, batch, "trafficdetectioneventid", "time", _MARK_US)


_STAGED_DAY = "strftime(make_timestamp(alarmdate * 1000), '%Y-%m-%d')"


@register(
    "retention_filter",
    "with "
    + ctes("alarms")
    + f"""
select nodeid, alarmtype, alarmdate, cast(1704200000 as bigint) as ts, {_STAGED_DAY} as startday
from alarms where {_STAGED_DAY} >= '2024-01-02'""",
)
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = table(spark, sf_dir, "alarms").select("nodeid", "alarmtype", "alarmdate")
    return warehouse.retained(
        warehouse.stage_utc(alarms, "alarmdate", "ms", 1_704_200_000), "2024-01-02"
    )
