"""Traffic: detections, dwell, transitions and rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.standins import ctes, table
from kerbflow.functions import times
from kerbflow.functions.values import zero_as_null
from kerbflow.plans import traffic

OBJECTS = (
    "with "
    + ctes("traffic_status")
    + """,
parsed as (
  select *, case when json_valid(data) then json_extract(data, '$.detected_objects[*]') end as objs
  from traffic_status),
expanded as (
  select * exclude (objs), unnest(objs) as obj from parsed where len(objs) > 0
  union all
  select * exclude (objs), null as obj from parsed where objs is null or len(objs) = 0),
speeds as (
  select *,
    coalesce(sqrt(pow(try_cast(cast(json_extract(obj, '$.velocity.x') as varchar) as double), 2)
      + pow(try_cast(cast(json_extract(obj, '$.velocity.y') as varchar) as double), 2)), 0) as own_speed,
    coalesce(sqrt(pow(try_cast(cast(json_extract(obj, '$.world_velocity.x') as varchar) as double), 2)
      + pow(try_cast(cast(json_extract(obj, '$.world_velocity.y') as varchar) as double), 2)), 0)
      as world_speed,
    lower(replace(coalesce(cast(json_extract(obj, '$.class') as varchar), ''), '"', '')) as cls
  from expanded),
objects as (
  select nodeid, time - time % 900000000 as starttime, type as eventtype, name as eventname,
    trafficdetectioneventid as eventid, data, time as eventtime,
    case when obj is null or cls = '' then 'na' else cls end as objectclass,
    case when obj is null then 'na'
      else coalesce(cast(json_extract(obj, '$.detectedobjectid') as varchar), '') end as objectid,
    case when obj is not null then case when own_speed <> 0 then own_speed else world_speed end end
      as objectvelocity,
    case when obj is not null
      then case when type = 'ObjectDwellEvent' then cast(time as double) else 0.0 end end as dwell,
    siteid
  from speeds)"""
)

FACTS = (
    OBJECTS
    + """,
dwells as (
  select nodeid, starttime, eventtype, min(eventname) as eventname, eventid, min(data) as data,
    min(eventtime) as eventtime, objectclass, objectid, cast(0 as double) as objectvelocity,
    max(dwell) - min(dwell) + 2e6 as dwell, siteid
  from objects where eventtype = 'ObjectDwellEvent'
  group by nodeid, starttime, eventtype, eventid, objectclass, objectid, siteid),
both_kinds as (
  select * from objects where eventtype <> 'ObjectDwellEvent'
  union all by name
  select * from dwells),
lagged as (
  select *, lag(eventname) over seen as prev_name, lag(eventtime) over seen as prev_time
  from both_kinds
  window seen as (partition by nodeid, objectid
    order by eventtime, eventtype, eventid, objectclass, eventname, siteid)),
combos as (
  select nodeid, starttime, 'COMBO' as eventtype,
    nodeid || '==>' || prev_name || '==>' || eventname as eventname,
    nodeid || '==>' || prev_name || '==>' || eventname as eventid,
    'na' as data, eventtime, objectclass, objectid,
    cast(null as double) as objectvelocity, cast(null as double) as dwell, siteid
  from lagged where eventtime - prev_time < 60000000),
facts as (
  select * from both_kinds union all by name select * from combos)"""
)

_SPEED = "nullif(objectvelocity, 0)"
_MEASURES = f"""round(avg({_SPEED}), 6) as avgvelocity, round(avg(nullif(dwell, 0)), 3) as avgdwell,
    round(quantile_disc({_SPEED}, 0.5), 6) as medianvelocity,
    round(quantile_disc({_SPEED}, 0.85), 6) as p85velocity,
    count(*) as eventcnt"""
_WIDTHS = {"15min": 900_000_000, "1hr": 3_600_000_000, "1day": 86_400_000_000}


def rollup_select(grain: str, by_event: bool) -> str:
    width = _WIDTHS[grain]
    keys = "siteid, eventid" if by_event else "siteid"
    extra = "min(eventname) as name, max(nodeid) as nodeid," if by_event else ""
    passed = "name, nodeid," if by_event else ""
    return f"""
select {keys}, '{grain}' as aggregation_type, type, objectclass, starttime, {passed}
    period + {width} as endtime,
    strftime(make_timestamp(starttime), '%Y-%m-%d %H:%M') as startdt,
    strftime(make_timestamp(laststart + 900000000), '%Y-%m-%d %H:%M') as enddt,
    strftime(make_timestamp(starttime), '%Y-%m-%d %H') as starthr,
    strftime(make_timestamp(starttime), '%Y-%m-%d') as startday,
    avgvelocity, avgdwell, medianvelocity, p85velocity, eventcnt
from (
  select {keys}, eventtype as type, objectclass, starttime - starttime % {width} as period, {extra}
    min(starttime) as starttime, max(starttime) as laststart, {_MEASURES}
  from facts group by {keys}, eventtype, objectclass, starttime - starttime % {width}) grouped"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_facts(table(spark, sf_dir, "traffic_status"))


def rounded(rolled: DataFrame) -> DataFrame:
    """Speeds and stays rounded, because the order of a floating sum is not fixed."""
    speeds = ("avgvelocity", "medianvelocity", "p85velocity")
    return rolled.withColumns(
        {**{c: F.round(c, 6) for c in speeds}, "avgdwell": F.round("avgdwell", 3)}
    )


def _register_rollup(grain: str, by_event: bool) -> None:
    name = f"traffic_{grain}_{'event' if by_event else 'site'}"

    @register(name, FACTS + rollup_select(grain, by_event))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(traffic.rollup(facts(spark, sf_dir), grain, by_event))


for _grain in traffic.GRAINS:
    for _by_event in (True, False):
        _register_rollup(_grain, _by_event)


@register(
    "traffic_grouping_sets",
    FACTS + "\nunion all by name".join(rollup_select(g, False) for g in traffic.GRAINS),
)
def traffic_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(traffic.rollup_all(facts(spark, sf_dir), by_event=False))


@register(
    "explode_detections",
    OBJECTS
    + """
select * exclude (objectvelocity), round(objectvelocity, 9) as objectvelocity from objects""",
)
def explode_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = traffic.expand_detections(table(spark, sf_dir, "traffic_status"))
    return objects.withColumn("objectvelocity", F.round("objectvelocity", 9))


@register("dwell_collapse", FACTS + "\nselect * from dwells")
def dwell_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = table(spark, sf_dir, "traffic_status").filter(F.col("type") == traffic.DWELL_TYPE)
    return traffic.collapse_dwell(traffic.expand_detections(status))


@register(
    "combo_transitions",
    FACTS + "\nselect nodeid, starttime, eventname, eventtime, objectclass, objectid, siteid from combos",
)
def combo_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = traffic.transitions(traffic.object_facts(table(spark, sf_dir, "traffic_status")))
    return found.select(
        "nodeid", "starttime", "eventname", "eventtime", "objectclass", "objectid", "siteid"
    )


@register(
    "combo_busy_object",
    FACTS.replace("from traffic_status", "from (select * replace ('n' as nodeid, 'na' as data) from traffic_status) busy")
    + "\nselect nodeid, starttime, eventname, eventtime, objectclass, objectid, siteid from combos",
)
def combo_busy_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events at one node without an object id: one object that is seen all the time."""
    busy = table(spark, sf_dir, "traffic_status").withColumns({"nodeid": F.lit("n"), "data": F.lit("na")})
    found = traffic.transitions(traffic.object_facts(busy))
    return found.select(
        "nodeid", "starttime", "eventname", "eventtime", "objectclass", "objectid", "siteid"
    )


@register(
    "route_by_type",
    "with "
    + ctes("traffic_status")
    + """
select case when type = 'ObjectDwellEvent' then 'D' else 'L' end as record_type, siteid,
  count(*) as rows_routed, min(time) as first_time, max(time) as last_time
from traffic_status group by 1, 2""",
)
def route_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_dwell = F.col("type") == traffic.DWELL_TYPE
    routed = table(spark, sf_dir, "traffic_status").withColumn("record_type", F.when(is_dwell, "D").otherwise("L"))
    return routed.groupBy("record_type", "siteid").agg(
        F.count("*").alias("rows_routed"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )


_RANK_ERROR = 0.02


@register(
    "percentiles_merged",
    FACTS
    + "\nunion all by name".join(
        f"""
select siteid, '{grain}' as aggregation_type, eventtype as type, objectclass,
  starttime - starttime % {width} + {width} as endtime, count(*) as eventcnt,
  round(avg({_SPEED}), 6) as avgvelocity, case when count({_SPEED}) > 0 then true end as median_near,
  case when count({_SPEED}) > 0 then true end as p85_near
from facts group by siteid, eventtype, objectclass, starttime - starttime % {width}"""
        for grain, width in _WIDTHS.items()
    ),
)
def percentiles_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grains merged from 15-minute sketches; each percentile is checked to lie within
    2 % of its rank among the speeds."""
    found = facts(spark, sf_dir)
    parts = traffic.sketched(found, by_event=False)
    speed = zero_as_null(F.col("objectvelocity"))
    results = []
    for grain, width in traffic.GRAINS.items():
        rolled = traffic.merged_rollup(parts, grain, by_event=False)
        period = times.bucket_start(F.col("starttime"), width) + F.lit(width)
        speeds = found.select("siteid", F.col("eventtype").alias("type"), "objectclass", period.alias("endtime"), speed.alias("v"))
        keys = ["siteid", "aggregation_type", "type", "objectclass", "endtime", "eventcnt", "avgvelocity"]
        near = [
            (
                (F.count_if(F.col("v") < F.col(q)) <= (p + _RANK_ERROR) * F.count("v") + 1)
                & (F.count_if(F.col("v") <= F.col(q)) >= (p - _RANK_ERROR) * F.count("v") - 1)
            )
            for q, p in (("medianvelocity", 0.5), ("p85velocity", 0.85))
        ]
        near = [F.when(F.count("v") > 0, x) for x in near]
        joined = rolled.join(speeds, ["siteid", "type", "objectclass", "endtime"])
        results.append(joined.groupBy(*keys).agg(near[0].alias("median_near"), near[1].alias("p85_near")))
    merged = results[0].unionByName(results[1]).unionByName(results[2])
    return merged.withColumn("avgvelocity", F.round("avgvelocity", 6))


@register(
    "approx_percentiles",
    """
select event_type, strftime(ts, '%Y-%m-%d') as day,
  quantile_disc(v, 0.5) as p50, quantile_disc(v, 0.85) as p85
from (select *, case when event_id % 7 = 0 then null else value end as v from events) e
group by 1, 2""",
)
def approx_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    speed = zero_as_null(F.when(F.col("event_id") % 7 == 0, 0.0).otherwise(F.col("value")))
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(
            F.percentile_approx(speed, F.lit(0.5)).alias("p50"),
            F.percentile_approx(speed, F.lit(0.85)).alias("p85"),
        )
    )
