"""Sensor tables derived from the benchmark tables.

Each stand-in is one SELECT, written once and rendered for Spark or for the check
engine, so both sides start from the same rows.  Sensor clocks run 20 times faster than
the event clock, which brings samples minutes apart as real sensors have them; all rows
of the source tables are used.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from kerbflow.functions import times
from kerbflow.operators.grids import Grid

BASE_US = 1_704_067_200_000_000  # 2024-01-01 00:00 UTC, the first event day
SPEED_UP = 20

_TOKENS = {
    "spark": {
        "STR": "string",
        "DIV": "div",
        "TS_US": "unix_micros(cast(ts as timestamp))",
        "ARRAY": "array",
    },
    "check": {
        "STR": "varchar",
        "DIV": "//",
        "TS_US": "epoch_us(ts)",
        "ARRAY": "list_value",
    },
}

_TABLES = {
    # One clock for all sensors, plus the counter in the event properties ('{"k": 12}').
    "ticks": f"""
        select event_id, user_id, event_type, value,
               cast(substr(props, 7, length(props) - 7) as int) as k,
               {BASE_US} + (__TS_US__ - {BASE_US}) __DIV__ {SPEED_UP} as time
        from {{events}}""",
    # What the grids of the queries span: all rows, from a midnight or the first quarter of
    # an hour to the end of the last hour.
    "bounds": """
        select min(time) - min(time) % 86400000000 as energy_start,
               min(time) - min(time) % 3600000000 + 900000000 as parking_start,
               max(time) - max(time) % 3600000000 + 3600000000 as grid_end
        from {ticks}""",
    "traffic_status": """
        select 'n' || user_id as nodeid, time, user_id % 2 = 0 as active,
               cast(k % 4 as int) as channel, cast(k as bigint) as count,
               case k % 10
                 when 0 then 'not json'
                 when 1 then '{"detected_objects":[]}'
                 when 2 then '{"count":1}'
                 when 3 then '{"detected_objects":[{"class":"Car","detectedobjectid":' || (k % 3)
                   || ',"velocity":{"x":0,"y":0},"world_velocity":{"x":'
                   || cast(value as __STR__) || ',"y":1.5}}]}'
                 when 4 then '{"detected_objects":[{"class":"","detectedobjectid":"q","velocity":{"x":"'
                   || cast(value as __STR__) || '","y":1}}]}'
                 when 5 then '{"detected_objects":[{"class":"Car","detectedobjectid":1,"velocity":{"x":'
                   || cast(value as __STR__)
                   || ',"y":2}},{"class":"Person","detectedobjectid":2,"velocity":{"x":0.5,"y":'
                   || k || '}}]}'
                 else '{"detected_objects":[{"class":"Bike","detectedobjectid":' || (k % 2)
                   || ',"velocity":{"x":' || cast(value as __STR__) || ',"y":' || k || '}}]}'
               end as data,
               event_type || '-' || (k % 3) as name,
               case event_type when 'view' then 'ObjectDwellEvent'
                 when 'click' then 'ObjectEnterEvent' else 'ObjectLeaveEvent' end as type,
               'o' || (user_id % 3) as orgid, 's' || (user_id % 10) as siteid,
               'e' || (user_id % 40) as trafficdetectioneventid,
               'v' || event_id as updated
        from {ticks}""",
    "samples": f"""
        select 'n' || user_id as nodeid,
               case k % 10 when 0 then 'T' when 1 then 'zz' when 2 then 'mw' else 'w' end as sensor,
               time,
               cast(time - {BASE_US} as double) / 3.6e9 * (50 + user_id % 40) + value / 1e1 as value
        from {{ticks}}""",
    "settings": """
        select 's' || (c_custkey % 10) as siteid, 'n' || c_custkey as nodeid,
               cast(60 + c_custkey % 50 as double) as legacy_power,
               cast(40 as double) as max_led_power
        from {customer}""",
    "occupancy": """
        select 'r' || (user_id % 5) as siteid, time as since,
               event_type in ('click', 'purchase', 'signup') as occupancy,
               'p' || user_id as parkingspotid, 'z' || (user_id __DIV__ 15) as parkingzoneid
        from {ticks}""",
    "spots": """
        select 'p' || c_custkey as parkingspotid, 'z' || (c_custkey __DIV__ 15) as parkingzoneid,
               c_custkey % 5 <> 0 as demarcated, c_custkey % 7 <> 0 as active
        from {customer}""",
    "zones": """
        select 'r' || (s_nationkey % 5) as siteid, 'o' || s_nationkey as orgid,
               'g' || (s_suppkey __DIV__ 4) as parkinggroupid, 'z' || s_suppkey as parkingzoneid,
               case s_suppkey % 5 when 3 then 'NonDemarcated' when 4 then 'Street'
                 else 'Demarcated' end as type,
               case s_suppkey % 7
                 when 0 then 'na'
                 when 1 then '{"roi":{"world_bounding_box":[[{"latitude":1.0'
                 when 2 then '{"roi":{"world_bounding_box":[[{"latitude":37.5,"longitude":-122.1},{}]]}}'
                 when 3 then '{"roi":{"world_bounding_box":[[{"latitude":"37.5","longitude":"-122.1"},'
                   || '{"latitude":"0","longitude":"0"},{"latitude":"37.5003","longitude":"-122.1'
                   || (s_suppkey % 10) || '"}]]}}'
                 else '{"roi":{"world_bounding_box":[[{"latitude":37.5,"longitude":-122.1},'
                   || '{"latitude":0,"longitude":0},{"latitude":' || cast(3.75e1 + s_acctbal / 1e7 as __STR__)
                   || ',"longitude":-122.1}]]}}'
               end as config
        from {supplier}""",
    "parking_groups": """
        select distinct 'g' || (s_suppkey __DIV__ 4) as parkinggroupid,
               'group ' || (s_suppkey __DIV__ 4) as name,
               cast(null as __STR__) as description,
               'z' || (s_suppkey __DIV__ 4 * 4) || ',z' || (s_suppkey __DIV__ 4 * 4 + 1)
                 || ',,z' || (s_suppkey __DIV__ 4 * 4 + 2) || ',z' || (s_suppkey __DIV__ 4 * 4 + 3) || ','
                 as parkingzones
        from {supplier}""",
    "alarms": """
        select 'n' || user_id as nodeid,
               case event_type when 'error' then 'CommFail' when 'view' then 'HardFault'
                 when 'click' then 'Clear' when 'signup' then 'NotListed' else 'Minor' end as alarmtype,
               time __DIV__ 1000 as alarmdate, 'u' || event_id as dateuuid,
               'k=' || k as message, cast(k % 5 as __STR__) as severitycode
        from {ticks}""",
    "status_with_gaps": """
        select nodeid, time, case when channel = 0 then null else active end as active,
               nullif(channel, 1) as channel, nullif(count, 7) as count,
               nullif(data, 'not json') as data,
               case when channel = 2 then null else name end as name,
               case when channel = 3 then null else type end as type,
               nullif(orgid, 'o1') as orgid, nullif(siteid, 's4') as siteid,
               nullif(trafficdetectioneventid, 'e5') as trafficdetectioneventid,
               nullif(updated, 'v3') as updated
        from {traffic_status}""",
    "filters": """
        select case when c_acctbal > 2000 then 'connection_nodes' else 'other_nodes' end as type,
               'n' || c_custkey as obj
        from {customer}""",
    "orgs": """
        select 'o' || s_suppkey as orgid, s_name as name,
               case when s_suppkey % 3 = 0 then 'partner' else 'customer' end as type,
               case when s_suppkey % 4 = 0 then null else 'c' || s_nationkey end as country
        from {supplier}""",
    "org_edges": """
        select 'o' || s_suppkey as orgid, 'o' || (s_suppkey __DIV__ 10) as parent_orgid
        from {supplier} where s_suppkey >= 10""",
    "sites": """
        select 's' || c_custkey as siteid, c_name as name, c_mktsegment as address,
               cast(c_nationkey as __STR__) as country,
               case c_nationkey % 5 when 0 then 'America/Los_Angeles' when 1 then 'Europe/London'
                 when 2 then 'Asia/Kolkata' when 3 then 'Australia/Sydney' else 'UTC' end as time_zone
        from {customer}""",
    "site_org": """
        select 's' || c_custkey as siteid, 'o' || (c_custkey __DIV__ 15) as orgid
        from {customer} where c_custkey % 11 <> 0""",
    "nodes": """
        select 'n' || o_orderkey as nodeid, 'node ' || o_orderkey as name,
               o_orderpriority as model,
               case when o_orderkey % 9 = 0 then null else 'b' || (o_orderkey % 50) end as bssid,
               case when o_orderstatus = 'F' then __ARRAY__('Node', 'Active')
                 else __ARRAY__('Node') end as labels
        from {orders}""",
    "node_site": """
        select 'n' || o_orderkey as nodeid, 's' || o_custkey as siteid
        from {orders} where o_orderkey % 13 <> 0""",
    "fixtures": """
        select 'f' || l_orderkey || '-' || l_linenumber as fixtureid,
               case when l_linenumber = 6 then '' else cast(max(l_quantity) as __STR__)
                 || case when max(l_partkey) % 2 = 0 then 'W' else ' w' end end as LegacyPowerDraw,
               case when max(l_suppkey) % 17 = 0 then null
                 else (max(l_partkey) % 40) || 'W' end as PowerDraw
        from {lineitem} group by l_orderkey, l_linenumber""",
    "site_fixture": """
        select distinct 'f' || l_orderkey || '-' || l_linenumber as fixtureid, 's' || o_custkey as siteid
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "fixture_node": """
        select distinct 'f' || l_orderkey || '-' || l_linenumber as fixtureid, 'n' || l_orderkey as nodeid
        from {lineitem}""",
    "groups": """
        select 'g' || p_partkey as groupid, p_name as name, p_brand as description,
               case p_partkey % 4
                 when 0 then __ARRAY__('Group', 'LightingGroup')
                 when 1 then __ARRAY__('Group', 'ParkingGroup')
                 else __ARRAY__('Group') end as labels
        from {part}""",
    "site_group": """
        select 'g' || p_partkey as groupid, 's' || (p_partkey * 3 __DIV__ 4) as siteid
        from {part}""",
    "group_node": """
        select distinct 'g' || l_partkey as groupid, 'n' || l_orderkey as nodeid
        from {lineitem}""",
    "users": """
        select 'u' || c_custkey as userid, c_name as name, c_mktsegment as roles,
               case when c_acctbal >= 0 then __ARRAY__('User', 'Active')
                 else __ARRAY__('User') end as labels
        from {customer}""",
    "user_org": """
        select 'u' || c_custkey as userid, 'o' || (c_custkey __DIV__ 15) as orgid
        from {customer}""",
}

# Declared, so that reading a table does not start a job to infer its schema.
BENCHMARK_TABLES = {
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def _render(sql: str, engine: str) -> str:
    for token, text in _TOKENS[engine].items():
        sql = sql.replace(f"__{token}__", text)
    return sql


def inputs_of(name: str) -> list[str]:
    known = set(_TABLES) | set(BENCHMARK_TABLES)
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", _TABLES[name])) if n in known]


def table(
    spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None
) -> DataFrame:
    """A benchmark table or a stand-in as a lazy frame; ``given`` frames replace tables."""
    if given and name in given:
        return given[name]
    if name in BENCHMARK_TABLES:
        return spark.read.schema(BENCHMARK_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    sql = _render(_TABLES[name], "spark")
    frames = {}
    for source in inputs_of(name):
        frames[f"src_{source}"] = table(spark, sf_dir, source, given)
        sql = sql.replace(f"{{{source}}}", f"@src_{source}@")
    # Braces that are left belong to JSON text, not to frame references.
    sql = sql.replace("{", "{{").replace("}", "}}")
    sql = re.sub(r"@(src_\w+)@", r"{\1}", sql)
    return spark.sql(sql, **frames)


def ctes(*names: str) -> str:
    """``WITH`` list of the named stand-ins and everything they need, for the check engine."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in BENCHMARK_TABLES or name in ordered:
            return
        for source in inputs_of(name):
            visit(source)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in ordered:
        sql = _render(_TABLES[name], "check")
        for source in inputs_of(name):
            sql = sql.replace(f"{{{source}}}", source)
        parts.append(f"{name} as ({sql})")
    return ",\n".join(parts)


def absent(columns: Sequence[str], *present: str) -> str:
    """SQL for the declared columns that the benchmark tables cannot fill."""
    return ", ".join(f"'' as {c}" for c in columns if c not in present)


def _grid(spark: SparkSession, sf_dir: str, start: str) -> Grid:
    """The grid over all rows; its window ends inside the bucket behind the last one."""
    start_us, end_us = table(spark, sf_dir, "bounds").select(start, "grid_end").first()
    if start_us is None:
        return Grid(BASE_US, BASE_US)
    return Grid(start_us, end_us + times.BUCKET_US - times.SECOND_US)


def energy_grid(spark: SparkSession, sf_dir: str) -> Grid:
    return _grid(spark, sf_dir, "energy_start")


def parking_grid(spark: SparkSession, sf_dir: str) -> Grid:
    return _grid(spark, sf_dir, "parking_start")


# The same in SQL.
GRID_END = "(select grid_end from bounds)"
ENERGY_START, PARKING_START = "(select energy_start from bounds)", "(select parking_start from bounds)"
ENERGY_SIZE = "(select (grid_end - energy_start) // 900000000 from bounds)"
PARKING_SIZE = "(select (grid_end - parking_start) // 900000000 from bounds)"

LABELS = """strftime(make_timestamp(starttime), '%Y-%m-%d %H:%M') as startdt,
       strftime(make_timestamp(endtime), '%Y-%m-%d %H:%M') as enddt,
       strftime(make_timestamp(starttime), '%Y-%m-%d %H') as starthr,
       strftime(make_timestamp(starttime), '%Y-%m-%d') as startday"""
