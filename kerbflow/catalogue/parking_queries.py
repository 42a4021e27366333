"""Parking: occupancy buckets, end states, capacity and area rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.catalogue import register
from kerbflow.catalogue.standins import GRID_END, LABELS, PARKING_SIZE, PARKING_START, ctes, parking_grid, table
from kerbflow.operators import scans
from kerbflow.operators.intervals import bucket_overlap
from kerbflow.operators.sequences import with_next
from kerbflow.plans import capacity, dimensions, parking

_START, _END, _N = PARKING_START, GRID_END, PARKING_SIZE

CAPACITY = (
    "with "
    + ctes("occupancy", "zones", "spots", "parking_groups", "bounds")
    + """,
marked as (
  select parkingzoneid, count(distinct parkingspotid) as capacity
  from spots where demarcated and active group by 1),
corners as (
  select *, try_cast(json_extract_string(doc, '$.roi.world_bounding_box[0][0].latitude') as double) as lat1,
    try_cast(json_extract_string(doc, '$.roi.world_bounding_box[0][0].longitude') as double) as lon1,
    try_cast(json_extract_string(doc, '$.roi.world_bounding_box[0][2].latitude') as double) as lat2,
    try_cast(json_extract_string(doc, '$.roi.world_bounding_box[0][2].longitude') as double) as lon2
  from (select *, case when json_valid(config) then config end as doc
        from zones where type = 'NonDemarcated') z),
measured as (
  select siteid, orgid, parkinggroupid, parkingzoneid, type as ptype, config,
    case when config = 'na' then null else coalesce(cast(floor(6371000.0 * sqrt(
      pow(radians(lon2 - lon1) * cos((radians(lat1) + radians(lat2)) / 2.0), 2)
      + pow(radians(lat2) - radians(lat1), 2)) / 4.9 + 0.5) as bigint), 0) end as capacity
  from corners),
capacities as (
  select z.siteid, z.orgid, z.parkinggroupid, z.parkingzoneid, z.type as ptype, z.config, m.capacity
  from zones z left join marked m on z.parkingzoneid = m.parkingzoneid where z.type = 'Demarcated'
  union all by name select * from measured)"""
)

# Spots occupied when the grid starts: every third one.
_OCCUPIED_BEFORE = "cast(substr(parkingspotid, 2) as bigint) % 3 = 0"

SPOTS = (
    CAPACITY
    + f""",
prior as (
  select parkingspotid, {_OCCUPIED_BEFORE} as occupancy from spots),
heard as (
  select parkingspotid, since, occupancy, parkingzoneid from occupancy
  where since >= {_START} - 900000000 and since < {_END}),
silent as (
  select p.parkingspotid, cast({_START} as bigint) as since, true as occupancy, s.parkingzoneid
  from prior p join spots s on p.parkingspotid = s.parkingspotid
  where p.occupancy and p.parkingspotid not in (select parkingspotid from heard)),
changes as (
  select * from (select * from heard union all by name select * from silent) a
  where parkingzoneid in (select parkingzoneid from capacities)),
stretches as (
  select c.parkingspotid, c.since, c.occupancy,
    coalesce(lag(c.occupancy) over seen, p.occupancy, false) as was,
    coalesce(lead(c.since) over seen, {_END}) as until_us, false as is_start
  from changes c left join prior p on c.parkingspotid = p.parkingspotid
  window seen as (partition by c.parkingspotid order by c.since, c.occupancy)
  union all by name
  select c.parkingspotid, cast(0 as bigint) as since, coalesce(any_value(p.occupancy), false) as occupancy,
    false as was, min(c.since) as until_us, true as is_start
  from changes c left join prior p on c.parkingspotid = p.parkingspotid group by 1),
covered as (
  select s.parkingspotid, b.i, sum(least(s.until_us, {_START} + (b.i + 1) * 900000000)
    - greatest(s.since, {_START} + b.i * 900000000)) as occ
  from stretches s cross join (select unnest(range({_N})) as i) b
  where s.occupancy and s.since < {_START} + (b.i + 1) * 900000000
    and s.until_us > {_START} + b.i * 900000000
  group by 1, 2),
turns as (
  select parkingspotid, (since - {_START}) // 900000000 as i, count(*) as n
  from stretches where not is_start and since >= {_START} and occupancy and not was group by 1, 2),
ends as (
  select b.parkingspotid, b.i, s.occupancy from (
    select distinct c.parkingspotid, r.i, {_START} + (r.i + 1) * 900000000 as bucket_end
    from changes c cross join (select unnest(range({_N})) as i) r) b
  asof join stretches s on b.parkingspotid = s.parkingspotid
    and b.bucket_end > s.since),
first_zone as (
  select parkingspotid, arg_min(parkingzoneid, since) as parkingzoneid from changes group by 1),
bridge as (
  select min(parkinggroupid) as groupid, parkingzoneid from (
    select parkinggroupid, unnest(string_split(parkingzones, ',')) as parkingzoneid from parking_groups) g
  where length(parkingzoneid) > 0 group by 2),
spot_facts as (
  select c.siteid, e.parkingspotid, cast({_START} + e.i * 900000000 as bigint) as starttime,
    coalesce(g.groupid, 'na') as groupid, z.parkingzoneid as zoneid, c.ptype as parkingtype,
    cast({_START} + (e.i + 1) * 900000000 as bigint) as endtime,
    cast(coalesce(o.occ, 0) as bigint) as occduration, cast(coalesce(t.n, 0) as integer) as turnovers,
    cast(coalesce(o.occ, 0) as double) / 900000000.0 * 100.0 as occpercent, e.occupancy
  from ends e
  join first_zone z on e.parkingspotid = z.parkingspotid
  join capacities c on z.parkingzoneid = c.parkingzoneid
  left join bridge g on z.parkingzoneid = g.parkingzoneid
  left join covered o on e.parkingspotid = o.parkingspotid and e.i = o.i
  left join turns t on e.parkingspotid = t.parkingspotid and e.i = t.i)"""
)

ZONES = (
    SPOTS
    + """,
zone_facts as (
  select s.zoneid, s.starttime, s.siteid, min(s.groupid) as groupid, s.parkingtype,
    min(s.endtime) as endtime, avg(nullif(s.occduration, 0)) as occduration,
    cast(sum(s.turnovers) as bigint) as turnovers,
    round(100 * sum(s.occduration) / (nullif(c.capacity, 0) * 900000000.0), 1) as occpercent,
    c.capacity, cast(sum(case when s.occduration = 0 then 0 else 1 end) as bigint) as filled_cnt
  from spot_facts s join capacities c on c.parkingzoneid = s.zoneid
  group by s.zoneid, s.starttime, s.siteid, s.parkingtype, c.capacity)"""
)


def zone_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity.zone_capacity(table(spark, sf_dir, "zones"), table(spark, sf_dir, "spots"))


def prior_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "spots").select(
        "parkingspotid", F.expr(_OCCUPIED_BEFORE).alias("occupancy")
    )


def heard_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = parking_grid(spark, sf_dir)
    occupancy = table(spark, sf_dir, "occupancy")
    return scans.time_window(occupancy, "since", grid.start_us, grid.until_us, grid.width_us)


def spot_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.spot_15min(
        heard_events(spark, sf_dir),
        prior_states(spark, sf_dir),
        table(spark, sf_dir, "spots"),
        zone_capacity(spark, sf_dir),
        dimensions.zone_group_bridge(table(spark, sf_dir, "parking_groups")),
        parking_grid(spark, sf_dir),
    )


def zone_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.zone_rollup(spot_facts(spark, sf_dir))


@register(
    "parking_15min_spot",
    SPOTS
    + f"""
select * exclude (occupancy, occpercent), round(occpercent, 6) as occpercent, {LABELS}
from spot_facts""",
)
def parking_15min_spot(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = spot_facts(spark, sf_dir).drop("occupancy", "capacity")
    return facts.withColumn("occpercent", F.round("occpercent", 6))


@register("parking_state", SPOTS + "\nselect siteid, starttime, parkingspotid, occupancy from spot_facts")
def parking_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.end_states(spot_facts(spark, sf_dir))


@register(
    "parking_zone",
    ZONES
    + f"""
select * exclude (occduration), round(occduration, 3) as occduration, {LABELS} from zone_facts""",
)
def parking_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_facts(spark, sf_dir).withColumn("occduration", F.round("occduration", 3))


def _area_sql(keys: str) -> str:
    return f"""
select *, {LABELS} from (
  select {keys}, min(endtime) as endtime,
    round(sum(occduration * filled_cnt) / sum(nullif(filled_cnt, 0)), 0) as occduration,
    cast(sum(turnovers) as bigint) as turnovers,
    round(sum(occpercent * capacity) / sum(nullif(capacity, 0)), 1) as occpercent
  from zone_facts group by {keys}) rolled"""


@register("parking_group", ZONES + _area_sql("groupid, starttime, parkingtype, siteid"))
def parking_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.area_rollup(zone_facts(spark, sf_dir), "groupid")


@register("parking_site", ZONES + _area_sql("siteid, starttime, parkingtype"))
def parking_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.area_rollup(zone_facts(spark, sf_dir), "siteid")


@register("join_anti_carry", SPOTS + "\nselect parkingspotid, since, occupancy, parkingzoneid from silent")
def join_anti_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parking.silent_occupied(
        heard_events(spark, sf_dir),
        prior_states(spark, sf_dir),
        table(spark, sf_dir, "spots"),
        parking_grid(spark, sf_dir),
    )


@register(
    "capacity_demarcated",
    CAPACITY
    + """
select siteid, orgid, parkinggroupid, parkingzoneid, ptype, config, capacity
from capacities where ptype = 'Demarcated'""",
)
def capacity_demarcated(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = table(spark, sf_dir, "zones").withColumnRenamed("type", "ptype")
    return capacity.demarcated_capacity(zones, table(spark, sf_dir, "spots"))


@register("capacity_geometry", CAPACITY + "\nselect * from measured")
def capacity_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity.geometric_capacity(
        table(spark, sf_dir, "zones").withColumnRenamed("type", "ptype")
    )


@register(
    "interval_overlap",
    "with "
    + ctes("occupancy", "bounds")
    + f""",
stretches as (
  select parkingspotid, since, occupancy,
    coalesce(lead(since) over (partition by parkingspotid order by since, occupancy), {_END}) as until_us
  from occupancy)
select parkingspotid, cast({_START} + b.i * 900000000 as bigint) as starttime,
  cast(sum(least(until_us, {_START} + (b.i + 1) * 900000000)
    - greatest(since, {_START} + b.i * 900000000)) as bigint) as covered_us
from stretches s cross join (select unnest(range({_N})) as i) b
where occupancy and since < {_START} + (b.i + 1) * 900000000 and until_us > {_START} + b.i * 900000000
group by 1, 2""",
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = parking_grid(spark, sf_dir)
    changes = with_next(
        table(spark, sf_dir, "occupancy"), ["parkingspotid"], ["since", "occupancy"], []
    )
    stretches = changes.filter("occupancy").withColumn(
        "until_us", F.coalesce("following.since", F.lit(grid.end_us))
    )
    return bucket_overlap(stretches, ["parkingspotid"], "since", "until_us", grid)
