"""Dimensions joined from vertex and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbflow.catalogue import register
from kerbflow.catalogue.standins import absent, ctes, table
from kerbflow.operators.grids import spread_by_key
from kerbflow.plans import dimensions
from kerbflow.plans.runs import Jobs
from kerbflow.session import scratch_path
from kerbflow.sources.store import TableStore


@register(
    "dim_site",
    "with "
    + ctes("sites", "site_org")
    + """
select s.siteid, coalesce(o.orgid, '') as orgid, name, country, time_zone, """
    + absent(dimensions.SITE_COLUMNS, "siteid", "orgid", "name", "country", "time_zone")
    + " from sites s left join site_org o on s.siteid = o.siteid",
)
def dim_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.site_dimension(table(spark, sf_dir, "sites"), table(spark, sf_dir, "site_org"))


@register(
    "dim_node",
    "with "
    + ctes("nodes", "node_site")
    + """
select distinct n.nodeid, s.siteid, name, model, coalesce(bssid, '') as bssid, """
    + absent(dimensions.NODE_COLUMNS, "nodeid", "siteid", "name", "model", "bssid")
    + " from nodes n join node_site s on n.nodeid = s.nodeid where list_contains(labels, 'Active')",
)
def dim_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.node_dimension(table(spark, sf_dir, "nodes"), table(spark, sf_dir, "node_site"))


@register(
    "dim_connection_nodes",
    "with "
    + ctes("nodes", "node_site")
    + """
select distinct 'connection_nodes' as type, n.nodeid as obj
from nodes n join node_site s on n.nodeid = s.nodeid where list_contains(labels, 'Active')""",
)
def dim_connection_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.connection_nodes(
        dimensions.node_dimension(table(spark, sf_dir, "nodes"), table(spark, sf_dir, "node_site"))
    )


@register(
    "dim_hierarchy",
    "with "
    + ctes("nodes", "node_site", "sites", "site_org", "orgs")
    + """,
path as (select ns.nodeid, s.siteid, s.name as sitename, s.address as siteaddress, o.orgid, o.name as orgname
  from node_site ns join sites s on ns.siteid = s.siteid join site_org so on s.siteid = so.siteid
  join orgs o on so.orgid = o.orgid)
select n.nodeid, coalesce(p.orgid, '') as orgid, coalesce(p.siteid, '') as siteid, n.name as nodename,
  coalesce(orgname, '') as orgname, coalesce(sitename, '') as sitename,
  coalesce(siteaddress, '') as siteaddress, coalesce(bssid, '') as bssid, n.model as nodehw
from nodes n left join path p on n.nodeid = p.nodeid""",
)
def dim_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("nodes", "node_site", "sites", "site_org", "orgs")
    return dimensions.node_hierarchy(*(table(spark, sf_dir, n) for n in names))


@register(
    "dim_customer",
    "with "
    + ctes("orgs", "org_edges")
    + """
select distinct c.orgid, c.name, c.type, coalesce(c.country, '') as country, """
    + absent(dimensions.CUSTOMER_COLUMNS, "orgid", "name", "type", "country")
    + " from orgs c join org_edges e on c.orgid = e.orgid join orgs p on e.parent_orgid = p.orgid",
)
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.customer_dimension(table(spark, sf_dir, "orgs"), table(spark, sf_dir, "org_edges"))


@register(
    "dim_user",
    "with "
    + ctes("users", "user_org")
    + """
select distinct u.userid, name, '' as email, roles, '' as updated, '' as created, orgid
from users u join user_org o on u.userid = o.userid where list_contains(labels, 'Active')""",
)
def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.user_dimension(table(spark, sf_dir, "users"), table(spark, sf_dir, "user_org"))


@register(
    "dim_partner",
    "with "
    + ctes("orgs", "org_edges")
    + """
select distinct p.orgid as partner_orgid, c.orgid as customer_orgid
from org_edges e join orgs p on e.parent_orgid = p.orgid join orgs c on e.orgid = c.orgid
where p.type = 'partner'""",
)
def dim_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "org_edges").withColumnsRenamed(
        {"orgid": "customer_orgid", "parent_orgid": "partner_orgid"}
    )
    return dimensions.partner_dimension(table(spark, sf_dir, "orgs"), edges)


_PATHS = (
    "with "
    + ctes("fixtures", "site_fixture", "fixture_node")
    + """,
paths as (
  select s.siteid, n.nodeid, f.fixtureid, LegacyPowerDraw as legacy_power, PowerDraw as max_led_power
  from (select * from fixtures
    where try_cast(replace(replace(replace(LegacyPowerDraw, 'W', ''), 'w', ''), ' ', '') as double)
      > try_cast(replace(replace(PowerDraw, 'W', ''), 'w', '') as double)) f
  join site_fixture s on f.fixtureid = s.fixtureid join fixture_node n on f.fixtureid = n.fixtureid)"""
)


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("site_fixture", "fixtures", "fixture_node")
    return dimensions.fixture_paths(*(table(spark, sf_dir, n) for n in names))


@register("dim_energy_settings", _PATHS + "\nselect * from paths")
def dim_energy_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.energy_settings_dimension(_paths(spark, sf_dir))


@register(
    "device_energy_settings",
    _PATHS
    + """
select siteid, nodeid,
  cast(replace(replace(replace(legacy_power, 'W', ''), 'w', ''), ' ', '') as double) as legacy_power,
  cast(replace(replace(max_led_power, 'W', ''), 'w', '') as double) as max_led_power from paths""",
)
def device_energy_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.device_energy_settings(_paths(spark, sf_dir))


@register(
    "energy_two_fixtures",
    _PATHS
    + """,
lamps as (
  select distinct nodeid, fixtureid,
    cast(replace(replace(replace(legacy_power, 'W', ''), 'w', ''), ' ', '') as double) as legacy_power,
    cast(replace(replace(max_led_power, 'W', ''), 'w', '') as double) as max_led_power from paths)
select p.siteid, nodeid, legacy_power, max_led_power
from (select nodeid, sum(legacy_power) as legacy_power, sum(max_led_power) as max_led_power
  from lamps group by 1) l
join (select nodeid, min(siteid) as siteid from paths group by 1) p using (nodeid)""",
)
def energy_two_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The settings table an energy run reads: the lamps of a node add up."""
    jobs = Jobs(TableStore(spark, scratch_path(spark, "settings")))
    return jobs.energy_settings(*(table(spark, sf_dir, n) for n in ("site_fixture", "fixtures", "fixture_node")))


@register(
    "dim_groups",
    "with "
    + ctes("site_group", "groups", "group_node")
    + """,
paths as (select s.siteid, g.groupid, g.name as groupname, g.description as groupdesc, n.nodeid,
  array_to_string(labels, ' ') || ' ' as labellist, labels
  from site_group s join groups g on s.groupid = g.groupid join group_node n on g.groupid = n.groupid)
select distinct * exclude (labels), 'Organizational' as grouptype from paths
where not list_contains(labels, 'LightingGroup') and not list_contains(labels, 'ParkingGroup')
union all by name
select * exclude (labels), 'Lighting' as grouptype from paths where list_contains(labels, 'LightingGroup')""",
)
def dim_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dealt out first, so that the pairs of a whole file piece are not made distinct in one task.
    lines = spread_by_key(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
    names = ("site_group", "groups", "group_node")
    return dimensions.node_groups(*(table(spark, sf_dir, n, given={"lineitem": lines}) for n in names))


@register(
    "bridge_explode",
    "with "
    + ctes("parking_groups")
    + """
select * from (
  select unnest(string_split(parkingzones, ',')) as parkingzoneid, parkinggroupid from parking_groups) b
where length(parkingzoneid) > 0""",
)
def bridge_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.zone_group_bridge(table(spark, sf_dir, "parking_groups"))
