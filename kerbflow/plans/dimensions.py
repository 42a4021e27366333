"""Dimensions from vertex and edge tables.

Vertices carry their attributes as columns and, where needed, ``labels array<string>``.
Edges are two id columns.  All results are text with "" for missing values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.values import strip_watt_unit, watts

# Attribute lists of the dimensions.
SITE_COLUMNS = (
    "siteid", "orgid", "name", "latitude", "longitude", "street1", "street2", "city",
    "state", "postal_code", "country", "region_code", "time_zone", "altitude", "created",
)
NODE_COLUMNS = (
    "nodeid", "siteid", "fixtureid", "fixtureType", "fixturename", "name", "serialnumber",
    "latitude", "longitude", "ip", "mac", "meshId", "channel", "baseStation", "server",
    "model", "auth", "softwareVersion", "pdprofileid", "signature", "schedulename",
    "building", "bssid", "configToken", "pdprofilename", "country_code", "scheduleid",
    "note", "circuit", "remoteNetwork", "abcd", "apn", "publicKey", "firmwareLastUpdated",
    "time_zone", "mfgDate",
)
FIXTURE_COLUMNS = (
    "name", "fixtureid", "MinPower100", "MinPower10", "description", "manufacturersku",
    "MinPower50", "fixtureType", "MaxPower10", "nemasocket",
    "MinimumLightLevelForFailureDetection", "MaxPower0", "MinPower0", "manufacturer",
    "PowerDraw", "MaxPower100", "MaxPower50", "BallastCost", "BulbCost", "LegacyPowerDraw",
    "DailyOperatingTime", "site",
)
USER_COLUMNS = ("userid", "name", "email", "roles", "updated", "created", "orgid")
CUSTOMER_COLUMNS = (
    "orgid", "name", "type", "contact_name", "contact_phone", "contact_email", "street1",
    "street2", "city", "state", "postal_code", "country", "created",
)
PARKING_GROUP_COLUMNS = (
    "parkinggroupid", "name", "description", "parkingzones", "vehicle_types", "policy",
    "created",
)
GROUP_COLUMNS = (
    "siteid", "groupid", "groupname", "groupdesc", "grouptype", "nodeid", "labellist",
)


def as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as text, "" for null and for attributes the vertices lack."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")

    return df.select(*(text(c).alias(c) for c in columns))


def has_label(label: str) -> Column:
    return F.array_contains("labels", label)


def site_dimension(sites: DataFrame, site_org: DataFrame) -> DataFrame:
    return as_text(sites.join(site_org, "siteid", "left"), SITE_COLUMNS)


def fixture_dimension(fixtures: DataFrame, columns: Sequence[str] = FIXTURE_COLUMNS) -> DataFrame:
    return as_text(fixtures, columns)


def node_dimension(nodes: DataFrame, node_site: DataFrame) -> DataFrame:
    active = nodes.filter(has_label("Active"))
    return as_text(active.join(node_site, "nodeid"), NODE_COLUMNS).distinct()


def connection_nodes(node_dim: DataFrame) -> DataFrame:
    """The filter table rows that list the known nodes."""
    return node_dim.select(F.lit("connection_nodes").alias("type"), F.col("nodeid").alias("obj"))


def node_hierarchy(
    nodes: DataFrame,
    node_site: DataFrame,
    sites: DataFrame,
    site_org: DataFrame,
    orgs: DataFrame,
) -> DataFrame:
    """Every node, with site and organisation where the whole path exists."""
    path = (
        node_site.join(
            sites.select("siteid", F.col("name").alias("sitename"), F.col("address").alias("siteaddress")),
            "siteid",
        )
        .join(site_org, "siteid")
        .join(orgs.select("orgid", F.col("name").alias("orgname")), "orgid")
    )
    joined = nodes.withColumnsRenamed({"name": "nodename", "model": "nodehw"}).join(
        path, "nodeid", "left"
    )
    return as_text(
        joined,
        ["nodeid", "orgid", "siteid", "nodename", "orgname", "sitename", "siteaddress", "bssid", "nodehw"],
    )


def customer_dimension(orgs: DataFrame, customer_of: DataFrame) -> DataFrame:
    """Organisations that are a customer of some organisation."""
    parents = orgs.select(F.col("orgid").alias("parent_orgid"))
    edges = customer_of.join(parents, "parent_orgid", "left_semi")
    return as_text(orgs.join(edges, "orgid"), CUSTOMER_COLUMNS).distinct()


def user_dimension(users: DataFrame, user_org: DataFrame) -> DataFrame:
    active = users.filter(has_label("Active"))
    return as_text(active.join(user_org, "userid"), USER_COLUMNS).distinct()


def partner_dimension(orgs: DataFrame, has_customer: DataFrame) -> DataFrame:
    partners = orgs.filter(F.col("type") == "partner").select(F.col("orgid").alias("partner_orgid"))
    customers = orgs.select(F.col("orgid").alias("customer_orgid"))
    pairs = has_customer.join(partners, "partner_orgid", "left_semi").join(
        customers, "customer_orgid", "left_semi"
    )
    return as_text(pairs, ["partner_orgid", "customer_orgid"]).distinct()


def parking_group_dimension(groups: DataFrame) -> DataFrame:
    return as_text(groups, PARKING_GROUP_COLUMNS).distinct()


def zone_group_bridge(parking_groups: DataFrame) -> DataFrame:
    """One row per zone listed in a group's comma list."""
    zone = F.explode(F.split("parkingzones", ",")).alias("parkingzoneid")
    return parking_groups.select(zone, "parkinggroupid").filter(F.length("parkingzoneid") > 0)


def fixture_paths(site_fixture: DataFrame, fixtures: DataFrame, fixture_node: DataFrame) -> DataFrame:
    """(site)-(fixture)-(node) where the replaced lamp drew more than the new one."""
    legacy = strip_watt_unit(F.col("LegacyPowerDraw")).try_cast("double")
    led = strip_watt_unit(F.col("PowerDraw")).try_cast("double")
    saving = fixtures.filter(legacy > led)
    return (
        saving.join(site_fixture, "fixtureid")
        .join(fixture_node, "fixtureid")
        .select(
            "siteid",
            "nodeid",
            "fixtureid",
            F.col("LegacyPowerDraw").alias("legacy_power"),
            F.col("PowerDraw").alias("max_led_power"),
        )
    )


def energy_settings_dimension(paths: DataFrame) -> DataFrame:
    return as_text(paths, ["siteid", "nodeid", "fixtureid", "legacy_power", "max_led_power"])


def device_energy_settings(paths: DataFrame) -> DataFrame:
    """Settings per path: numbers, 0.0 for empty text."""

    def power(name: str) -> Column:
        return F.coalesce(watts(F.col(name)), F.lit(0.0)).alias(name)

    return paths.select("siteid", "nodeid", power("legacy_power"), power("max_led_power"))


def node_energy_settings(paths: DataFrame) -> DataFrame:
    """Settings the energy rollup joins: one row per node.

    A node's meter measures all its fixtures, so their powers add up; a fixture that is
    reached twice counts once.  A node of several sites belongs to the smallest id.
    """
    lamps = device_energy_settings(paths.dropDuplicates(["nodeid", "fixtureid"]))
    per_node = lamps.groupBy("nodeid").agg(
        F.sum("legacy_power").alias("legacy_power"), F.sum("max_led_power").alias("max_led_power")
    )
    site = paths.groupBy("nodeid").agg(F.min("siteid").alias("siteid"))
    return per_node.join(site, "nodeid").select("siteid", "nodeid", "legacy_power", "max_led_power")


def counted(df: DataFrame, columns: Sequence[str], rows: str) -> DataFrame:
    """Rows of a group as text, equal ones once and counted in ``rows``.

    They are dealt out before they are counted, and tasks must not be merged because their
    input packs well: a task then counts its share and nothing else.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = as_text(df.filter("groupid is not null"), columns)
    return texts.repartition(count, *columns).groupBy(*columns).agg(F.count("*").alias(rows))


def node_groups(site_group: DataFrame, groups: DataFrame, group_node: DataFrame) -> DataFrame:
    """Organizational groups (distinct) and lighting groups with their nodes.

    Both kinds come from one join.  Equal rows are counted in each table, while they are
    narrow, so the joined rows differ from each other and need no grouping of their own; only
    lighting rows are given out as often as the counts say.
    """
    kind = F.when(has_label("LightingGroup"), "Lighting").when(~has_label("ParkingGroup"), "Organizational")
    labelled = groups.select(
        "groupid",
        kind.alias("grouptype"),
        F.col("name").alias("groupname"),
        F.col("description").alias("groupdesc"),
        # Every label is followed by a blank.
        F.concat(F.array_join("labels", " "), F.when(F.size("labels") > 0, " ").otherwise("")).alias(
            "labellist"
        ),
    ).filter("grouptype is not null")
    paths = (
        counted(labelled, labelled.columns, "_groups")
        .join(counted(site_group, ["groupid", "siteid"], "_sites"), "groupid")
        .join(counted(group_node, ["groupid", "nodeid"], "_nodes"), "groupid")
    )
    times_out = F.when(F.col("grouptype") == "Lighting", F.col("_groups") * F.col("_sites") * F.col("_nodes")).otherwise(1)
    return paths.select(*GROUP_COLUMNS, F.explode(F.sequence(F.lit(1), times_out)).alias("_row")).drop("_row")
