"""How many vehicles a parking zone holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.values import ground_distance_m, vehicle_capacity

DEMARCATED = "Demarcated"
NON_DEMARCATED = "NonDemarcated"


def _corner(corner: int, member: str):
    path = f"$.roi.world_bounding_box[0][{corner}].{member}"
    return F.get_json_object("config", path).try_cast("double")


def demarcated_capacity(zones: DataFrame, spots: DataFrame) -> DataFrame:
    """Distinct active marked spots per zone; null for a zone without any."""
    counted = (
        spots.filter("demarcated and active")
        .groupBy("parkingzoneid")
        .agg(F.count_distinct("parkingspotid").alias("capacity"))
    )
    return zones.filter(F.col("ptype") == DEMARCATED).join(counted, "parkingzoneid", "left")


def geometric_capacity(zones: DataFrame) -> DataFrame:
    """Diagonal of the zone's first box in car lengths.

    Unreadable corners give 0; a zone without configuration gives null.
    """
    diagonal = ground_distance_m(
        _corner(0, "latitude"),
        _corner(0, "longitude"),
        _corner(2, "latitude"),
        _corner(2, "longitude"),
    )
    fitted = F.coalesce(vehicle_capacity(diagonal), F.lit(0).cast("long"))
    return zones.filter(F.col("ptype") == NON_DEMARCATED).withColumn(
        "capacity", F.when(F.col("config") != "na", fitted)
    )


def zone_capacity(zones: DataFrame, spots: DataFrame) -> DataFrame:
    """Zones of both known types with a bigint capacity; other types are left out."""
    typed = zones.withColumnRenamed("type", "ptype")
    return demarcated_capacity(typed, spots).unionByName(geometric_capacity(typed))
