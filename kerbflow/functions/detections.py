"""Reading the detection document attached to a traffic event.

Class and object id are kept as variants and taken as compact JSON text, so a number and
a quoted number stay distinguishable: a text id keeps its quotes.  Speed components are
read as doubles; a quoted number is not a speed component.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_VECTOR = "struct<x double, y double>"
DETECTION_TYPE = (
    "struct<class variant, detectedobjectid variant, "
    f"velocity {_VECTOR}, world_velocity {_VECTOR}>"
)
# Strict JSON only.
_OPTIONS = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def _list_of(document: Column, element: str) -> Column:
    parsed = F.from_json(document, f"detected_objects array<{element}>", _OPTIONS)
    return parsed["detected_objects"]


def _loose_detection(value: Column) -> Column:
    """A detection from any JSON value; members it lacks are null."""

    def number(path: str) -> Column:
        return F.to_json(F.try_variant_get(value, path, "variant")).try_cast("double")

    def vector(member: str) -> Column:
        return F.struct(number(f"$.{member}.x").alias("x"), number(f"$.{member}.y").alias("y"))

    return F.struct(
        F.try_variant_get(value, "$.class", "variant").alias("class"),
        F.try_variant_get(value, "$.detectedobjectid", "variant").alias("detectedobjectid"),
        vector("velocity").alias("velocity"),
        vector("world_velocity").alias("world_velocity"),
    )


def detected_objects(document: Column) -> Column:
    """Array of detections; null for a missing list or unreadable JSON.

    Well-formed lists take the typed parse.  A list with an element that is not an object
    fails it as a whole; only then is the document parsed again, element by element.
    """
    typed = _list_of(document, DETECTION_TYPE)
    loose = F.transform(_list_of(document, "variant"), _loose_detection)
    return F.coalesce(typed, loose)


def _json_text(value: Column) -> Column:
    return F.coalesce(F.to_json(value), F.lit(""))


def class_text(detection: Column) -> Column:
    """Object class in lower case without quotes; empty when missing."""
    return F.lower(F.replace(_json_text(detection["class"]), F.lit('"'), F.lit("")))


def id_text(detection: Column) -> Column:
    """Object id as JSON text; empty when missing."""
    return _json_text(detection["detectedobjectid"])


def vector_length(x: Column, y: Column) -> Column:
    return F.sqrt(x * x + y * y)


def _speed_at(detection: Column, member: str) -> Column:
    return F.coalesce(vector_length(detection[member]["x"], detection[member]["y"]), F.lit(0.0))


def object_speed(detection: Column) -> Column:
    """Speed from ``velocity``; if that is zero or unreadable, from ``world_velocity``."""
    own = _speed_at(detection, "velocity")
    return F.when(own != 0.0, own).otherwise(_speed_at(detection, "world_velocity"))
