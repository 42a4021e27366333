"""Traffic events to object facts, transitions and rollups.

``object_facts`` reads each event once.  A filter on the event type separates dwell from
other events before the document is parsed, so routing does not parse anything twice.
``with_transitions`` emits a fact and its transition in one pass over one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions import detections, times
from kerbflow.functions.values import zero_as_null
from kerbflow.operators.sequences import with_recent_previous

DWELL_TYPE = "ObjectDwellEvent"
TRANSITION_TYPE = "COMBO"
MIN_DWELL_US = 2_000_000.0
TRANSITION_GAP_US = 60 * times.SECOND_US
NO_OBJECT = ("na", "")  # ids of objects without one

FACT_COLUMNS = (
    "nodeid", "starttime", "eventtype", "eventname", "eventid", "data", "eventtime",
    "objectclass", "objectid", "objectvelocity", "dwell", "siteid",
)
DWELL_KEYS = (
    "nodeid", "starttime", "eventtype", "eventid", "objectclass", "objectid", "siteid",
)


def expand_detections(status: DataFrame) -> DataFrame:
    """One row per detected object; one "na" row without speed if there is none."""
    found, present = F.col("detection"), F.col("position").isNotNull()
    dwell = F.when(F.col("type") == DWELL_TYPE, F.col("time").cast("double")).otherwise(0.0)
    each = F.posexplode_outer(detections.detected_objects(F.col("data")))
    # The texts are a projection of their own, so that each is built once per row.
    texts = status.select("*", each.alias("position", "detection")).withColumns(
        {
            "class_text": detections.class_text(found),
            "id_text": detections.id_text(found),
            "speed": detections.object_speed(found),
        }
    )
    named = F.when(present & (F.length("class_text") > 0), F.col("class_text"))
    return texts.select(
        "nodeid",
        times.bucket_start(F.col("time")).alias("starttime"),
        F.col("type").alias("eventtype"),
        F.col("name").alias("eventname"),
        F.col("trafficdetectioneventid").alias("eventid"),
        "data",
        F.col("time").alias("eventtime"),
        F.coalesce(named, F.lit("na")).alias("objectclass"),
        F.when(present, F.col("id_text")).otherwise("na").alias("objectid"),
        F.when(present, F.col("speed")).alias("objectvelocity"),
        F.when(present, dwell).alias("dwell"),
        "siteid",
    )


def collapse_dwell(dwell_rows: DataFrame) -> DataFrame:
    """One row per dwelling object and bucket; its stay is last minus first, plus 2 s."""
    stay = F.max("dwell") - F.min("dwell") + F.lit(MIN_DWELL_US)
    return (
        dwell_rows.groupBy(*DWELL_KEYS)
        .agg(
            F.min("eventname").alias("eventname"),
            F.min("data").alias("data"),
            F.min("eventtime").alias("eventtime"),
            F.lit(0.0).alias("objectvelocity"),
            stay.alias("dwell"),
        )
        .select(*FACT_COLUMNS)
    )


def object_facts(status: DataFrame) -> DataFrame:
    is_dwell = F.col("type") == DWELL_TYPE
    passing = expand_detections(status.filter(~is_dwell))
    dwelling = collapse_dwell(expand_detections(status.filter(is_dwell)))
    return passing.unionByName(dwelling)


def with_transitions(facts: DataFrame, slice_us: int = times.BUCKET_US) -> DataFrame:
    """Facts plus one transition row wherever an object was seen at the same node less
    than 60 s before; named ``node==>previous event==>this event``.

    Objects without an id of their own count as one object of their node, which may bring
    any number of rows in a minute.
    """
    paired = with_recent_previous(
        facts,
        ["nodeid", "objectid"],
        ["eventtime", "eventtype", "eventid", "objectclass", "eventname", "siteid"],
        ["eventname"],
        TRANSITION_GAP_US,
        slice_us=slice_us,
        busy=F.col("objectid").isin(*NO_OBJECT),
    )
    # A flag per emitted row rather than arrays of whole rows, so that columns a caller
    # does not use (the document above all) are pruned before the shuffle.
    flags = F.when(F.col("previous").isNull(), F.array(F.lit(False))).otherwise(
        F.array(F.lit(False), F.lit(True))
    )
    path = F.concat_ws("==>", "nodeid", "previous.eventname", "eventname")
    changed = {
        "eventtype": F.lit(TRANSITION_TYPE),
        "eventname": path,
        "eventid": path,
        "data": F.lit("na"),
        "objectvelocity": F.lit(None).cast("double"),
        "dwell": F.lit(None).cast("double"),
    }
    emitted = paired.withColumn("is_transition", F.explode(flags))
    return emitted.select(
        *(
            F.when(F.col("is_transition"), changed[c]).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in FACT_COLUMNS
        )
    )


def transitions(facts: DataFrame) -> DataFrame:
    return with_transitions(facts).filter(F.col("eventtype") == TRANSITION_TYPE)


def traffic_facts(status: DataFrame, slice_us: int = times.BUCKET_US) -> DataFrame:
    """Everything the rollups count: objects, collapsed dwells and transitions."""
    return with_transitions(object_facts(status), slice_us)


def _measures(by_event: bool) -> list[Column]:
    speed, dwell = zero_as_null(F.col("objectvelocity")), zero_as_null(F.col("dwell"))
    measures = [
        F.avg(speed).alias("avgvelocity"),
        F.avg(dwell).alias("avgdwell"),
        # One sketch per group serves both percentiles.
        F.percentile_approx(speed, F.array(F.lit(0.5), F.lit(0.85))).alias("_percentiles"),
        F.count("*").alias("eventcnt"),
    ]
    if by_event:
        measures = [F.min("eventname").alias("name"), F.max("nodeid").alias("nodeid"), *measures]
    return measures


GRAINS = {"15min": times.BUCKET_US, "1hr": times.HOUR_US, "1day": times.DAY_US}


def _keys(by_event: bool) -> list[str]:
    return ["siteid", "eventid"] if by_event else ["siteid"]


def _label(rolled: DataFrame, grain: Column, period: Column, by_event: bool) -> DataFrame:
    """Add the time columns after grouping, so labels are built once per result row.

    ``period`` is the grain's own start, ``starttime`` the earliest bucket seen in it.
    """
    width = F.col("_width")
    return rolled.select(
        *_keys(by_event),
        grain.alias("aggregation_type"),
        F.col("eventtype").alias("type"),
        "objectclass",
        "starttime",
        (period + width).alias("endtime"),
        times.minute_label(F.col("starttime")).alias("startdt"),
        times.minute_label(F.col("_laststart") + F.lit(times.BUCKET_US)).alias("enddt"),
        times.hour_label(F.col("starttime")).alias("starthr"),
        times.day_label(F.col("starttime")).alias("startday"),
        *(["name", "nodeid"] if by_event else []),
        "avgvelocity",
        "avgdwell",
        F.col("_percentiles")[0].alias("medianvelocity"),
        F.col("_percentiles")[1].alias("p85velocity"),
        "eventcnt",
    )


def rollup(facts: DataFrame, grain: str, by_event: bool) -> DataFrame:
    """Site or event rollup at one grain ("15min", "1hr" or "1day")."""
    width = GRAINS[grain]
    rolled = (
        facts.withColumn("period", times.bucket_start(F.col("starttime"), width))
        .groupBy(*_keys(by_event), "eventtype", "objectclass", "period")
        .agg(
            F.min("starttime").alias("starttime"),
            F.max("starttime").alias("_laststart"),
            *_measures(by_event),
        )
        .withColumn("_width", F.lit(width))
    )
    return _label(rolled, F.lit(grain), F.col("period"), by_event)


def rollup_all(facts: DataFrame, by_event: bool, grains: Sequence[str] = tuple(GRAINS)) -> DataFrame:
    """All wanted grains from one read of the facts, as grouping sets over the periods."""
    keys = [*_keys(by_event), "eventtype", "objectclass"]
    periods = {grain: f"_{grain}" for grain in grains}
    tagged = facts.withColumns(
        {col: times.bucket_start(F.col("starttime"), GRAINS[g]) for g, col in periods.items()}
    )
    sets = [[*(F.col(k) for k in keys), F.col(col)] for col in periods.values()]
    rolled = tagged.groupingSets(sets, *keys, *periods.values()).agg(
        F.min("starttime").alias("starttime"),
        F.max("starttime").alias("_laststart"),
        *_measures(by_event),
    )
    # Exactly one period column is set per grouping set.
    grain, width = F.lit(None).cast("string"), F.lit(None).cast("long")
    for name, col in periods.items():
        grain = F.coalesce(grain, F.when(F.col(col).isNotNull(), F.lit(name)))
        width = F.coalesce(width, F.when(F.col(col).isNotNull(), F.lit(GRAINS[name])))
    period = F.coalesce(*(F.col(col) for col in periods.values()))
    return _label(rolled.withColumn("_width", width), grain, period, by_event)


SKETCH_K = 512  # size of a percentile sketch; its rank error is below 1 % of the rows


def sketched(facts: DataFrame, by_event: bool, k: int = SKETCH_K) -> DataFrame:
    """15-minute parts that coarser grains can be merged from.

    Sums and counts in place of means, and a sketch of the speeds in place of percentiles;
    no grain has to read facts again.
    """
    speed, dwell = zero_as_null(F.col("objectvelocity")), zero_as_null(F.col("dwell"))
    names = [F.min("eventname").alias("name"), F.max("nodeid").alias("nodeid")] if by_event else []
    return facts.groupBy(*_keys(by_event), "eventtype", "objectclass", "starttime").agg(
        *names,
        F.sum(speed).alias("speed_sum"),
        F.count(speed).alias("speed_cnt"),
        F.sum(dwell).alias("dwell_sum"),
        F.count(dwell).alias("dwell_cnt"),
        F.kll_sketch_agg_double(speed, F.lit(k)).alias("speeds"),
        F.count("*").alias("eventcnt"),
    )


def merged_rollup(parts: DataFrame, grain: str, by_event: bool, k: int = SKETCH_K) -> DataFrame:
    """The rollup of one grain from :func:`sketched` parts.

    Counts and means are those of :func:`rollup`; the percentiles are those of the merged
    sketch, whose rank is off by less than 1 % of the rows (exact up to ``k`` rows).
    """
    width = GRAINS[grain]
    names = [F.min("name").alias("name"), F.max("nodeid").alias("nodeid")] if by_event else []
    merged = (
        parts.withColumn("period", times.bucket_start(F.col("starttime"), width))
        .groupBy(*_keys(by_event), "eventtype", "objectclass", "period")
        .agg(
            F.min("starttime").alias("starttime"),
            F.max("starttime").alias("_laststart"),
            *names,
            F.try_divide(F.sum("speed_sum"), F.sum("speed_cnt")).alias("avgvelocity"),
            F.try_divide(F.sum("dwell_sum"), F.sum("dwell_cnt")).alias("avgdwell"),
            F.sum("speed_cnt").alias("_speeds"),
            F.kll_merge_agg_double("speeds", F.lit(k)).alias("_sketch"),
            F.sum("eventcnt").alias("eventcnt"),
        )
    )
    quantiles = F.array(*(F.kll_sketch_get_quantile_double("_sketch", F.lit(p)) for p in (0.5, 0.85)))
    # An empty sketch has no quantiles to ask for.
    found = F.when(F.col("_speeds") > 0, quantiles)
    return _label(merged.withColumns({"_percentiles": found, "_width": F.lit(width)}), F.lit(grain), F.col("period"), by_event)
