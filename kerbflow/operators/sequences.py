"""Neighbouring rows of a keyed, time-ordered sequence, without one task per key.

A window over the bare key would pull every row of a busy key into one task.  Here each
key's time line is cut into slices and the neighbour is looked up inside ``(key, slice)``.
Only a slice's first and last row go one level up, to wider slices, and so on to the key:
the last row of a slice is what the first row of the next non-empty one looks for.  Rows
that have found their neighbour are done and move no further, so raw rows are scanned and
shuffled once, and no task holds more than one slice of a key or two rows for each slice
below.  The shuffle by ``(key, slice)`` is explicit, because a partitioning by the bare key
left by an earlier join would also satisfy the window.

``order`` must identify a row within its key (time first, then tie breakers); tables
kept by ``versions.upsert`` meet this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.times import HOUR_US, MINUTE_US, SECOND_US, bucket_start

SLICE = "_slice"
# Slice widths, finest first: for rows seconds to minutes apart, and for dense ones.  By key
# alone then meet at most two rows for each hour.
LEVELS = (HOUR_US,)
DENSE_LEVELS = (MINUTE_US, HOUR_US)


def _returned(time: str, payload: Sequence[str]) -> Column:
    """The struct handed to the caller: the neighbour's time and payload."""
    return F.struct(*(F.col(c) for c in dict.fromkeys([time, *payload])))


def _neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    name: str,
    levels: Sequence[int],
    forward: bool,
) -> DataFrame:
    time = order[0]
    pick, other = (F.lead, F.lag) if forward else (F.lag, F.lead)
    waiting = df.withColumn("_waits", F.lit(True))
    done = []
    for width in [*levels, None]:
        if width is None:
            inside = Window.partitionBy(*keys).orderBy(*order)
        else:
            waiting = waiting.withColumn(SLICE, bucket_start(F.col(time), width)).repartition(*keys, SLICE)
            inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
        paired = waiting.withColumns(
            {
                name: pick(_returned(time, payload)).over(inside),
                "_opens": pick(F.lit(1)).over(inside).isNull(),
                "_closes": other(F.lit(1)).over(inside).isNull(),
            }
        )
        settled = F.col("_waits") if width is None else F.col("_waits") & ~F.col("_opens")
        done.append(paired.filter(settled).select(*df.columns, name))
        still = F.col("_waits") & F.col("_opens")
        waiting = paired.filter(still | F.col("_closes")).select(*df.columns, still.alias("_waits"))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    name: str = "previous",
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Add struct ``name`` holding time and ``payload`` of the row before, or null."""
    return _neighbour(df, keys, order, payload, name, levels, forward=False)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    name: str = "following",
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Add struct ``name`` holding time and ``payload`` of the row after, or null."""
    return _neighbour(df, keys, order, payload, name, levels, forward=True)


def with_recent_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    max_gap_us: int,
    name: str = "previous",
    slice_us: int = HOUR_US // 4,
    busy: Column | None = None,
    busy_slice_us: int = SECOND_US,
) -> DataFrame:
    """:func:`with_previous` when only neighbours closer than ``max_gap_us`` matter.

    Rows in the last ``max_gap_us`` of a slice are copied into the next slice, so one
    shuffle is enough.  A neighbour further away may come back as null; one at
    ``max_gap_us`` or more is never returned.

    ``busy`` marks keys (it must follow from them) with too many rows for that: theirs are
    cut into slices of ``busy_slice_us`` without copies, and only the first and last row of
    each is looked at again the usual way.
    """
    time = order[0]
    slice_us = max(slice_us, max_gap_us)
    coarse = bucket_start(F.col(time), slice_us)
    near_end = coarse + F.lit(slice_us) - F.col(time) < F.lit(max_gap_us)
    is_busy = F.lit(False) if busy is None else F.coalesce(busy, F.lit(False))
    copies = F.when(near_end & ~is_busy, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    shift = F.col("_copy") * F.lit(slice_us).cast("long")
    own_slice = F.when(is_busy, bucket_start(F.col(time), busy_slice_us)).otherwise(coarse + shift)
    spread = df.withColumn("_copy", F.explode(copies)).withColumn(SLICE, own_slice).repartition(*keys, SLICE)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    paired = spread.withColumn("_before", F.lag(_returned(time, payload)).over(inside))
    if busy is not None:
        opens, closes = F.lag(F.lit(1)).over(inside).isNull(), F.lead(F.lit(1)).over(inside).isNull()
        paired = paired.withColumns({"_opens": opens, "_closes": closes})
    near = F.col(time) - F.col(f"_before.{time}") < F.lit(max_gap_us)
    found = paired.withColumn(name, F.when(near, F.col("_before"))).filter(F.col("_copy") == 0)
    if busy is None:
        return found.select(*df.columns, name)
    # Products, not conditions: a filter by key alone would be moved below the shuffle, and
    # the two branches would no longer share it.
    flag = is_busy.cast("int")
    settled = found.filter(flag * F.col("_opens").cast("int") == 0).select(*df.columns, name)
    edges = found.filter(flag * (F.col("_opens") | F.col("_closes")).cast("int") == 1)
    edges = with_recent_previous(
        edges.select(*df.columns, "_opens"), keys, order, payload, max_gap_us, name, slice_us
    )
    return settled.unionByName(edges.filter("_opens").select(*df.columns, name))
