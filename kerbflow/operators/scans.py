"""Restricting and cleaning what is read.  Plain filters, so they reach the file scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from kerbflow.functions import times


def time_window(
    df: DataFrame, time: str, from_us: int, until_us: int, lookback_us: int = 0, unit_us: int = 1
) -> DataFrame:
    """Rows with ``from - lookback <= time < until``.

    ``time`` is a timestamp or epoch time in units of ``unit_us`` (1000 for milliseconds).
    The bounds are literals of its own type and unit, so the file scan can skip row groups
    by them.
    """
    kind = df.schema[time].dataType

    def bound(us: int) -> Column:
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.timestamp_micros(F.lit(us)).cast(kind)
        return F.lit(-(-us // unit_us))

    column = F.col(time)
    return df.filter((column >= bound(from_us - lookback_us)) & (column < bound(until_us)))


def day_pruned_window(
    df: DataFrame, time: str, day: str, from_us: int, until_us: int, lookback_us: int = 0, unit_us: int = 1
) -> DataFrame:
    """:func:`time_window` on a table partitioned by a day label.

    The day bounds are widened by one day each way, so local-day partitions are safe too,
    and they are literals, so whole partitions are pruned before any file is opened.
    """
    first = F.date_format(F.timestamp_micros(F.lit(from_us - times.DAY_US)), "yyyy-MM-dd")
    last = F.date_format(F.timestamp_micros(F.lit(until_us + times.DAY_US)), "yyyy-MM-dd")
    pruned = df.filter(F.col(day).between(first, last))
    return time_window(pruned, time, from_us, until_us, lookback_us, unit_us)


def only_keys(df: DataFrame, key: str, keys: DataFrame, unique: bool = False) -> DataFrame:
    """Rows whose key is in ``keys``.

    The key side is made distinct first (combined before its shuffle) unless it is known
    to be ``unique``.  Whether it is broadcast is left to Spark, which does so only below
    its size threshold.
    """
    wanted = keys.select(key) if unique else keys.select(key).distinct()
    return df.join(wanted, key, "left_semi")


def without_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is not in ``keys``; null keys on either side are left out."""
    other = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    return df.filter(F.col(key).isNotNull()).join(other, key, "left_anti")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls column by column; columns not named stay as they are."""
    return df.fillna(defaults)
