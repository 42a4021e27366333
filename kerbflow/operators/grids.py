"""A fixed bucket grid and carrying a value over its empty buckets.

The carry is done by letting every non-empty bucket emit itself and the empty buckets up
to the next non-empty one.  No key-by-bucket product is built or joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from kerbflow.functions import times

SPAN_BUCKETS = 384  # four days of quarter hours: what one row may become at once


@dataclass(frozen=True)
class Grid:
    """Buckets ``[start + i*width, start + (i+1)*width)`` that end by ``until``.

    The first bucket always exists, even when ``until`` lies inside it.
    """

    start_us: int
    until_us: int
    width_us: int = times.BUCKET_US

    @property
    def size(self) -> int:
        return max(1, (self.until_us - self.start_us) // self.width_us)

    @property
    def end_us(self) -> int:
        return self.start_us + self.size * self.width_us

    def index(self, time: Column) -> Column:
        """Bucket number; -1 for all times before the grid, ``size`` for all after it."""
        since = times.bucket_start(time, self.width_us, self.start_us) - F.lit(self.start_us)
        raw = (since / F.lit(self.width_us)).cast("int")
        return F.greatest(F.lit(-1), F.least(F.lit(self.size), raw))

    def start_of(self, index: Column) -> Column:
        return F.lit(self.start_us) + index.cast("long") * F.lit(self.width_us)


def spread_by_key(df: DataFrame, key: str) -> DataFrame:
    """Shuffle by key into the configured number of partitions.

    Used before :func:`emit_to_next`: the step multiplies its rows, so its tasks must not
    be merged because their input is small.  A later window or grouping that starts with
    the key needs no further shuffle.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, key)


def with_spans(
    df: DataFrame, keys: Sequence[str], bucket: str, grid: Grid, lead_in: bool = True
) -> DataFrame:
    """Add the range of grid buckets each row stands for, ``first_bucket`` to ``last_bucket``.

    ``df`` has one row per key and non-empty bucket.  A row stands for its own bucket and
    the empty ones up to the next row; with ``lead_in`` a key's first row also stands for
    the empty buckets before it.  Rows outside the grid stand for what they reach inside,
    if anything.  A key has at most ``size + 2`` rows, which bounds the window.
    """
    order = Window.partitionBy(*keys).orderBy(bucket)
    last = F.least(
        F.coalesce(F.lead(bucket).over(order), F.lit(grid.size)), F.lit(grid.size)
    ) - F.lit(1)
    is_first = F.lag(bucket).over(order).isNull()
    from_own = F.greatest(F.col(bucket), F.lit(0))
    first = F.when(is_first, F.lit(0)).otherwise(from_own) if lead_in else from_own
    span = df.withColumns({"first_bucket": first, "last_bucket": last})
    return span.filter(F.col("first_bucket") <= F.col("last_bucket"))


def cut_spans(df: DataFrame, most: int = SPAN_BUCKETS) -> DataFrame:
    """Spans of at most ``most`` buckets, dealt out by key and place.

    The next step multiplies rows by their spans, so a task's output then follows from its
    input, and one long span is no task of its own.  The tasks must not be merged because
    their input is small, so their number is the configured one.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.explode(F.sequence("first_bucket", "last_bucket", F.lit(most)))
    ends = F.least(F.col("last_bucket"), F.col("first_bucket") + F.lit(most - 1))
    pieces = df.withColumn("first_bucket", starts).withColumn("last_bucket", ends)
    spread = [c for c in df.columns if isinstance(df.schema[c].dataType, (StringType, IntegerType, LongType))]
    return pieces.repartition(count, *spread)


def emit_spans(df: DataFrame, bucket: str, grid: Grid) -> DataFrame:
    """One row per bucket of each span.

    Adds ``grid_bucket``, ``is_own`` (it is the row's own bucket) and ``is_lead_in`` (it
    lies before that).  Join what the rows need before this step, which multiplies them.
    Only on a grid longer than ``SPAN_BUCKETS`` can a span be longer; it is cut first.
    """
    spans = cut_spans(df) if grid.size > SPAN_BUCKETS else df
    return (
        spans.withColumn("grid_bucket", F.explode(F.sequence("first_bucket", "last_bucket")))
        .withColumn("is_own", F.col("grid_bucket") == F.col(bucket))
        .withColumn("is_lead_in", F.col("grid_bucket") < F.col(bucket))
        .drop("first_bucket", "last_bucket")
    )


def emit_to_next(
    df: DataFrame, keys: Sequence[str], bucket: str, grid: Grid, lead_in: bool = True
) -> DataFrame:
    """One row per key and grid bucket from one row per key and non-empty bucket."""
    return emit_spans(with_spans(df, keys, bucket, grid, lead_in), bucket, grid)
