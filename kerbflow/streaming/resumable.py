"""Tumbling windows that survive restarts and take rows of any lateness.

A run drains what its source has, in batches of bounded size, and goes on from the caller's
checkpoint the next time.  Each batch is summed up per key and window and merged into the
stored windows of the days it touches.  There is no watermark: a row that comes after its
window was stored is merged into it like any other, and no window waits in memory for it.
A batch that is repeated after a failure starts from the windows as they were before it,
so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbflow.functions import times
from kerbflow.sources.day_versions import DayVersions, days_of
from kerbflow.sources.store import DAY
from kerbflow.streaming.tumbling import drain


@dataclass(frozen=True)
class Measure:
    """A window measure: how raw rows make it, and how two parts of a window make one."""

    made: Column
    merged: str

    def merge(self, name: str) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.merged](name).alias(name)


def count_and_extremes(value: str) -> dict[str, Measure]:
    """Row count, value sum and extremes."""
    return {
        "eventcnt": Measure(F.count("*"), "sum"),
        "total": Measure(F.sum(value), "sum"),
        "low": Measure(F.min(value), "min"),
        "high": Measure(F.max(value), "max"),
    }


@dataclass(frozen=True)
class Pace:
    """How much a run takes: files and bytes of a batch, and seconds to wait for it all.

    ``timeout_s`` unset waits until the source is drained.  A run that is stopped by it
    loses nothing, the next one goes on.
    """

    max_files: int | None = None
    max_bytes: str | None = None
    timeout_s: int | None = None

    def options(self) -> dict[str, str]:
        wanted = {"maxFilesPerTrigger": self.max_files, "maxBytesPerTrigger": self.max_bytes}
        return {name: str(value) for name, value in wanted.items() if value is not None}


def paced_stream(
    spark: SparkSession, path: str, schema: StructType | str, pace: Pace = Pace(), pattern: str = "*.parquet"
) -> DataFrame:
    """New files of a folder, a bounded number or size of them in each batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.options(**pace.options()).parquet(path)


@dataclass(frozen=True)
class WindowTable:
    """Stored windows of a stream: where they and the stream's progress are, and what they hold.

    ``path`` and ``checkpoint`` are the caller's, belong together and must be in folders
    all executors reach.  Keys may be null; rows without a time belong to no window.
    """

    spark: SparkSession
    path: str
    checkpoint: str
    keys: Sequence[str]
    time: str
    measures: Mapping[str, Measure]
    width_us: int = times.BUCKET_US
    pace: Pace = field(default=Pace())

    def summed(self, rows: DataFrame) -> DataFrame:
        """Windows of some rows alone."""
        start = times.bucket_start(F.col(self.time), self.width_us)
        timed = rows.where(F.col(self.time).isNotNull()).withColumn("starttime", start)
        parts = timed.groupBy(*self.keys, "starttime").agg(*(m.made.alias(n) for n, m in self.measures.items()))
        return parts.withColumns(
            {"endtime": F.col("starttime") + F.lit(self.width_us), DAY: times.day_label(F.col("starttime"))}
        )

    def _merged(self, windows: DataFrame) -> DataFrame:
        names = [*self.keys, "starttime", "endtime", DAY]
        return windows.groupBy(*names).agg(*(m.merge(n) for n, m in self.measures.items()))

    def _table(self, rows: DataFrame) -> DayVersions:
        return DayVersions(rows.sparkSession, self.path, self.summed(rows).schema)

    def merge_batch(self, batch: DataFrame, number: int) -> None:
        """Merge one batch of raw rows; doing it again changes nothing."""
        table = self._table(batch)
        newest = table.newest()
        if newest is not None and newest > number:
            raise ValueError(f"{self.path} holds batch {newest}, but the checkpoint is at {number}: they are not of one stream")
        table.clean(before=number)
        parts = self.summed(batch)
        stored = table.read(days_of(batch.select(times.day_label(F.col(self.time)).alias(DAY))), before=number)
        table.write(self._merged(stored.unionByName(parts)), number)

    def run(self, stream: DataFrame) -> DataFrame:
        """Take what the source has now and return all windows."""
        writer = stream.writeStream.option("checkpointLocation", self.checkpoint).trigger(availableNow=True)
        drain(writer.foreachBatch(self.merge_batch).start(), self.pace.timeout_s)
        return self.read(stream)

    def read(self, like: DataFrame) -> DataFrame:
        """All windows stored so far; ``like`` has the columns of the source."""
        plain = self.spark.createDataFrame([], like.schema)
        return self._table(plain).read().drop(DAY)
