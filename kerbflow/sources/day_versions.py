"""Day partitions kept as numbered versions, for writers that may have to repeat a step.

A version is one directory with the whole new content of the days it changes; it counts
once its job has succeeded.  Readers take each day from the newest version that holds it.
Nothing a reader may use is deleted or moved while a version is written, so a step that
fails leaves the table as it was, and a repeated step replaces its own version only.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbflow.sources.store import DAY

VERSION = "version"
KEPT_VERSIONS = 2  # of each day, so that a reader can finish on the one before


class DayVersions:
    """One table; only one writer at a time.

    ``schema`` is that of its rows with the day.  Versions count up from 0, usually the
    batch numbers of a stream.  Only directory names come to the driver, at most
    ``KEPT_VERSIONS`` of each stored day.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def _names(self, pattern: str) -> list[tuple[str, str]]:
        """The last two names of each path that fits the pattern."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path) or []
        return [(s.getPath().getParent().getName(), s.getPath().getName()) for s in found]

    def versions(self, before: int | None = None) -> dict[str, list[int]]:
        """The finished versions of each day, newest first."""
        done = {v for v, _ in self._names(f"{VERSION}=*/_SUCCESS")}
        days: dict[str, list[int]] = {}
        for version, day in self._names(f"{VERSION}=*/{DAY}=*"):
            number = int(version.removeprefix(f"{VERSION}="))
            if version in done and (before is None or number < before):
                days.setdefault(day.removeprefix(f"{DAY}="), []).append(number)
        return {day: sorted(numbers, reverse=True) for day, numbers in days.items()}

    def newest(self) -> int | None:
        """The highest finished version, also if it changed no day."""
        numbers = [int(v.removeprefix(f"{VERSION}=")) for v, _ in self._names(f"{VERSION}=*/_SUCCESS")]
        return max(numbers, default=None)

    def read(self, days: Collection[str] | None = None, before: int | None = None) -> DataFrame:
        """Current rows, of some days and as they were before a version if wanted.

        Only the directories of these days are listed to Spark.
        """
        current = {day: numbers[0] for day, numbers in self.versions(before).items() if days is None or day in days}
        if not current:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{VERSION}={number}/{DAY}={day}" for day, number in sorted(current.items())]
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
        return rows.select(*self.schema.names)

    def write(self, rows: DataFrame, version: int) -> None:
        """Make a version of the days in ``rows``, which holds all their rows from now on."""
        placed = rows.select(*self.schema.names).hint("rebalance", DAY)
        placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(
            f"{self.path}/{VERSION}={version}"
        )

    def clean(self, before: int) -> None:
        """Delete what finished versions before this one have replaced.

        To be called when no step before ``before`` can be repeated any more.
        """
        context = self.spark.sparkContext
        for day, numbers in self.versions(before).items():
            for number in numbers[KEPT_VERSIONS:]:
                path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{VERSION}={number}/{DAY}={day}")
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def days_of(rows: DataFrame, day: str = DAY) -> list[str]:
    """The day labels of some rows; one short text per day comes to the driver."""
    return sorted(r[0] for r in rows.select(F.col(day)).where(F.col(day).isNotNull()).distinct().collect())
