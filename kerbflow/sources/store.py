"""Tables kept as files under one root: append, replace, partition overwrite, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbflow.operators import scans, versions
from kerbflow.sources.schemas import NULL_DEFAULTS

DAY = "startday"


class TableStore:
    """Reads and writes named tables below ``root``.

    ``fmt`` is any Spark file format; ``parquet`` and ``orc`` keep filters and column
    pruning at the scan, ``csv`` is there for exchange.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        fs, path = self._files(name)
        return fs.exists(path)

    def _files(self, name: str):
        """Hadoop file system and path of a table, for existence and partition names."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def read(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if self.fmt == "csv":
            reader = reader.option("header", "true")
        return reader.load(self.path(name))

    def read_or_empty(self, name: str, schema: StructType | str) -> DataFrame:
        if self.exists(name):
            return self.read(name, schema)
        return self.spark.createDataFrame([], schema)

    def read_input(self, name: str, schema: StructType | str | None = None) -> DataFrame:
        """Read with the table's null sentinels filled in."""
        return scans.with_defaults(self.read(name, schema), NULL_DEFAULTS.get(name, {}))

    def _writer(self, df: DataFrame, mode: str, by: Sequence[str]):
        if by:
            # Rebalancing gathers each partition's rows into few files, but splits a
            # partition that is too big for one task.
            df = df.hint("rebalance", *by)
        writer = df.write.format(self.fmt).mode(mode)
        if self.fmt == "csv":
            writer = writer.option("header", "true")
        return writer.partitionBy(*by) if by else writer

    def append(self, name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        self._writer(df, "append", by).save(self.path(name))
        return self.read(name, df.schema)

    def replace(self, name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """All rows replaced.  ``df`` must not read the table it replaces."""
        self._writer(df, "overwrite", by).option("partitionOverwriteMode", "static").save(
            self.path(name)
        )
        return self.read(name, df.schema)

    def overwrite_days(self, name: str, df: DataFrame, day: str = DAY) -> DataFrame:
        """Replace exactly the day partitions that occur in ``df``.

        New files are staged and moved in, day by day, only when the whole job has
        succeeded, so ``df`` may read the same table and a failed job changes nothing.  A
        driver that is lost while days are moved can leave some of them new, and the one
        being moved empty until the run is repeated; where that cannot be borne, use
        :class:`kerbflow.sources.day_versions.DayVersions`.
        """
        self._writer(df, "overwrite", [day]).option("partitionOverwriteMode", "dynamic").save(
            self.path(name)
        )
        return self.read(name, df.schema)

    def upsert(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        newest_first: Sequence[Column] = (),
        day: str = DAY,
        days: tuple[str, str] | None = None,
    ) -> DataFrame:
        """Merge rows by key, rewriting only the day partitions they fall in.

        The key has to determine the day.  A caller that knows the first and last day of
        ``df`` passes ``days``; stored partitions are then pruned by literals and ``df`` is
        computed once.
        """
        if self.exists(name):
            stored = self.read(name, df.schema)
            if days is None:
                current = scans.only_keys(stored, day, df)
            else:
                current = stored.filter(F.col(day).between(*days))
            df = versions.upsert(current, df, keys, newest_first)
        else:
            df = versions.latest_per_key(df, keys, [*newest_first, *versions.remaining_columns(df, keys)] or [F.lit(1)])
        return self.overwrite_days(name, df, day)

    def days(self, name: str, day: str = DAY) -> list[str]:
        """The stored days of a table, from its directory names."""
        if not self.exists(name):
            return []
        fs, path = self._files(name)
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}="))

    def drop_days(self, name: str, days: Sequence[str], day: str = DAY) -> list[str]:
        """Remove whole day partitions; returns the labels of those that were there."""
        fs, path = self._files(name)
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return [label for label in days if fs.delete(child(path, f"{day}={label}"), True)]

    def drop_days_before(self, name: str, first_kept: str, day: str = DAY) -> list[str]:
        """Remove whole day partitions older than ``first_kept``; returns their labels.

        Only partition directory names come to the driver, at most one per stored day.
        """
        fs, path = self._files(name)
        dropped = []
        for status in fs.listStatus(path):
            label = status.getPath().getName().removeprefix(f"{day}=")
            is_partition = status.getPath().getName() != label
            if is_partition and label < first_kept and fs.delete(status.getPath(), True):
                dropped.append(label)
        return sorted(dropped)
