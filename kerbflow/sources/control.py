"""Parameters and high-water marks: ``(type, key) -> val``, kept as an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.operators.versions import latest_per_key
from kerbflow.sources.store import TableStore

TABLE = "aggregation_control"
LOG_SCHEMA = "type string, key string, val string, stamp bigint"
KEYS = ("type", "key")


def current_values(log: DataFrame) -> DataFrame:
    """The value in force per (type, key)."""
    return latest_per_key(log, KEYS, [F.col("stamp").desc(), F.col("val").desc()]).drop("stamp")


def lookup(values: DataFrame, wanted: DataFrame, absent: str = "na") -> DataFrame:
    """Value for every wanted (type, key), ``absent`` where there is none."""
    return wanted.join(values, list(KEYS), "left").select(
        *KEYS, F.coalesce("val", F.lit(absent)).alias("val")
    )


class ControlTable:
    def __init__(self, store: TableStore):
        self.store = store

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def log(self) -> DataFrame:
        return self.store.read_or_empty(TABLE, LOG_SCHEMA)

    def get(self, kind: str, key: str, absent: str = "na") -> str:
        """One value; the filter leaves the few log rows of a single key."""
        rows = self.log().filter((F.col("type") == kind) & (F.col("key") == key))
        newest = rows.orderBy(F.col("stamp").desc(), F.col("val").desc()).limit(1).collect()
        return newest[0]["val"] if newest else absent

    def put(self, kind: str, key: str, val: str, stamp: int) -> None:
        row = self.spark.createDataFrame([(kind, key, val, stamp)], LOG_SCHEMA)
        self.store.append(TABLE, row)

    def seed(self, kind: str, key: str, val: str) -> None:
        if self.get(kind, key, absent="") == "":
            self.put(kind, key, val, stamp=0)
