"""Latest version per key, and upserts built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """One row per key: the first by ``newest_first``, which should break all ties.

    ``row_number() = 1`` lets Spark keep one candidate per key and task before the
    shuffle, so many versions of one key do not meet in one task.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def latest_with_ties(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Every row that carries its key's highest version."""
    top = df.groupBy(*keys).agg(F.max(version).alias(version))
    return df.join(top, [*keys, version], "left_semi")


def with_key_maximum(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Attach the per-key maximum.

    Aggregate and join rather than an unordered window: the maximum is combined before
    its shuffle, and a join can be split by the skew handling where a window cannot.
    """
    top = df.groupBy(*keys).agg(F.max(value).alias(name))
    return df.join(top, list(keys), "inner")


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column] = (),
) -> DataFrame:
    """Rows of ``current`` replaced or extended by ``incoming``, one row per key.

    Incoming rows win over current rows; ``newest_first`` and then the remaining columns
    settle several incoming rows with one key, so task order never does.
    """
    tagged = current.withColumn("_incoming", F.lit(0)).unionByName(
        incoming.withColumn("_incoming", F.lit(1))
    )
    order = [F.col("_incoming").desc(), *newest_first, *remaining_columns(incoming, keys)]
    merged = latest_per_key(tagged, keys, order)
    return merged.drop("_incoming")


def remaining_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """An order by every column but the keys, to break ties."""
    return [F.col(c).desc() for c in df.columns if c not in keys]


def seed_if_absent(current: DataFrame, defaults: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` plus the default rows whose key it lacks."""
    missing = defaults.join(current.select(*keys).distinct(), list(keys), "left_anti")
    return current.unionByName(missing)
