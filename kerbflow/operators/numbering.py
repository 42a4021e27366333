"""Consecutive numbers over a globally ordered frame, and fixed-size key batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.session import shared_dir


def number_rows(df: DataFrame, *order: str, name: str = "row_no") -> DataFrame:
    """Number rows 0, 1, 2, … in ``order`` without sorting everything in one task.

    Rows are range-partitioned, the partition id is frozen by a checkpoint, and each
    partition's offset is the sum of the counts before it.  The only single-task window
    runs over one row per partition.  ``order`` must be unique.
    """
    shared_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_local") - 1)
        .drop("_part", "_local", "_offset")
    )


def key_batches(keys: DataFrame, key: str, size: int, quote: bool = True) -> DataFrame:
    """Distinct keys in order, ``size`` to a comma list, for stores that take IN lists.

    Spark sources do not need this; use ``scans.only_keys`` there.
    """
    item: Column = F.concat(F.lit("'"), F.col(key), F.lit("'")) if quote else F.col(key)
    numbered = number_rows(keys.select(key).distinct(), key)
    return (
        numbered.withColumn("batch_no", F.floor(F.col("row_no") / F.lit(size)))
        .groupBy("batch_no")
        .agg(F.sort_array(F.collect_list(F.struct("row_no", item.alias("item")))).alias("_items"))
        .select("batch_no", F.concat_ws(",", "_items.item").alias("grp"))
    )


def sorted_by_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows in key and time order inside each partition.

    Range partitioning on all sort columns keeps a key's rows adjacent but lets a busy
    key span several partitions.
    """
    return df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
