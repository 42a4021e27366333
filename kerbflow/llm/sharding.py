"""Shuffled shards by a two-pass external shuffle.

Pass one scatters records into memory-sized buckets by seeded hashes, which is one Spark
shuffle.  Pass two puts each bucket into a Fisher-Yates order.  The buckets one after the
other are the shuffled table, which is cut into shards of equal row counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from kerbflow.llm.common import n_bytes, own_names, stored

OUTPUTS = ("shard", "slot")
GROUP = 1024  # buckets summed together before the running sum over groups


def _bucket_offsets(counts: DataFrame) -> DataFrame:
    """(bucket, n) -> plus ``first``: rows in all lower buckets, by two levels of sums."""
    upper = (F.col("_bucket") / GROUP).cast("long")
    groups = counts.groupBy(upper.alias("_group")).agg(F.sum("n").alias("_n"))
    running = F.sum("_n").over(W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1))
    starts = groups.select("_group", F.coalesce(running, F.lit(0)).alias("_start"))
    inside = F.sum("n").over(W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    return (
        counts.withColumn("_group", upper)
        .join(starts, "_group")
        .select("_bucket", (F.col("_start") + F.coalesce(inside, F.lit(0))).alias("_first"))
    )


@own_names
def shuffle_into_shards(
    df: DataFrame,
    shards: int,
    seed: int = 11,
    keys: tuple[str, ...] = ("doc_id", "text"),
    text_col: str = "text",
    bucket_bytes: int = 16_000_000,
) -> DataFrame:
    """The whole records in random order, with ``shard`` and gapless ``slot`` in it.

    Law ``rows``: shard sizes differ by one row at most.  A record's bucket comes from a
    seeded hash of ``keys``, so one text that many documents share is scattered over all
    buckets; the number of buckets follows the table's bytes.  Rows equal in all keys are
    interchangeable and share a bucket.  The order depends on keys and seed only.  Nulls
    are ordinary values; with fewer rows than shards some shards stay empty; an empty table
    gives an empty result.
    """
    df = df.drop(*OUTPUTS)
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(n_bytes(F.col(text_col)) + 8), F.lit(0))).first()
    buckets = max(1, math.ceil(size / bucket_bytes))
    scatter = F.xxhash64(F.lit(seed), *keys)
    scattered = df.withColumn("_hash", scatter).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    counts = scattered.groupBy("_bucket").agg(F.count("*").alias("n"))
    offsets = _bucket_offsets(counts)
    names = df.columns
    sort_keys = [("_hash", "ascending"), *((k, "ascending") for k in keys)]

    def fisher_yates(table: pa.Table) -> pa.Table:
        # A fixed order first: rows arrive as the shuffle happens to deliver them.
        table = table.take(pc.sort_indices(table, sort_keys=sort_keys))
        n = table.num_rows
        bucket, first = table["_bucket"][0].as_py(), table["_first"][0].as_py()
        order = np.arange(n)
        np.random.default_rng([seed & 0xFFFFFFFF, bucket]).shuffle(order)
        place = first + np.arange(n, dtype=np.int64)
        shard = place * shards // rows
        start = -((-shard * rows) // shards)
        out = table.select(names).take(pa.array(order))
        return out.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(place - start))

    schema = StructType(list(df.schema.fields)).add("shard", IntegerType()).add("slot", LongType())
    return scattered.join(offsets, "_bucket").groupBy("_bucket").applyInArrow(fisher_yates, schema)


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shuffled records as one folder per shard, rows in slot order."""
    shuffled = shuffle_into_shards(df, shards, **options)
    (
        stored(shuffled, "shards")
        .repartitionByRange(F.col("shard"), F.col("slot"))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
