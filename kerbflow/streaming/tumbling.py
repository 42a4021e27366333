"""Tumbling-window traffic counts over a file stream, with replay-safe output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kerbflow.functions import times
from kerbflow.operators.versions import latest_per_key
from kerbflow.session import scratch_path

BATCH = "batch_id"


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.parquet"
) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(path)


def tumbling_counts(
    stream: DataFrame, time: str, keys: list[str], value: str, late: str = "1 hour"
) -> DataFrame:
    """Row count, value sum and extremes per key and 15-minute window.

    ``late`` is how long a window stays open; rows later than that are dropped, so set it
    to at least the overlap the batch run re-reads.
    """
    return (
        stream.withColumn("moment", F.timestamp_micros(F.col(time)))
        .withWatermark("moment", late)
        .groupBy(F.window("moment", "15 minutes"), *keys)
        .agg(
            F.count("*").alias("eventcnt"),
            F.sum(value).alias("total"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
        )
        .select(
            *keys,
            F.unix_micros("window.start").alias("starttime"),
            F.unix_micros("window.end").alias("endtime"),
            "eventcnt",
            "total",
            "low",
            "high",
        )
    )


def keep_batches(result: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Write each micro-batch's new or changed rows to a directory named after the batch.

    A replayed batch overwrites its own directory, so output stays exactly once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def latest_batches(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key over all batches written so far."""
    rows = spark.read.parquet(path)
    return latest_per_key(rows, keys, [F.col(BATCH).desc()]).drop(BATCH)


def drain(query: StreamingQuery, timeout_s: int | None) -> None:
    """Wait until a run has taken all there is; a failure of it is raised here."""
    try:
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            raise TimeoutError("the source is not drained yet; the next run goes on from here")
    finally:
        query.stop()


def run_tumbling(
    stream: DataFrame,
    time: str,
    keys: list[str],
    value: str,
    late: str = "1 hour",
    path: str | None = None,
    checkpoint: str | None = None,
    timeout_s: int | None = None,
) -> DataFrame:
    """Drain what is available now and return the window table.

    ``path`` and ``checkpoint`` of an earlier run go on from it; without them the run
    stands alone.  :mod:`kerbflow.streaming.resumable` also takes rows later than ``late``.
    """
    spark = stream.sparkSession
    path, checkpoint = path or scratch_path(spark, "windows"), checkpoint or scratch_path(spark, "windows-state")
    drain(keep_batches(tumbling_counts(stream, time, keys, value, late), path, checkpoint), timeout_s)
    return latest_batches(spark, path, [*keys, "starttime"])
