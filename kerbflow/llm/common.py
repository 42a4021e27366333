"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.session import scratch_path

# Fixed by contract: a word is a run of anything but space and the control blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator name its working columns with a leading underscore.

    Columns of the input that begin so too get other names while it runs.  A column the
    operator is told to use must not begin so.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        aside = {c: f"column {k} of the input" for k, c in enumerate(df.columns) if c.startswith("_")}
        if not aside:
            return operator(df, *args, **options)
        result = operator(df.withColumnsRenamed(aside), *args, **options)
        return result.withColumnsRenamed({name: c for c, name in aside.items()})

    return run


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation, and every later use reads
    only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    It does so when the driver collects its garbage, which on its own may be long after a
    stage that moved much data.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return the memory this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A function for ``mapInArrow`` whose worker keeps no freed memory after the task.

    Workers are used again, so each may hold on to the most it ever needed.
    """

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def n_bytes(text: Column) -> Column:
    """UTF-8 size; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def n_words(text: Column) -> Column:
    """Number of words; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
