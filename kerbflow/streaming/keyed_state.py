"""End-of-bucket states of spots, kept by a stateful processor between runs.

The state is two numbers per spot: the first bucket not yet given out and whether the spot
was occupied at the end of the one before.  Changes are first reduced to the last one per
spot and bucket, in every task, so a busy spot brings one row per closed bucket; event-time
timers give out the buckets of spots that sent nothing.

Spots are kept in a fixed number of blocks, by hash: a call of the processor, its reads and
writes of the state and its timers cost far more than a spot in it.  The processor gives
out spans of equal buckets; they become one row per bucket outside Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kerbflow.functions import times
from kerbflow.streaming.tumbling import BATCH, drain, keep_batches

BLOCKS = 2048  # part of what a checkpoint holds: another number cannot go on from it
STATE_SCHEMA = "parkingspotid array<string>, next_us array<bigint>, occupied array<boolean>"
# The spans of one call, side by side: a bucket's start is in [first_us, end_us).
SPANS_SCHEMA = "parkingspotid array<string>, first_us array<bigint>, end_us array<bigint>, occupancy array<boolean>"
# State with timers needs this store; Spark remembers it in the checkpoint.
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CarriedState(StatefulProcessor):
    """Gives out every bucket of a block's spots, in order and once, when the bucket is over."""

    def __init__(self, start_us: int, width_us: int):
        self.start_us = start_us
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE_SCHEMA)

    def _known(self) -> dict[str, tuple[int, bool]]:
        """The first bucket not yet given out and the state before it, by spot."""
        if not self.state.exists():
            return {}
        spots, next_us, occupied = self.state.get()
        return dict(zip(spots, zip(next_us, occupied)))

    def _keep(self, known: dict[str, tuple[int, bool]]) -> None:
        next_us, occupied = (list(x) for x in zip(*known.values()))
        self.state.update((list(known), next_us, occupied))
        # Earlier timers may still go off; they find nothing to give out.
        self.handle.registerTimer((min(next_us) + self.width_us) // times.MILLI_US)

    def _given_out(self, spans: list[tuple[str, int, int, bool]]) -> Iterator[Row]:
        if spans:
            spots, first_us, end_us, occupancy = (list(x) for x in zip(*spans))
            yield Row(parkingspotid=spots, first_us=first_us, end_us=end_us, occupancy=occupancy)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        free = dict.fromkeys(initialState.free, (self.start_us, False))
        self._keep(free | dict.fromkeys(initialState.taken, (self.start_us, True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # A row without a spot only tells the time.
        heard = sorted((r.parkingspotid, r.bucket, r.occupancy) for r in rows if r.parkingspotid is not None)
        if not heard:
            return
        known, spans = self._known(), []
        for spot, of_spot in groupby(heard, key=itemgetter(0)):
            next_us, occupied = known.get(spot, (self.start_us, False))
            first_us = next_us
            for _, bucket, state in of_spot:
                if state != occupied and bucket > first_us:
                    spans.append((spot, first_us, bucket, occupied))
                    first_us = bucket
                next_us, occupied = max(next_us, bucket + self.width_us), state
            if next_us > first_us:
                spans.append((spot, first_us, next_us, occupied))
            known[spot] = next_us, occupied
        self._keep(known)
        yield from self._given_out(spans)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * times.MILLI_US
        known, spans = self._known(), []
        for spot, (next_us, occupied) in known.items():
            end_us = next_us + max(0, watermark_us - next_us) // self.width_us * self.width_us
            if end_us > next_us:
                spans.append((spot, next_us, end_us, occupied))
                known[spot] = end_us, occupied
        if spans:
            self._keep(known)
            yield from self._given_out(spans)

    def close(self) -> None:
        pass


def block_of(spot: str) -> Column:
    return F.pmod(F.xxhash64(spot), F.lit(BLOCKS)).alias("block")


def closed_buckets(stream: DataFrame, start_us: int, width_us: int, late: str) -> DataFrame:
    """The last state of each spot and bucket, once the bucket is over."""
    origin = f"{start_us % width_us // times.MILLI_US} milliseconds"
    width = f"{width_us // times.MILLI_US} milliseconds"
    last = F.max(F.struct("since", F.coalesce("occupancy", F.lit(False)).alias("occupancy"))).alias("last")
    return (
        stream.withColumn("moment", F.timestamp_micros(F.col("since")))
        .withWatermark("moment", late)
        .groupBy("parkingspotid", F.window("moment", width, width, origin))
        .agg(last)
        .select(
            block_of("parkingspotid"),
            "parkingspotid",
            F.window_time("window").alias("moment"),
            F.unix_micros("window.start").alias("bucket"),
            "last.occupancy",
        )
    )


def carried_stream(
    stream: DataFrame, prior: DataFrame, start_us: int, width_us: int = times.BUCKET_US, late: str = "1 hour"
) -> DataFrame:
    """A stream of end-of-bucket states from ``start_us`` on, as buckets close; in spans,
    which :func:`by_bucket` turns into rows.

    ``stream`` has parkingspotid, since and occupancy (null counts as free).  Spots of
    ``prior`` start with its occupancy, others free; a spot is given out from the first
    bucket on once it is in ``prior`` or has sent a row, silent or not.  Rows before the
    start only set the state.  A bucket closes when a row ``late`` after its end has come
    from any spot, or one without a spot; changes that come later than that are dropped, so
    ``late`` has to cover the delay of the source.
    """
    taken = F.coalesce("occupancy", F.lit(False))
    initial = (
        prior.where("parkingspotid is not null")
        .groupBy(block_of("parkingspotid"))
        .agg(
            F.collect_set(F.when(taken, F.col("parkingspotid"))).alias("taken"),
            F.collect_set(F.when(~taken, F.col("parkingspotid"))).alias("free"),
        )
    )
    return (
        closed_buckets(stream, start_us, width_us, late)
        .groupBy("block")
        .transformWithState(
            CarriedState(start_us, width_us),
            SPANS_SCHEMA,
            "append",
            "eventTime",
            initialState=initial.groupBy("block"),
        )
    )


def by_bucket(spans: DataFrame, width_us: int) -> DataFrame:
    """One row per spot and bucket."""
    columns = ("parkingspotid", "first_us", "end_us", "occupancy")
    starts = F.sequence("first_us", F.col("end_us") - F.lit(width_us), F.lit(width_us))
    return spans.select(F.inline(F.arrays_zip(*columns))).select(
        "parkingspotid", F.explode(starts).alias("starttime"), "occupancy"
    )


def run_carried(
    stream: DataFrame,
    prior: DataFrame,
    start_us: int,
    path: str,
    checkpoint: str,
    width_us: int = times.BUCKET_US,
    late: str = "1 hour",
    timeout_s: int | None = None,
) -> DataFrame:
    """Drain what is available now and return all states given out so far.

    The state stays in the caller's checkpoint, so the next run goes on where this one
    ended; ``prior`` counts in the first run only.
    """
    spark = stream.sparkSession
    before = spark.conf.get(STORE_CONF)
    spark.conf.set(STORE_CONF, STORE)
    try:
        query = keep_batches(carried_stream(stream, prior, start_us, width_us, late), path, checkpoint, mode="append")
    finally:
        spark.conf.set(STORE_CONF, before)
    drain(query, timeout_s)
    return by_bucket(spark.read.schema(f"{SPANS_SCHEMA}, {BATCH} bigint").parquet(path), width_us)
