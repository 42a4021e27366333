"""Bounded-space online best-fit packing of pieces into sequences."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from kerbflow.llm.common import own_names

OUTPUTS = ("sequence_id", "offset")


def best_fit(lengths: np.ndarray, capacity: int, open_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, in the given order.

    At most ``open_bins`` bins are open.  A bitset has bit f set where some open bin has f
    free; the lowest bit at or above a piece's length is its best fit.  When no bin fits
    and all are in use, the fullest open bin closes for a new one.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = opened = made = 0
    for i, size in enumerate(lengths.tolist()):
        fitting = bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                bits ^= 1 << free
        else:
            if opened == open_bins:
                fullest = (bits & -bits).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    bits ^= 1 << fullest
                opened -= 1
            free, at = capacity, made
            made += 1
            opened += 1
        bins[i], offsets[i] = at, capacity - free
        free -= size
        if free:
            by_free[free].append(at)
            bits |= 1 << free
        else:
            opened -= 1
    return bins, offsets


@own_names
def pack_best_fit(
    pieces: DataFrame,
    capacity: int = 2048,
    open_bins: int = 512,
    run_pieces: int = 500,
    pieces_per_group: int = 25_000,
    seed: int = 23,
    keys: tuple[str, ...] = ("doc_id", "piece"),
    length_col: str = "length",
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to each piece.

    Pieces (of 1 to ``capacity`` tokens; others are an error) are dealt by a seeded hash of
    ``keys`` into groups of about ``pieces_per_group``.  A task takes a group's pieces one
    by one in a seeded order, of each ``run_pieces`` in it the longest first, so small ones
    fill what the others left free.  No more than ``open_bins`` sequences are open; on real
    lengths that closes some, and the whole takes 0.2 % more sequences than tokens need.  Only the
    rows given are shuffled, so leave ids out and join them
    later.  Null keys are ordinary values; equal rows are separate pieces; an
    empty table gives none.
    """
    pieces = pieces.drop(*OUTPUTS)
    groups = max(1, math.ceil(pieces.count() / pieces_per_group))
    schema = StructType(list(pieces.schema.fields)).add("sequence_id", LongType()).add("offset", LongType())
    names = pieces.columns

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf[length_col].to_numpy()
        if lengths.max() > capacity or lengths.min() < 1:
            raise ValueError(f"a piece must have 1 to {capacity} tokens")
        pdf = pdf.sort_values(["_hash", *keys, length_col])
        run = np.arange(len(pdf)) // run_pieces
        pdf = pdf.iloc[np.lexsort((-pdf[length_col].to_numpy(), run))]
        bins, offsets = best_fit(pdf[length_col].to_numpy(), capacity, open_bins)
        out = pdf[names].copy()
        out["sequence_id"] = (int(pdf["_group"].iloc[0]) << 40) + bins
        out["offset"] = offsets
        return out

    dealt = pieces.withColumn("_hash", F.xxhash64(F.lit(seed), *keys)).withColumn("_group", F.pmod("_hash", F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(pack, schema)
