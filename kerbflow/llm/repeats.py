"""Exact removal of repeated byte strings with sharded suffix arrays.

Each string of ``length`` bytes holds one anchor: the 32-byte string in it with the least
hash.  Equal strings have equal anchors, so only runs of strings around equal anchors can
repeat each other.  Runs are brought together by anchor; runs with the same whole context
are settled at once, and the differing contexts of an anchor go to one shard.  A shard's
suffix array is induced, permuted common prefixes tell which neighbours share ``length``
bytes, and every string but its first occurrence is marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from kerbflow.llm.common import give_back, lean, own_names, stored
from kerbflow.llm.shingles import mixed, row_slices
from kerbflow.llm.suffixes import permuted_common_prefixes, suffix_array

OUTPUTS = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
ANCHOR = 32
# Texts and contexts worked on at once in a task; arrays take some 90 bytes for each.
SLICE_BYTES = 250_000
SHARD_BYTES = 500_000
NO_ID = (1 << 63) - 1  # rows without an id come last
# One run of strings in a long: 31 bits start, 7 bits number of strings.  Its order is the
# order of occurrence inside a text.
START_SHIFT = 7
COVERED, DIFFERING = 0, 1
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEPS = [np.uint64(x) for x in mixed(np.arange(300, 305, dtype=np.uint64)) | np.uint64(1)]
_BASE = 0xD1342543DE82EF95
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_POWERS["up"]) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _POWERS[name] = np.cumprod(row)
    return _POWERS["up"], _POWERS["down"]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of string rows in a row, and the rows' bounds."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def anchored_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, start in the row, strings, anchor hash, context hash) of each run.

    A run is the strings in a row, one byte apart, that have the same anchor; its context
    is all bytes they cover.
    """
    empty = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    if len(data) < length:
        return empty
    grams = _TABLE[data]
    coded = grams
    size = 1
    for step in _STEPS:
        grams = grams[:-size] * step + grams[size:]
        size *= 2
    grams = mixed(grams)
    low = np.uint64((1 << 31) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    wide, span = length - ANCHOR + 1, 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: span - wide], least[wide - span :])
    sizes = np.diff(bounds)
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    long = sizes >= length
    np.add.at(edge, bounds[:-1][long], 1)
    np.add.at(edge, bounds[1:][long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    if len(at) == 0:
        return empty
    anchor = (least[at] & low).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    strings = np.diff(np.append(first, len(at)))
    start = at[first]
    stop = start + strings + length - 1
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(coded * up[: len(data)], out=total[1:])
    context = mixed((total[stop] - total[start]) * down[start] + strings.astype(np.uint64))
    row = np.searchsorted(bounds, start, side="right") - 1
    return row, start - bounds[row], strings, grams[anchor[first]], context


def _runs(docs: DataFrame, length: int) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for a, b in row_slices(texts, SLICE_BYTES):
                part = texts.slice(a, b - a)
                row, start, strings, anchor, context = anchored_runs(*_bytes_of(part), length)
                at = (start << START_SHIFT) | strings
                own = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), batch.column(0).take(own), batch.column(2).take(own), pa.array(at)],
                    names=["anchor", "context", "doc", "tie", "at"],
                )

    return docs.select("doc", "text", "tie").mapInArrow(run, "anchor long, context long, doc long, tie long, at long")


def _repeated(runs: DataFrame) -> DataFrame:
    """Runs whose context came before (``COVERED``), and the first run of each context where
    an anchor has several (``DIFFERING``).  The same run of equal rows counts once.

    Rows come sorted by anchor, context and occurrence; a stream of them remembers the first
    and the last row of the running anchor.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # first and last row of the running anchor
        several = False  # whether that anchor is known to have differing contexts
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = [batch.column(i).to_numpy() for i in range(5)]
            rows = [np.concatenate([np.array([h[i] for h in held], dtype=np.int64), x]) for i, x in enumerate(rows)]
            anchor, context, doc, tie, at = rows
            n, old = len(anchor), len(held)
            new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            new_context = new_anchor | np.concatenate([[True], context[1:] != context[:-1]])
            starts = np.flatnonzero(new_anchor)
            many = np.add.reduceat(new_context.astype(np.int64), starts) > 1
            known = several and old > 0
            many[0] |= known
            differing = new_context & np.repeat(many, np.diff(np.append(starts, n)))
            same = np.logical_and.reduce([x[1:] == x[:-1] for x in (doc, tie, at)])
            covered = ~new_context & ~np.concatenate([[False], same])
            if old:
                # The first row still waits if its anchor had one context so far.
                differing[0] &= not known
                if old == 2:
                    differing[1] = covered[1] = False
            first = int(starts[-1])
            several = bool(many[-1])
            held = [tuple(x[i] for x in rows) for i in ([first, n - 1] if first < n - 1 else [first])]
            keep = differing | covered
            yield pa.RecordBatch.from_arrays(
                [pa.array(differing[keep].astype(np.int8)), pa.array(anchor[keep]), pa.array(doc[keep]), pa.array(tie[keep]), pa.array(at[keep])],
                names=["kind", "anchor", "doc", "tie", "at"],
            )

    dealt = runs.repartition("anchor").sortWithinPartitions("anchor", "context", "doc", "tie", "at")
    return dealt.mapInArrow(run, "kind byte, anchor long, doc long, tie long, at long")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of each wanted run, of equal rows once per task at most."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            texts = batch.column(2).cast(pa.string())
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for i, (key, text) in enumerate(zip(keys, texts)):
                if key in seen:
                    continue
                seen.add(key)
                runs = batch.column(3)[i].values
                at = runs.field(1).to_numpy()
                start = at >> START_SHIFT
                stop = start + (at & 127) + length - 1
                data = memoryview(text.as_buffer())
                row = pa.array(np.full(len(at), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        runs.field(0),
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(at),
                        pa.array([bytes(data[a:b]) for a, b in zip(start.tolist(), stop.tolist())], pa.binary()),
                    ],
                    names=["anchor", "doc", "tie", "at", "bytes"],
                )

    lists = wanted.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "at")).alias("runs"))
    joined = docs.join(lists, ["doc", "tie"]).select("doc", "tie", "text", "runs")
    return joined.mapInArrow(run, "anchor long, doc long, tie long, at long, bytes binary")


def later_strings(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """True at each byte where a string of ``length`` bytes, whole inside its row, starts
    that also starts at an earlier byte of any row."""
    order = suffix_array(data)
    shared = permuted_common_prefixes(data, order, length)
    group = np.cumsum(shared[order] < length)
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    long = np.diff(bounds) >= length
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, bounds[1:][long] - length + 1, -1)
    valid = (np.cumsum(inside)[:-1] > 0)[order]
    order, group = order[valid], group[valid]
    later = np.zeros(len(data), dtype=bool)
    if len(order):
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        first = np.minimum.reduceat(order, starts)
        later[order] = order > np.repeat(first, np.diff(np.append(starts, len(order))))
    return later


def _marked(contexts: DataFrame, shards: int, length: int) -> DataFrame:
    """(doc, tie, start, stop): bytes that later strings of each shard cover."""

    def mark(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[(n, "ascending") for n in ("doc", "tie", "at")]))
        # Equal rows of several tasks.
        same = np.logical_and.reduce([np.diff(table[n].to_numpy()) == 0 for n in ("doc", "tie", "at")])
        table = table.filter(pa.array(np.concatenate([[True], ~same])))
        at = table["at"].to_numpy()
        sizes = (at & 127) + length - 1
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b"".join(table["bytes"].to_pylist()), dtype=np.uint8)
        later = np.flatnonzero(later_strings(data, bounds, length))
        row = np.searchsorted(bounds, later, side="right") - 1
        heads = np.flatnonzero((np.diff(later, prepend=-2) != 1) | (np.diff(row, prepend=-1) != 0))
        tails = np.append(heads[1:], len(later)) - 1 if len(heads) else heads
        own = row[heads] if len(heads) else np.empty(0, np.int64)
        start = (at[own] >> START_SHIFT) - bounds[own]
        give_back()
        return pa.table(
            {
                "doc": table["doc"].take(pa.array(own)),
                "tie": table["tie"].take(pa.array(own)),
                "start": pa.array(start + later[heads]),
                "stop": pa.array(start + later[tails] + length),
            }
        )

    dealt = contexts.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(mark, "doc long, tie long, start long, stop long")


def _cut(rows: DataFrame, spans: DataFrame, as_text: bool) -> DataFrame:
    """Merge each row's marked bytes and take them out."""
    lists = spans.groupBy(F.col("doc").alias("_doc"), F.col("tie").alias("_tie")).agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    joined = rows.join(lists, ["_doc", "_tie"], "left").drop("_doc", "_tie")
    names = [n for n in joined.columns if n not in ("_text", "_spans")]
    span = StructType().add("start", LongType()).add("stop", LongType())
    schema = StructType([joined.schema[n] for n in names])
    schema = schema.add("n_bytes", LongType()).add("n_removed", LongType()).add("n_spans", LongType())
    schema = schema.add("spans", ArrayType(span)).add("kept", StringType() if as_text else BinaryType())

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.string())
            lists = batch.column("_spans")
            size, removed, count, kept, starts, stops = [], [], [], [], [], []
            for i, text in enumerate(texts):
                data = memoryview(text.as_buffer() or b"")
                size.append(len(data))
                own = lists[i].values
                a = b = np.empty(0, np.int64)
                if own is not None and len(own):
                    a, b = own.field(0).to_numpy(), own.field(1).to_numpy()
                if len(a):
                    by = np.argsort(a, kind="stable")
                    a, reach = a[by], np.maximum.accumulate(b[by])
                    fresh = np.concatenate([[True], a[1:] > reach[:-1]])
                    heads = np.flatnonzero(fresh)
                    a, b = a[heads], reach[np.append(heads[1:], len(reach)) - 1]
                    edges = [0, *(x for pair in zip(a.tolist(), b.tolist()) for x in pair), len(data)]
                    kept.append(b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2])))
                else:
                    kept.append(bytes(data))
                removed.append(int((b - a).sum()))
                count.append(len(a))
                starts.append(a)
                stops.append(b)
            pairs = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([*x, np.empty(0, np.int64)]), pa.int64()) for x in (starts, stops)], names=["start", "stop"]
            )
            bounds = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(size, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(bounds, pairs),
                    pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()),
                ],
                names=schema.names,
            )

    return joined.mapInArrow(run, schema)


@own_names
def remove_repeats(
    df: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False
) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` and ``kept`` to each row.

    Removed is each byte of a string of ``length`` UTF-8 bytes (33 to 127) that also starts earlier: in
    a smaller id, or at an earlier start of the same text.  Strings overlap freely and never
    cross rows; they are judged on the input.  ``spans`` are the maximal removed runs and
    ``kept`` the other bytes, in order (``as_text``: as a string, without halves of characters).  Null texts are empty; rows without an id come last;
    texts that share an id are ordered by their hash, and rows equal in both are one
    occurrence, so they do not remove each other; an empty table gives none.
    """
    if not ANCHOR < length <= 127:
        raise ValueError("length must be 33 to 127 bytes")
    doc, text = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.coalesce(F.col(text_col), F.lit(""))
    # Texts of one id are told apart by a hash of 64 bits; ids with one text need none.
    digest = F.xxhash64(text)
    several = df.select(doc.alias("doc"), digest.alias("h")).where(F.col("doc") != NO_ID).groupBy("doc").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    tie = digest if several.where("lo <> hi").limit(1).count() else F.when(doc == NO_ID, digest).otherwise(F.lit(0).cast("long"))
    docs = df.select(doc.alias("doc"), text.alias("text"), tie.alias("tie"))
    repeats = stored(_repeated(_runs(docs, length)), "repeats")
    differing = repeats.where(F.col("kind") == DIFFERING)
    shards = max(1, -(-differing.count() * (length + 30) // SHARD_BYTES))
    marked = stored(_marked(_contexts(docs, differing, length), shards, length), "marked")
    start = F.shiftright("at", START_SHIFT)
    covered = repeats.where(F.col("kind") == COVERED).select(
        "doc", "tie", start.alias("start"), (start + F.col("at").bitwiseAND(127) + length - 1).alias("stop")
    )
    return _cut(df.drop(*OUTPUTS).withColumns({"_doc": doc, "_tie": tie, "_text": text}), covered.union(marked), as_text)
