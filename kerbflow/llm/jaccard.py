"""Exact n-gram Jaccard self-join by universe partitioning.

Shingles are hashed into segments; how many depends on the set's size band.  Two sets
within the threshold differ in at most H shingles, so when a set r spreads H + 1 units over
the segments (0: skip, 1: equal segment, 2: equal up to one shingle), some segment of its
partner differs by less than its units.  Every set indexes its segment subsets; the first
segments of a band also index their one-deletion neighbourhoods, and only those may get two
units.  Each set spends its units where keys are rare, by a sketch of all keys' counts of a
fixed size; a wrong estimate costs time, never a link.

Copies (equal sets) are one node from the start.  Each set is first compared with one
candidate only, the set that the most others share segments with, which in a group of
edited copies is the original; what that links need not be compared again, so the second
and complete comparison meets only pairs whose components still differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import lean, own_names, release, stored
from kerbflow.llm.graphs import components
from kerbflow.llm.shingles import mixed, overlap, row_slices, set_ids, shingle_sets

OUTPUTS = ("n_shingles", "component_id", "n_links")
SKETCH_BITS = 20
SKETCH_PART = 1 << 14  # counters in one row of the sketch
PARITY = 8  # 64-bit words of the parity sketch of every set
LONG_SET = 1000  # larger sets also have a parity sketch of a bit or two per shingle
FILTER_BITS = 25  # of the filter for candidates' ids: 4 MB
BAND_GROWTH = 1.5
DOUBLE_SHARE = 16  # one segment in so many may get two units
INDEXED, PROBES = 1, 2
_SEG, _ONE, _DEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019), np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Threshold:
    """Two sets link when ``of * intersection >= at_least * union``."""

    at_least: int = 80
    of: int = 100

    def apart(self, sizes: int) -> int:
        """Most shingles in which linked sets differ, by the sum of their sizes."""
        return sizes * (self.of - self.at_least) // (self.of + self.at_least)

    def largest_partner(self, size: int) -> int:
        return size * self.of // self.at_least


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    segments: int
    doubles: int


@lru_cache(maxsize=None)
def bands_of(threshold: Threshold, low: int, high: int) -> tuple[Band, ...]:
    """The size bands that meet sizes ``low`` to ``high``."""
    found, start, number = [], 1, 0
    while start <= high:
        end = max(start, int(start * BAND_GROWTH) - 1)
        if end >= low:
            segments = threshold.apart(2 * end) + 1
            found.append(Band(number, start, end, segments, -(-segments // DOUBLE_SHARE)))
        start, number = end + 1, number + 1
    return tuple(found)


class Segments:
    """A set's segments in one band: sums of mixed shingles, so that one can be taken out."""

    def __init__(self, shingles: np.ndarray, band: Band):
        self.band = band
        self.place = ((mixed(shingles ^ _SEG) >> np.uint64(11)) % np.uint64(band.segments)).astype(np.int64)
        self.parts = mixed(shingles + _ONE)
        self.sums = np.zeros(band.segments, dtype=np.uint64)
        np.add.at(self.sums, self.place, self.parts)
        self.salt = mixed(np.arange(band.segments, dtype=np.uint64) + np.uint64(band.number << 32))

    def keys(self) -> np.ndarray:
        return mixed(self.sums ^ self.salt)

    def deletions(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, key) of each wanted segment with one shingle left out."""
        at = np.flatnonzero(wanted[self.place])
        seg = self.place[at]
        return seg, mixed((self.sums[seg] - self.parts[at]) ^ self.salt[seg])


def _shorter(keys: np.ndarray) -> np.ndarray:
    """Key space of one-deletion neighbourhoods."""
    return mixed(keys ^ _DEL)


def allocate(one: np.ndarray, two: np.ndarray, units: int) -> np.ndarray:
    """Units (0, 1, 2) per segment, ``units`` in all, at small cost.

    ``one`` is the cost of a segment's first unit, ``two`` of its second (inf where it may
    have none).  Where the second is cheaper than the first, both go at their mean.
    """
    second = np.maximum(one, two)
    both = two < one
    first = np.where(both, (one + two) / 2, one)
    second = np.where(both, first, second)
    n = len(one)
    order = np.argsort(np.concatenate([first, second]), kind="stable")[:units]
    return np.bincount(order % n, minlength=n)


def _parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bit b tells whether an odd number of shingles falls on it; two sets have at most as
    many unlike bits as unlike shingles."""
    odd = np.bincount(((mixed(shingles) >> np.uint64(7)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _digest(df: DataFrame, id_col: str, text_col: str, width: int, threshold: Threshold) -> DataFrame:
    """Set sizes, ids and parity sketches per row, and per task the counts of segment keys."""
    names = ["doc_id", "n", "sid", *(f"p{i}" for i in range(PARITY)), "parity", "part", "counts"]
    kinds = "doc_id long, n int, sid long, " + ", ".join(f"p{i} long" for i in range(PARITY)) + ", parity binary, part int, counts binary"

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for a, b in row_slices(texts):
                sets = shingle_sets(texts.slice(a, b - a), width)
                sizes = np.array([len(s) for s in sets], dtype=np.int32)
                parity = np.zeros((PARITY, len(sets)), dtype=np.int64)
                for i, s in enumerate(sets):
                    if len(s):
                        band = bands_of(threshold, len(s), len(s))[0]
                        keys = Segments(s, band).keys() & np.uint64((1 << SKETCH_BITS) - 1)
                        np.add.at(sketch, keys.astype(np.int64), 1)
                        parity[:, i] = _parity(s, 64 * PARITY).view("<i8")
                n = len(sets)
                long = [_parity(s, 1 << (len(s) - 1).bit_length()).tobytes() if len(s) > LONG_SET else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(sizes), pa.array(set_ids(sets)), *map(pa.array, parity), pa.array(long, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=names,
                )
        parts = [sketch[i : i + SKETCH_PART] for i in range(0, len(sketch), SKETCH_PART)]
        n = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.int64()) for _ in range(PARITY + 1)), pa.nulls(n, pa.binary()), pa.array(range(n), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
            names=names,
        )

    return df.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, kinds)


def _sketch(parts: DataFrame) -> np.ndarray:
    """Key counts over all tasks: 2**SKETCH_BITS numbers, whatever the input's size."""

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(SKETCH_PART, dtype=np.uint64), None
        for t in tables:
            part = t.column(0)[0]
            for x in t.column(1):
                total += np.frombuffer(x.as_buffer(), dtype=np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "counts"])

    summed = parts.select("part", "counts").groupBy("part").applyInArrow(add, "part int, counts binary").toArrow().sort_by("part")
    if summed.num_rows == 0:
        return np.zeros(1 << SKETCH_BITS)
    counts = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in summed["counts"].to_pylist()])
    return np.maximum(counts - counts.mean(), 0).astype(np.float32)


def _postings(df: DataFrame, text_col: str, width: int, threshold: Threshold, sketch: np.ndarray) -> DataFrame:
    """(key, sid, role): what each set indexes and probes."""
    held = df.sparkSession.sparkContext.broadcast(sketch)
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def of_set(s: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        n = len(s)
        for band in bands_of(threshold, n, threshold.largest_partner(n)):
            own = band.low <= n <= band.high
            segments = Segments(s, band)
            keys = segments.keys()
            cost = lambda k: counts[(k & mask).astype(np.int64)] + 1.0
            doubles = np.arange(band.segments) < band.doubles
            seg, shorter = segments.deletions(doubles)
            one = cost(keys)
            two = np.where(doubles, cost(keys) + 1, np.inf)
            np.add.at(two, seg, cost(shorter))
            units = allocate(one, two, threshold.apart(n + min(band.high, threshold.largest_partner(n))) + 1)
            if own:
                yield keys, INDEXED, np.where(units > 0, INDEXED | PROBES, INDEXED)
                yield _shorter(shorter), INDEXED, None
            else:
                yield keys[units > 0], PROBES, None
            twice = units == 2
            if twice.any():
                yield _shorter(keys[twice]), PROBES, None
                yield shorter[twice[seg]], PROBES, None

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # sets this task has posted: copies add nothing
        for batch in batches:
            texts = batch.column(0).cast(pa.string())
            for a, b in row_slices(texts):
                sets = shingle_sets(texts.slice(a, b - a), width)
                keys, sids, roles = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int8)]
                for s, sid in zip(sets, set_ids(sets).tolist()):
                    if len(s) and sid not in seen:
                        seen.add(sid)
                        for k, role, each in of_set(s, held.value):
                            keys.append(k)
                            sids.append(np.full(len(k), sid))
                            roles.append(np.full(len(k), role, np.int8) if each is None else each.astype(np.int8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sids)), pa.array(np.concatenate(roles))],
                    names=["key", "sid", "role"],
                )

    return df.select(text_col).mapInArrow(run, "key long, sid long, role byte")


def _shared_keys(postings: DataFrame) -> DataFrame:
    """Postings of keys that some set probes and that more than one set has.

    Rows come sorted by key, probing ones first, so a stream of them needs to remember one
    row: the first of the running key.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shared = None, False  # first row of the running key; whether it is known to be shared
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, sid, role = (batch.column(i).to_numpy() for i in range(3))
            if first is not None:
                key, sid, role = (np.concatenate([[f], x]) for f, x in zip(first, (key, sid, role)))
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            length = np.diff(np.concatenate([starts, [len(key)]]))
            lead = np.repeat(starts, length)
            differs = np.logical_or.reduceat(sid != sid[lead], starts)
            if first is not None and shared:
                differs[0] = True
            good = differs & (role[starts] >= PROBES)
            keep = np.repeat(good, length)
            if first is not None and shared:
                keep[0] = False
            first, shared = (key[starts[-1]], sid[starts[-1]], role[starts[-1]]), bool(differs[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), pa.array(sid[keep]), pa.array(role[keep].astype(np.int8))], names=["key", "sid", "role"]
            )

    dealt = postings.repartition("key").sortWithinPartitions("key", F.col("role").desc(), "sid")
    return dealt.mapInArrow(run, "key long, sid long, role byte")


def _flipped(a: str, b: str) -> Column:
    """Unlike bits of two parity sketches."""
    return sum((F.bit_count(F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}"))) for i in range(PARITY)), F.lit(0))


def _may_link(threshold: Threshold, a: str, b: str) -> Column:
    """Sizes and parity sketches allow a link: each differing shingle flips one parity bit."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    flipped = _flipped(a, b)
    sizes = F.least(na, nb) * threshold.of >= F.greatest(na, nb) * threshold.at_least
    return sizes & (flipped * (threshold.of + threshold.at_least) <= (na + nb) * (threshold.of - threshold.at_least))


def _still_close(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs (a, b, unlike) of long sets whose finer parity sketches also allow a link, and
    all others; ``unlike`` counts the unlike bits.

    Sketches are about fifty times smaller than the texts.  The larger one is folded to the
    smaller one's size, halves exclusively or-ed.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, bits = [], []
            columns = (batch.column(i).to_pylist() for i in range(2, 7))
            for i, (na, nb, a, b, unlike) in enumerate(zip(*columns)):
                if a is not None and b is not None:
                    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
                    while len(y) > len(x):
                        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                    unlike = int(np.bitwise_count(x ^ y).sum())
                    if unlike > threshold.apart(na + nb):
                        continue
                good.append(i)
                bits.append(unlike)
            ids = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids.column(0), ids.column(1), pa.array(bits, pa.int32())], names=["a", "b", "unlike"])

    own = sets.select("sid", "n", "parity")
    left = own.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    right = own.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "pa", "pb", "unlike").mapInArrow(run, "a long, b long, unlike int")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: Threshold) -> DataFrame:
    """The (a, b) pairs of set ids that really link."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            good = []
            ids = batch.column(0).to_pylist()
            for a, b in row_slices(batch.column(2)):
                right = shingle_sets(batch.column(2).slice(a, b - a), width)
                for i, other in zip(range(a, b), right):
                    if ids[i] != last:
                        last, left = ids[i], shingle_sets(batch.column(3).slice(i, 1), width)[0]
                    common = overlap(left, other)
                    if threshold.of * common >= threshold.at_least * (len(left) + len(other) - common):
                        good.append(i)
            yield batch.take(pa.array(good, pa.int64())).select(["a", "b"])

    with_b = pairs.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a")
    return with_a.select("a", "b", "text_b", "text_a").mapInArrow(run, "a long, b long")


def _slot(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(1 << FILTER_BITS)).alias("slot")


def _sid_slot(sid: Column | np.ndarray) -> Column | np.ndarray:
    """A set's slot, of bits of its id; the lowest is always set."""
    mask = (1 << FILTER_BITS) - 1
    return (sid >> 1) & mask if isinstance(sid, np.ndarray) else F.shiftright(sid, 1).bitwiseAND(F.lit(mask).cast("long"))


def _filter(slots: DataFrame) -> np.ndarray:
    """Bit of every slot: ``2**FILTER_BITS`` bits, whatever the number of rows."""
    word = F.shiftright("slot", 6).alias("word")
    found = slots.groupBy(word).agg(F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("bits")).toArrow()
    words = np.zeros((1 << FILTER_BITS) // 64, dtype="<i8")
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint8)


def _candidate_texts(df: DataFrame, sets: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(sid, text): one text for each of the sets, that of their ``doc_id``, which may be null.

    Most other rows stop at filters of fixed size before the join, so they are not
    shuffled; the join decides.  Rows without an id are filtered by their set, once per task.
    """
    nameless = _filter(sets.where("doc_id is null").select(_sid_slot(F.col("sid")).alias("slot")))
    held = df.sparkSession.sparkContext.broadcast((_filter(sets.where("doc_id is not null").select(_slot("doc_id"))), nameless if nameless.any() else None))

    def hit(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return (bits[slot >> 3] >> (slot & 7)) & 1 == 1

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_ids, of_sets = held.value
        seen: set[int] = set()  # sets of rows without an id
        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.where(null, of_sets is not None, hit(of_ids, batch.column(2).to_numpy()))))
            texts = batch.column(1).cast(pa.string())
            for a, b in row_slices(texts):
                part, ids = texts.slice(a, b - a), batch.column(0).slice(a, b - a)
                sids = set_ids(shingle_sets(part, width))
                keep = np.ones(len(part), dtype=bool)
                if ids.null_count:
                    wanted = hit(of_sets, _sid_slot(sids))
                    for i in np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)).tolist():
                        keep[i] = wanted[i] and int(sids[i]) not in seen
                        if keep[i]:
                            seen.add(int(sids[i]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(sids), part], names=["doc_id", "sid", "text"]).filter(pa.array(keep))

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t")).select("doc_id", "_t", _slot("doc_id"))
    # A null id is an ordinary value here.
    own, fits = rows.mapInArrow(run, "doc_id long, sid long, text string").alias("r"), sets.select("doc_id", "sid").alias("s")
    found = own.join(fits, (F.col("r.sid") == F.col("s.sid")) & F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")), "left_semi")
    return found.dropDuplicates(["doc_id", "sid"]).select("sid", "text")


@own_names
def jaccard_join(
    df: DataFrame, width: int = 5, threshold: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per input row: ``doc_id``, ``n_shingles`` (set size) and ``component_id``, the
    smallest ``doc_id`` reachable over links of the threshold.

    Every link between different sets is either compared or lies inside a component that
    other links hold together, so components are those of the full join.  Null, empty and
    blank texts have no shingles and link with nothing; equal sets always link; repeated
    rows are rows of their own; rows with a null id link as others do, and a component of
    such rows only has a null id; an empty table gives none.  Whole texts are compared, at any length.
    """
    digest = stored(_digest(df, id_col, text_col, width, threshold), "sets")
    members = digest.where("part is null").drop("part", "counts")
    sketch = _sketch(digest.where("part is not null"))
    sets = members.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("parity").alias("parity"), *(F.first(f"p{i}").alias(f"p{i}") for i in range(PARITY)))
    shared = stored(_shared_keys(_postings(df, text_col, width, threshold, sketch)), "keys").distinct()
    release(df.sparkSession)
    sets = stored(sets.join(shared.select("sid").distinct(), "sid", "left_semi"), "classes")
    texts = stored(_candidate_texts(df, sets, id_col, text_col, width), "texts")

    release(df.sparkSession)

    star = _leads(shared).where("sid <> a").select("a", F.col("sid").alias("b")).distinct()
    close = _still_close(_limited(star, sets, threshold), sets, threshold)
    first = stored(close.groupBy("b").agg(F.min_by("a", "unlike").alias("a")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    links = stored(_verified(first, texts, width, threshold), "first")
    release(df.sparkSession)
    found = stored(components(links), "parts")

    labels = sets.join(found, F.col("sid") == F.col("node"), "left").select(sets["*"], F.coalesce("component", "sid").alias("component"))
    known = shared.join(labels.drop("parity"), "sid")
    # Only keys that still hold more than one component.
    open_keys = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    left = stored(known.join(open_keys, "key", "left_semi"), "open")
    probing, indexed = left.where(F.col("role") >= PROBES), left.where((F.col("role") % 2) == INDEXED)
    rest = (
        probing.alias("x")
        .join(indexed.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & _may_link(threshold, "x", "y"))
        .select(F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b"), _flipped("x", "y").alias("unlike"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    rest = stored(_still_close(rest, sets, threshold).drop("unlike"), "rest")
    more = stored(_verified(rest, texts, width, threshold), "second")
    final = components(links.union(more)).join(members.select("sid", "doc_id"), F.col("node") == F.col("sid"))
    smallest = final.groupBy("component").agg(F.min("doc_id").alias("least"))
    by_set = stored(final.select("node", "component").distinct().join(smallest, "component").select(F.col("node").alias("sid"), "least"), "result")
    alone = members.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("own"))
    named = alone.join(by_set, "sid", "left").select("sid", F.coalesce("least", "own").alias("component_id"))
    rows = members.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "sid")
    return rows.join(named, "sid", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _leads(shared: DataFrame) -> DataFrame:
    """(sid, a) for each posting: ``a`` is the set of its key that has the most company, by
    the posting counts of all its keys."""
    company = shared.join(shared.groupBy("key").agg(F.count("*").alias("c")), "key").groupBy("sid").agg(F.sum("c").alias("c"))
    # Ties go by the set's own hash.
    order = F.shiftleft("c", 20).bitwiseOR(F.col("sid").bitwiseAND(F.lit((1 << 20) - 1)))
    lead = shared.join(company.select("sid", order.alias("o")), "sid").groupBy("key").agg(F.max_by("sid", "o").alias("a"))
    return shared.select("key", "sid").join(lead, "key")


def _limited(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs whose sizes and sketches allow a link, with their count of unlike bits."""
    x, y = sets.alias("x"), sets.alias("y")
    both = pairs.join(x, F.col("a") == F.col("x.sid")).join(y, F.col("b") == F.col("y.sid"))
    return both.where(_may_link(threshold, "x", "y")).select("a", "b", _flipped("x", "y").alias("unlike"))
