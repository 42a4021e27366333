"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in halves, each half is quantised by its own centroids, and a pair of
centroids is a cell.  A query meets cells in the order of the summed inner products of its
halves with the centroids, by a heap, until the cells hold a given share of all vectors;
their entries are ranked by exact inner products in double precision.

Equal vectors are one entry with its smallest ids, which are all that can be among the
nearest; so a vector that a third of all rows share costs one entry.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbflow.llm.common import stored

CELL_ROWS = 200  # entries of a cell on average, up to MOST_CENTROIDS
MOST_CENTROIDS = 256
PART_ROWS = 4096  # entries of a cell that are ranked together


@dataclass
class MultiIndex:
    """Centroids of both halves, entries per cell, and the share of entries to visit."""

    left: np.ndarray
    right: np.ndarray
    share: float
    counts: np.ndarray | None = None

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = vectors.shape[1] // 2
        return _nearest(vectors[:, :half], self.left) * len(self.right) + _nearest(vectors[:, half:], self.right)

    def visit(self, query: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
        """Non-empty cells by falling summed score, until they hold ``wanted`` entries.

        The heap holds the frontier of pairs (i, j) of the two sorted centroid lists; a pair
        enters once its neighbour with smaller i or j has left.
        """
        half = len(query) // 2
        a, b = self.left @ query[:half], self.right @ query[half:]
        first, second = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b = a[first].tolist(), b[second].tolist()
        heap, found, total = [(-(a[0] + b[0]), 0, 0)], [], 0
        while heap and total < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(first[i]) * len(b) + int(second[j])
            if counts[cell]:
                found.append(cell)
                total += int(counts[cell])
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
        return found


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(rows @ centroids.T - 0.5 * (centroids**2).sum(1), axis=1)


def _centroids(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=len(rows) < k)].copy()
    for _ in range(rounds):
        own = _nearest(rows, centres)
        sizes = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit_index(sample: np.ndarray, total: int, k: int, recall: float, seed: int = 3, probes: int = 200) -> MultiIndex:
    """Centroids from a sample, and the share of entries that reaches ``recall`` on it.

    ``recall`` is measured against brute force on the sample for ``probes`` of its rows.  In
    a larger table neighbours are closer, so the share found on a sample is enough there.
    """
    rng = np.random.default_rng(seed)
    centroids = min(MOST_CENTROIDS, max(1, math.isqrt(total // CELL_ROWS)))
    if len(sample) == 0:
        return MultiIndex(np.zeros((1, 0)), np.zeros((1, 0)), 1.0)
    half = sample.shape[1] // 2
    index = MultiIndex(_centroids(sample[:, :half], centroids, rng), _centroids(sample[:, half:], centroids, rng), 1.0)
    cells = index.cells(sample)
    counts = np.bincount(cells, minlength=centroids**2)
    needed = []
    for i in rng.choice(len(sample), min(probes, len(sample)), replace=False):
        scores = sample @ sample[i]
        scores[i] = -np.inf
        near = np.argsort(-scores)[: min(k, len(sample) - 1)]
        order = index.visit(sample[i], counts, len(sample))
        reached = np.zeros(centroids**2)
        reached[order] = np.cumsum(counts[order]) - counts[order] + 1
        needed.extend(reached[cells[near]] / len(sample))
    index.share = float(np.quantile(needed, recall)) if needed else 1.0
    return index


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest_neighbours(
    df: DataFrame,
    k: int = 20,
    query_every: int = 20,
    recall: float = 0.97,
    sample_rows: int = 20_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    seed: int = 3,
) -> DataFrame:
    """The ``k`` nearest rows of each row whose id is divisible by ``query_every``.

    Returns query_id, rank (from 1), vec_id and score, nearest first, ties to the smaller
    id; a row with the query's own id is never its neighbour.  The index is fitted on the
    ``sample_rows`` distinct vectors that come first by a seeded hash; every vector is
    indexed.  Vectors that are null, zero, of another than the most frequent length, or hold null or
    non-finite components take no part, nor do rows without an id; repeated ids are rows of
    their own; an empty table gives none.
    """
    keep = k + 1
    base = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    usual = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).where("d > 0").orderBy(F.desc("n"), "d").limit(1).collect()
    dim = usual[0]["d"] if usual else 1
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = base.where((F.size("v") == dim) & finite & F.exists("v", lambda x: x != 0))
    keyed = good.withColumn("a", F.xxhash64("v")).withColumn("b", F.xxhash64(F.lit(seed), "v"))
    copies = W.partitionBy("a", "b").orderBy("id")
    ranked = stored(keyed.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= keep), "vectors")
    entries = ranked.where("place = 1").select(F.col("id").alias("entry"), "a", "b", "v")
    members = ranked.select("id", "a", "b").join(entries.select("entry", "a", "b"), ["a", "b"]).select("entry", "id")
    asked = good.where(F.col("id") % query_every == 0).select("id", F.xxhash64("v").alias("a"), F.xxhash64(F.lit(seed), "v").alias("b"))
    asked = asked.join(entries.select("entry", "a", "b"), ["a", "b"]).select(F.col("id").alias("query_id"), F.col("entry").alias("query"))

    total = entries.count()
    sampled = entries.orderBy(F.xxhash64(F.lit(seed), "a"), "entry").limit(sample_rows).select("v").toArrow()
    sample = _matrix(sampled["v"], dim)
    index = fit_index(sample, total, k, recall, seed)
    held = df.sparkSession.sparkContext.broadcast(index)
    known = df.sparkSession.sparkContext.broadcast((sample, index.cells(sample) if len(sample) else np.empty(0, np.int64)))

    def bound(scores: np.ndarray, cells: np.ndarray, visited: list[int]) -> float:
        """What the k-th nearest found reaches at least: the sample's vectors in the visited
        cells will be found too."""
        met = scores[np.isin(cells, visited)]
        return float(np.partition(met, -keep)[-keep]) - 1e-9 if len(met) >= keep else -np.inf

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = held.value.cells(_matrix(b.column(1), dim)) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells.astype(np.int32))], names=["entry", "v", "cell"])

    vector = entries.schema["v"].dataType.simpleString()
    placed = stored(entries.select("entry", "v").mapInArrow(place, f"entry long, v {vector}, cell int"), "cells")
    counts = np.zeros(len(index.left) * len(index.right), dtype=np.int64)
    for cell, n in placed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        counts[cell] = n
    wanted = max(math.ceil(index.share * total), keep)
    parts = np.maximum(1, -(-counts // PART_ROWS))
    sizes = df.sparkSession.sparkContext.broadcast((counts, parts))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of, parts_of = sizes.value
        for b in batches:
            rows, cells, pieces = [], [], []
            queries = _matrix(b.column(1), dim)
            rows_known, cells_known = known.value
            least = []
            for i, q in enumerate(queries):
                visited = held.value.visit(q, n_of, wanted)
                least.append(bound(rows_known @ q, cells_known, visited))
                for cell in visited:
                    for piece in range(parts_of[cell]):
                        rows.append(i)
                        cells.append(cell)
                        pieces.append(piece)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(least, pa.float64()).take(at), pa.array(cells, pa.int32()), pa.array(pieces, pa.int32())],
                names=["query", "v", "least", "cell", "part"],
            )

    vectors = asked.select("query").distinct().join(placed.select(F.col("entry").alias("query"), "v"), "query")
    probes = vectors.select("query", "v").mapInArrow(probe, f"query long, v {vector}, least double, cell int, part int")

    def rerank(own: pa.Table, asking: pa.Table) -> pa.Table:
        empty = {"query": pa.array([], pa.int64()), "entry": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if own.num_rows == 0 or asking.num_rows == 0:
            return pa.table(empty)
        # One fixed order of entries, so that ties at the cut go to the smaller id.
        own = own.sort_by("entry")
        ids, rows, queries = own["entry"].to_numpy(), _matrix(own["v"], dim), _matrix(asking["v"], dim)
        names, least = asking["query"].to_numpy(), asking["least"].to_numpy()
        out = []
        for at in range(0, len(queries), 512):
            some = queries[at : at + 512]
            best = np.argsort(-(some @ rows.T), axis=1, kind="stable")[:, : keep + 8]
            which = np.repeat(np.arange(len(some)), best.shape[1])
            # Scores summed in the same order for every pair.
            exact = np.einsum("ij,ij->i", some[which], rows[best.ravel()]).reshape(best.shape)
            top = np.take_along_axis(best, np.lexsort((ids[best], -exact), axis=1)[:, :keep], axis=1)
            which = np.repeat(np.arange(len(some)), top.shape[1])
            score = np.einsum("ij,ij->i", some[which], rows[top.ravel()])
            good = score >= least[at : at + 512][which]
            out.append((names[at : at + 512][which][good], ids[top.ravel()][good], score[good]))
        q, e, s = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query": pa.array(q), "entry": pa.array(e), "score": pa.array(s)})

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("entry"), F.element_at(F.lit(parts.tolist()), F.col("cell") + 1)).cast("int"))
    near = dealt.groupBy("cell", "part").cogroup(probes.groupBy("cell", "part")).applyInArrow(rerank, "query long, entry long, score double")
    best = W.partitionBy("query").orderBy(F.desc("score"), "entry")
    top = stored(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep).drop("place"), "near")
    lists = top.join(members, "entry").groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), F.col("id").alias("vec_id")))).alias("found"))
    rows = asked.join(lists, "query").select("query_id", F.filter("found", lambda x: x["vec_id"] != F.col("query_id")).alias("found"))
    return rows.select("query_id", F.posexplode(F.slice("found", 1, k)).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )
