"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import own_names

OUTPUTS = ("score", "predicted")
SLOTS = 1 << 18
SLICE_BYTES = 4_000_000
EDGES = "\"'.,;:!?()[]{}<>*_-"


def term_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, hash slot) pairs, ordered by text.

    Terms are blank-separated, lower-cased and trimmed of punctuation; null is empty.
    """
    words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bounds = words.offsets.to_numpy().astype(np.int64)
    coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    terms = (w.lower().strip(EDGES) for w in coded.dictionary.to_pylist())
    slots = np.fromiter((zlib.crc32(t.encode()) % SLOTS if t else -1 for t in terms), np.int64, len(coded.dictionary))
    slots = slots[coded.indices.to_numpy()]
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs = np.unique(rows[slots >= 0] * SLOTS + slots[slots >= 0])
    return pairs // SLOTS, pairs % SLOTS


@dataclass
class FactorizationMachine:
    """Logistic model: bias, a weight per feature, and a factor vector per feature whose
    inner products weigh pairs of features.  ``feature`` maps hash slots to features, -1
    for slots that were never chosen."""

    feature: np.ndarray
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, feats: np.ndarray, n: int) -> np.ndarray:
        """Scores before the logistic function; rows ascending."""
        total = self.bias + _sums(rows, self.weight[feats], n)
        for f in self.factors.T:
            of = f[feats]
            total += 0.5 * (_sums(rows, of, n) ** 2 - _sums(rows, of * of, n))
        return total

    def score(self, texts: pa.Array) -> np.ndarray:
        rows, slots = term_slots(texts)
        feats = self.feature[slots]
        kept = feats >= 0
        raw = self.raw(rows[kept], feats[kept], len(texts))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def _sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums per index, as floats also when there is nothing to add."""
    return np.bincount(index, values, n).astype(float)


def _chosen(flat: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all rows in a row, and where each row's begin and end.

    ``kept`` are the slots that are features, ascending.
    """
    feature = np.full(SLOTS, -1, dtype=np.int32)
    feature[kept] = np.arange(len(kept), dtype=np.int32)
    found = feature[flat]
    inside = found >= 0
    return found[inside], np.concatenate([[0], np.cumsum(inside)])[ends]


def _descend(
    flat: np.ndarray,
    ends: np.ndarray,
    labels: np.ndarray,
    size: int,
    rank: int,
    epochs: int,
    batch: int,
    rate: float,
    positive: float,
    decay: float,
    sparse: float,
    start: float,
    seed: int,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adagrad on the log loss.

    Weights, and factors as one vector each, are drawn to zero by ``sparse``.
    """
    n = len(labels)
    rng = np.random.default_rng(seed)
    rate_of_ones = (labels.sum() + 1) / (n + 2)
    bias = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    weight, factors = np.zeros(size), rng.normal(0, start, (size, rank))
    sum_w, sum_v, sum_b = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            picked = order[at : at + batch]
            length = ends[picked + 1] - ends[picked]
            if not length.sum():
                continue
            local = np.repeat(np.arange(len(picked)), length)
            place = np.repeat(ends[picked + 1] - np.cumsum(length), length) + np.arange(length.sum())
            own = flat[place]
            vectors = factors[own]
            sums = np.stack([_sums(local, v, len(picked)) for v in vectors.T], axis=1)
            squares = _sums(local, (vectors**2).sum(1), len(picked))
            raw = bias + _sums(local, weight[own], len(picked)) + 0.5 * ((sums**2).sum(1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[picked]) * np.where(labels[picked] > 0, positive, 1)
            touched, back = np.unique(own, return_inverse=True)
            pull = error[local] / len(picked)
            grad_w = _sums(back, pull, len(touched)) + decay * weight[touched]
            grad_v = np.stack([_sums(back, pull * (sums[local, f] - vectors[:, f]), len(touched)) for f in range(rank)], axis=1)
            grad_v += decay * factors[touched]
            grad_b = float(error.mean())
            sum_w[touched] += grad_w**2
            sum_v[touched] += grad_v**2
            sum_b += grad_b**2
            step_w, step_v = rate / np.sqrt(sum_w[touched]), 0.3 * rate / np.sqrt(sum_v[touched])
            weights, vectors = weight[touched] - step_w * grad_w, factors[touched] - step_v * grad_v
            if sparse:
                weights = np.sign(weights) * np.maximum(np.abs(weights) - step_w * sparse, 0)
                norm = np.sqrt((vectors**2).sum(1, keepdims=True))
                vectors *= np.maximum(0, 1 - step_v.mean(1, keepdims=True) * sparse / np.maximum(norm, 1e-9))
            weight[touched], factors[touched] = weights, vectors
            bias -= rate * grad_b / np.sqrt(sum_b)
    return bias, weight, factors


def fit(features: list[np.ndarray], labels: np.ndarray, **options) -> FactorizationMachine:
    """:func:`fit_flat` of the distinct slots of each labelled text."""
    flat = np.concatenate([*features, np.empty(0, np.int32)]).astype(np.int32)
    return fit_flat(flat, np.concatenate([[0], np.cumsum([len(f) for f in features])]).astype(np.int64), labels, **options)


def fit_flat(
    flat: np.ndarray,
    ends: np.ndarray,
    labels: np.ndarray,
    rank: int = 6,
    epochs: int = 40,
    batch: int = 256,
    rate: float = 0.2,
    positive: float = 4.0,
    decay: float = 2e-4,
    sparse: float = 0.015,
    min_rows: int = 3,
    steps: int = 520,
    seed: int = 5,
) -> FactorizationMachine:
    """Fit on the distinct slots of each labelled text, all in a row, and where they end.

    The machine is first fitted over all slots that ``min_rows`` texts have (a rarer one can
    tell nothing of other texts), drawn to zero by ``sparse``: what a slot does alone or
    only together with others decides whether it stays.  Then it is fitted anew, freely,
    over those that stayed.  Each fit takes all rows ``epochs`` times, or fewer times (but
    five) once it has taken ``steps`` batches.  A toxic row counts ``positive`` times because such rows are
    few; seeded.  Without rows, or where no slot stays, the model is its bias.
    """
    labels = np.asarray(labels, dtype=np.float64)
    kept = np.flatnonzero(np.bincount(flat, minlength=SLOTS) >= min_rows)
    epochs = min(epochs, max(5, -(-steps * batch // max(1, len(labels)))))
    for first in (True, False):
        own, own_ends = _chosen(flat, ends, kept)
        drawn, start = (sparse, 0.1) if first else (0.0, 0.02)
        bias, weight, factors = _descend(
            own, own_ends, labels, len(kept), rank, epochs, batch, rate, positive, decay, drawn, start, seed
        )
        if first:
            kept = kept[(weight != 0) | (factors != 0).any(axis=1)]
    feature = np.full(SLOTS, -1, dtype=np.int64)
    feature[kept] = np.arange(len(kept))
    return FactorizationMachine(feature, bias, weight, factors)


def held_out(id_col: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text divides by 5 (null as empty)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 == 0


def train(
    df: DataFrame, labels: DataFrame, max_rows: int = 20_000, seed: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> FactorizationMachine:
    """Fit on at most ``max_rows`` labelled rows that are not held out.

    The rows are the first of a seeded order of ids, and again of the texts found for them,
    as ids may repeat.  They are few enough to broadcast, so the documents are
    not shuffled; only hash slots (at most ``SLOTS`` a text) reach the driver.  Null labels
    are ignored.  Without labelled rows the model is its bias.
    """
    order = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    sample = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), order.alias("_o"))
    sample = sample.orderBy("_o", "_id", "_y").limit(max_rows)
    rows = df.join(F.broadcast(sample), F.col(id_col) == F.col("_id")).select("_o", "_y", F.col(text_col).alias("_t"))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2)
            found_rows, found = term_slots(texts)
            ends = np.searchsorted(found_rows, np.arange(len(texts) + 1))
            data = [found[x:y].astype("<i4").tobytes() for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(data, pa.binary())], names=["o", "y", "slots"])

    found = rows.mapInArrow(slots, "o long, y int, slots binary")
    got = found.toArrow().sort_by([("o", "ascending"), ("y", "ascending"), ("slots", "ascending")]).slice(0, max_rows)
    found_slots = got["slots"].cast(pa.large_binary()).combine_chunks()
    if not len(found_slots):
        return fit([], np.empty(0), seed=seed)
    # Views of one buffer: as many small arrays would leave the driver's memory in pieces.
    offsets = np.frombuffer(found_slots.buffers()[1], np.int64)[found_slots.offset : found_slots.offset + len(found_slots) + 1]
    held = found_slots.buffers()[2]
    flat = np.frombuffer(held, "<i4", (offsets[-1] - offsets[0]) // 4, offsets[0]) if offsets[-1] > offsets[0] else np.empty(0, np.int32)
    return fit_flat(flat, (offsets - offsets[0]) // 4, got["y"].to_numpy(), seed=seed)


@own_names
def score_toxicity(df: DataFrame, model: FactorizationMachine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) to each row.

    The model has a fixed size and is broadcast; whole texts are read, nothing is shuffled.
    Null and empty texts get the score of the bias alone; an empty table gives none.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        texts = pa.array(text, pa.string(), from_pandas=True)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        out, at = [np.empty(0)], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            out.append(held.value.score(texts.slice(at, to - at)))
            at = to
        return pd.Series(np.concatenate(out))

    scored = df.drop(*OUTPUTS).withColumn("score", score(F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
