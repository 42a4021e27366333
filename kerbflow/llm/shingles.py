"""Word-shingle sets as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 4_000_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(29))
    x = x * _M2
    return x ^ (x >> np.uint64(32))


def row_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text; a longer text is a range of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + most, side="right")))
        yield at, to
        at = to


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``width`` words, as ascending hashes.

    A-Z are lower-cased; words are separated by space and the control blanks.  A shorter
    text's whole word sequence is its one shingle; a text without words (or null) has none.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    bounds = words.offsets.to_numpy().astype(np.int64)
    coded = words.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    distinct = coded.dictionary
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))
    real = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > 0
    index = coded.indices.to_numpy()
    keep = real[index] if len(index) else np.empty(0, bool)
    ends = np.concatenate([[0], np.cumsum(keep)])[bounds - bounds[0]]
    seq = hashed[index[keep]]
    n = len(seq)
    whole = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for i, factor in enumerate(mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)):
        whole += seq[i : i + len(whole)] * factor
    whole = mixed(whole)
    sets = []
    for a, b in zip(ends, ends[1:]):
        if b - a >= width:
            sets.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64) << np.uint64(40)
            for i in range(a, b):
                one = mixed(one + seq[i : i + 1])
            sets.append(one)
        else:
            sets.append(seq[:0])
    return sets


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit id of each whole set, 0 for empty ones."""
    return np.fromiter((xxhash.xxh3_64_intdigest(s.tobytes()) | 1 if len(s) else 0 for s in sets), np.uint64, len(sets)).view(np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(a) else 0
