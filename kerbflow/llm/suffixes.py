"""Suffix arrays by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import numpy as np


def _smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (type S); the last is not."""
    n = len(text)
    wide = text.astype(np.int64)
    step = np.sign(np.diff(wide, append=-1)).astype(np.int8)
    settled = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(settled[::-1])[::-1]
    return step[following] > 0


def _leftmost(types: np.ndarray) -> np.ndarray:
    return np.flatnonzero(types[1:] & ~types[:-1]) + 1


def _induce(text: np.ndarray, types: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the given order of leftmost-smaller ones induces.

    A bucket's entries push their left neighbours to other buckets, a whole wave of entries
    at a time; a wave that stays in its own bucket is the next wave.
    """
    n = len(text)
    sizes = np.bincount(text, minlength=256)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = np.argsort(text[leftmost], kind="stable")
    seeds = leftmost[order]
    seed_ends = np.cumsum(np.bincount(text[leftmost], minlength=256))
    out = np.empty(n, dtype=np.int64)
    chars = np.flatnonzero(sizes)

    head = starts.copy()
    out[head[text[n - 1]]] = n - 1
    head[text[n - 1]] += 1

    def push(entries: np.ndarray, smaller: bool, edge: np.ndarray) -> None:
        left = entries[entries > 0] - 1
        left = left[types[left] == smaller]
        if len(left) == 0:
            return
        char = text[left]
        by = np.argsort(char, kind="stable")
        left, char = left[by], char[by]
        count = np.bincount(char, minlength=256)
        rank = np.arange(len(left)) - (np.cumsum(count) - count)[char]
        if smaller:
            out[edge[char] - 1 - rank] = left
            edge -= count
        else:
            out[edge[char] + rank] = left
            edge += count

    for c in chars:
        done = starts[c]
        while done < head[c]:
            wave, done = out[done : head[c]], head[c]
            push(wave.copy(), False, head)
        push(seeds[(seed_ends[c - 1] if c else 0) : seed_ends[c]], False, head)
    tail = ends.copy()
    for c in chars[::-1]:
        done = ends[c]
        while done > tail[c]:
            wave, done = out[tail[c] : done][::-1], tail[c]
            push(wave.copy(), True, tail)
        push(out[starts[c] : head[c]][::-1], True, tail)
    return out


def _induce_numbers(s: list[int], types: list[bool], leftmost: list[int], size: int) -> list[int]:
    """The same for large alphabets, entry by entry."""
    n = len(s)
    count = [0] * size
    for c in s:
        count[c] += 1
    starts, total = [0] * size, 0
    for c in range(size):
        starts[c] = total
        total += count[c]
    ends = [a + b for a, b in zip(starts, count)]
    out = [-1] * n
    tail = ends.copy()
    for j in reversed(leftmost):
        c = s[j]
        tail[c] -= 1
        out[tail[c]] = j
    head = starts.copy()
    c = s[n - 1]
    out[head[c]] = n - 1
    head[c] += 1
    for i in range(n):
        j = out[i] - 1
        if j >= 0 and not types[j]:
            c = s[j]
            out[head[c]] = j
            head[c] += 1
    tail = ends
    for i in range(n - 1, -1, -1):
        j = out[i] - 1
        if j >= 0 and types[j]:
            c = s[j]
            tail[c] -= 1
            out[tail[c]] = j
    return out


def _named(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings, equal ones alike, in text order."""
    until = np.append(leftmost[1:], len(text) - 1)
    index = np.empty(len(text), dtype=np.int64)
    index[leftmost] = np.arange(len(leftmost))
    length = (until - leftmost + 1)[index[ordered]]
    same = length[1:] == length[:-1]
    # The last one runs into the end of the text and equals no other.
    same &= (ordered[1:] != leftmost[-1]) & (ordered[:-1] != leftmost[-1])
    active, offset = np.flatnonzero(same), 0
    while len(active):
        active = active[offset < length[active]]
        differ = text[ordered[active] + offset] != text[ordered[active + 1] + offset]
        same[active[differ]] = False
        active = active[~differ]
        offset += 1
    names = np.empty(len(leftmost), dtype=np.int64)
    names[index[ordered]] = np.concatenate([[0], np.cumsum(~same)])
    return names


def _sorted_numbers(s: np.ndarray) -> np.ndarray:
    """Suffix order of a string of ranks, by the same recursion."""
    n, size = len(s), int(s.max()) + 1
    if size == n:
        out = np.empty(n, dtype=np.int64)
        out[s] = np.arange(n)
        return out
    types = _smaller_types(s)
    leftmost = _leftmost(types)
    values, kinds = s.tolist(), types.tolist()
    if len(leftmost) > 1:
        first = np.array(_induce_numbers(values, kinds, leftmost.tolist(), size))
        marked = np.zeros(n, dtype=bool)
        marked[leftmost] = True
        names = _named(s, leftmost, first[marked[first]])
        leftmost = leftmost[_sorted_numbers(names)]
    return np.array(_induce_numbers(values, kinds, leftmost.tolist(), size))


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a byte array in lexicographic order."""
    if len(text) < 2:
        return np.arange(len(text))
    types = _smaller_types(text)
    leftmost = _leftmost(types)
    if len(leftmost) > 1:
        first = _induce(text, types, leftmost)
        marked = np.zeros(len(text), dtype=bool)
        marked[leftmost] = True
        names = _named(text, leftmost, first[marked[first]])
        leftmost = leftmost[_sorted_numbers(names)]
    return _induce(text, types, leftmost)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each position, how much its suffix shares with the one before it in ``order``.

    In text order; values stop at ``most``.  Eight bytes are compared at a time, for the
    positions that agree so far.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(most + 8, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    shared = np.zeros(n, dtype=np.int64)
    room = n - np.maximum(np.arange(n), before)
    alive = np.flatnonzero(before >= 0)
    eights = np.frombuffer(np.ascontiguousarray(words[: n + most]).tobytes(), dtype="<u8")
    for at in range(0, most, 8):
        a, b = eights[alive + at], eights[before[alive] + at]
        differ = a ^ b
        equal = differ == 0
        low = differ[~equal]
        shared[alive[~equal]] = at + (np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64) >> 3)
        alive = alive[equal]
        shared[alive] = at + 8
    return np.minimum(np.minimum(shared, room), most) * (before >= 0)
