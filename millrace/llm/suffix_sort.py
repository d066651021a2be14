"""Suffix arrays by induced sorting, and common prefixes in text order, for one shard of text.

A suffix is smaller (S) or larger (L) than the one after it; an S suffix after an L one is
*leftmost smaller*. The substrings from one leftmost-smaller place to the next are sorted by
induction and named by rank; the string of names is sorted the same way, recursively, unless all
names differ. From the order of the leftmost-smaller suffixes, one pass up induces that of the L
suffixes and one pass down that of the S suffixes, each in linear time.

Over bytes a pass goes bucket by bucket, and all suffixes known in a bucket are worked on at once;
strings of names have as many symbols as places, and are passed over one by one.
"""

from __future__ import annotations

import numpy as np

SMALL = 512  # largest alphabet for whole-bucket passes


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Order of the suffixes of ``text`` (whole numbers below ``symbols``)."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = _types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_buckets if symbols <= SMALL else _induce_places
    sizes = np.bincount(text, minlength=symbols)
    if len(leftmost) > 1:
        order = induce(text, smaller, leftmost, sizes)
        is_leftmost = np.zeros(n, bool)
        is_leftmost[leftmost] = True
        order = order[is_leftmost[order]]
        names = _names(text, leftmost, order)
        place = np.empty(n, np.int64)
        place[order] = names
        reduced = place[leftmost]
        if names[-1] + 1 < len(leftmost):
            order = leftmost[suffix_array(reduced, int(names[-1]) + 1)]
        leftmost = order
    return induce(text, smaller, leftmost, sizes)


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one is larger than what follows."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = np.searchsorted(differs, np.arange(n))
    out = np.zeros(n, bool)
    known = following < len(differs)
    at = differs[following[known]]
    out[known] = text[at] < text[at + 1]
    return out


def _names(text: np.ndarray, leftmost: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the sorted substrings; equal ones share a rank. A substring ends with the next
    leftmost-smaller place; the last one ends with the text and equals no other."""
    length = np.empty(len(text), np.int64)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    length[leftmost[-1]] = len(text) - leftmost[-1] + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    same &= (a != leftmost[-1]) & (b != leftmost[-1])
    rows, k = np.flatnonzero(same), 0
    while len(rows):
        unequal = text[a[rows] + k] != text[b[rows] + k]
        same[rows[unequal]] = False
        k += 1
        rows = rows[~unequal]
        rows = rows[length[a[rows]] > k]
    return np.concatenate([[0], np.cumsum(~same)])


def _induce_buckets(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, symbols = len(text), len(sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.full(n, -1, np.int64)
    # The sorted leftmost-smaller suffixes go to the ends of their buckets, in their order.
    of = text[leftmost]
    by_bucket = np.argsort(of, kind="stable")
    seeds = leftmost[by_bucket]
    seed_ends = np.cumsum(np.bincount(of, minlength=symbols))
    seed_starts = seed_ends - np.bincount(of, minlength=symbols)
    head = starts.copy()

    def put(found: np.ndarray) -> None:
        c = text[found]
        by = np.argsort(c, kind="stable")
        c, found = c[by], found[by]
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        count = np.diff(np.append(first, len(c)))
        rank = np.arange(len(c)) - np.repeat(first, count)
        out[head[c] + rank] = found
        head[c[first]] += count

    larger = ~smaller

    def larger_before(of: np.ndarray) -> np.ndarray:
        before = of[of > 0] - 1
        return before[larger[before]]

    last = np.array([n - 1])  # as if an end mark, smaller than all, stood after the text
    if not smaller[n - 1]:
        put(last)
    for c in range(symbols):
        done = starts[c]
        while done < head[c]:
            wave = out[done : head[c]].copy()
            done = head[c]
            found = larger_before(wave)
            if len(found):
                put(found)
        wave = seeds[seed_starts[c] : seed_ends[c]]
        if len(wave):
            found = larger_before(wave)
            if len(found):
                put(found)
    tail = ends.copy()

    def put_back(found: np.ndarray) -> None:
        c = text[found]
        by = np.argsort(c, kind="stable")
        c, found = c[by], found[by]
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        count = np.diff(np.append(first, len(c)))
        rank = np.arange(len(c)) - np.repeat(first, count)
        out[tail[c] - 1 - rank] = found
        tail[c[first]] -= count

    def smaller_before(of: np.ndarray) -> np.ndarray:
        before = of[of > 0] - 1
        return before[smaller[before]]

    for c in range(symbols - 1, -1, -1):
        done = ends[c]
        while done > tail[c]:
            wave = out[tail[c] : done][::-1].copy()
            done = tail[c]
            found = smaller_before(wave)
            if len(found):
                put_back(found)
        wave = out[starts[c] : head[c]][::-1]
        if len(wave):
            found = smaller_before(wave)
            if len(found):
                put_back(found)
    return out


def _induce_places(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, text = len(text), text.astype(np.int64)
    ends = np.cumsum(sizes)
    # For each place the symbol before it if that suffix is to be induced, else -1; so for an
    # empty slot, which is -1 and reads the last entry.
    up, down = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    up[1:n] = np.where(smaller[: n - 1], -1, text[: n - 1])
    down[1:n] = np.where(smaller[: n - 1], text[: n - 1], -1)
    by = np.argsort(text[leftmost], kind="stable")
    seeds, of = leftmost[by], text[leftmost][by]
    of_ends = np.searchsorted(of, of, side="right")
    out = np.full(n, -1, np.int64)
    out[ends[of] - (of_ends - np.arange(len(of)))] = seeds
    out = out.tolist()
    head, before = (ends - sizes).tolist(), up.tolist()
    if not smaller[n - 1]:
        last = int(text[n - 1])
        out[head[last]] = n - 1
        head[last] += 1
    for i in out:  # the list is read while it is filled ahead of the reader
        c = before[i]
        if c >= 0:
            at = head[c]
            out[at] = i - 1
            head[c] = at + 1
    tail, before = ends.tolist(), down.tolist()
    for i in reversed(out):
        c = before[i]
        if c >= 0:
            at = tail[c] - 1
            out[at] = i - 1
            tail[c] = at
    return np.array(out, np.int64)


def permuted_common_prefix(text: bytes, order: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place in text order: the common prefix of its suffix with the one before it in the
    suffix array, up to ``most``, and that suffix (-1 for the first). Eight bytes are compared at
    a time, for all places that still agree."""
    n = len(order)
    data = np.frombuffer(text + bytes(most + 16), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    lengths = np.zeros(n, np.int64)
    rows = np.flatnonzero(before >= 0)
    done = 0
    while len(rows) and done < most:
        a = words[rows + done].copy().view("<u8").ravel()
        b = words[before[rows] + done].copy().view("<u8").ravel()
        apart = a ^ b
        low = apart & (~apart + np.uint64(1))
        bit = np.bitwise_count(low - np.uint64(1))  # 64 where nothing differs
        lengths[rows] = done + (bit // 8).astype(np.int64)
        rows = rows[apart == 0]
        done += 8
    limit = n - np.arange(n)
    both = np.where(before >= 0, np.minimum(limit, n - before), limit)
    return np.minimum(np.minimum(lengths, most), both), before
