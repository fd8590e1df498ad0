"""Suffix arrays by induced sorting and permuted common prefixes, in numpy.

Induction goes bucket by bucket: the suffixes already placed in a bucket induce all their
predecessors at once, so the work is linear and each step handles many suffixes.
"""

from __future__ import annotations

import numpy as np

_SMALL_ALPHABET = 1 << 13


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (the last symbol is the sentinel)."""
    n = len(text)
    out = np.ones(n, bool)
    differs = np.flatnonzero(text[:-1] != text[1:])
    if len(differs):
        upto = np.diff(differs, prepend=-1)
        out[: differs[-1] + 1] = np.repeat(text[differs] < text[differs + 1], upto)
    return out


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """Places all suffixes from the leftmost-smaller ones given in order of their buckets."""
    n = len(text)
    code = (text.astype(np.uint16) << 1) | smaller
    sizes = np.bincount(text, minlength=symbols)
    head = np.cumsum(sizes) - sizes
    tail = head + sizes
    larger = np.bincount(text[~smaller], minlength=symbols)
    order = np.full(n, -1, np.int32)
    seed_count = np.bincount(text[seeds], minlength=symbols)
    seed_stop = np.cumsum(seed_count)
    put = head.copy()

    def place(batch: np.ndarray, kind: int) -> None:
        before = batch[batch > 0] - 1
        found = code[before]
        keep = (found & 1) == kind
        before, symbol = before[keep], found[keep] >> 1
        if not len(before):
            return
        by = np.argsort(symbol, kind="stable")
        before, symbol = before[by], symbol[by]
        cut = np.flatnonzero(np.diff(symbol, prepend=symbols))
        which, count = symbol[cut], np.diff(np.append(cut, len(symbol)))
        if kind == 0:
            base = put[which] - cut
            order[np.repeat(base, count) + np.arange(len(symbol))] = before
            put[which] += count
        else:
            base = put[which] - 1 + cut
            order[np.repeat(base, count) - np.arange(len(symbol))] = before
            put[which] -= count

    present = np.flatnonzero(sizes)
    for c in present:
        at = head[c]
        while at < put[c]:
            stop = put[c]
            place(order[at:stop], 0)
            at = stop
        if seed_count[c]:
            place(seeds[seed_stop[c] - seed_count[c] : seed_stop[c]], 0)
    put = tail.copy()
    order[0] = n - 1
    put[0] = 0  # the sentinel's bucket is itself
    for c in present[::-1]:
        at = tail[c]
        if c == 0:
            place(order[:1], 1)
            continue
        while at > put[c]:
            start = put[c]
            place(order[start:at][::-1], 1)
            at = start
        if larger[c]:
            place(order[head[c] : head[c] + larger[c]][::-1], 1)
    return order


def _named(text: np.ndarray, smaller: np.ndarray, found: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranks of the sorted leftmost-smaller substrings `found`; equal ones share a rank."""
    n = len(text)
    code = (text.astype(np.uint16) << 1) | smaller
    length = np.zeros(n, np.int32)
    length[places[:-1]] = np.diff(places) + 1
    length[places[-1]] = 1
    a, b = found[:-1], found[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        equal = code[a[left] + k] == code[b[left] + k]
        same[left[~equal]] = False
        left = left[equal]
        k += 1
        left = left[length[a[left]] > k]
    return np.concatenate([[0], np.cumsum(~same)])


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string over a large alphabet, by refining groups of ranks."""
    m = len(names)
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    fresh = np.flatnonzero(np.diff(ranked, prepend=-1))
    group = np.repeat(fresh, np.diff(np.append(fresh, m)))
    rank = np.empty(m + 1, np.int64)
    rank[order] = group
    rank[m] = -1
    sizes = np.bincount(rank[:m], minlength=m)
    left = np.flatnonzero(sizes[rank[:m]] > 1)
    step = 1
    while len(left):
        key = rank[left] * (m + 2) + rank[np.minimum(left + step, m)] + 1
        by = np.argsort(key, kind="stable")
        key, left = key[by], left[by]
        old = rank[left]
        new_start = np.flatnonzero(np.diff(key, prepend=-1))
        old_start = np.flatnonzero(np.diff(old, prepend=-1))
        here = np.arange(len(left))
        inside = here[new_start] - old_start[np.searchsorted(old_start, new_start, "right") - 1]
        count = np.diff(np.append(new_start, len(left)))
        rank[left] = old + np.repeat(inside, count)
        left = left[np.repeat(count > 1, count)]
        step *= 2
    out = np.empty(m, np.int64)
    out[rank[:m]] = np.arange(m)
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Symbols are below 32768; the last one, 0, occurs only there."""
    n = len(text)
    if n <= 2:
        return np.arange(n, dtype=np.int32)[::-1]
    symbols = int(text.max()) + 1
    smaller = _smaller_than_next(text)
    places = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if len(places) <= 1:
        return _induce(text, smaller, places, symbols)
    by_symbol = places[np.argsort(text[places], kind="stable")]
    rough = _induce(text, smaller, by_symbol, symbols)
    is_place = np.zeros(n, bool)
    is_place[places] = True
    found = rough[is_place[rough]]
    ranks = _named(text, smaller, found, places)
    if ranks[-1] + 1 < len(found):
        number = np.zeros(n, np.int64)
        number[found] = ranks
        reduced = number[places]
        if ranks[-1] < _SMALL_ALPHABET:
            found = places[suffix_array(reduced.astype(np.uint16))]
        else:
            found = places[_by_doubling(reduced)]
    return _induce(text, smaller, found, symbols)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position, the suffix before it in order (-1: none) and their common prefix.

    Only positions whose left neighbours differ are compared; elsewhere the prefix is one shorter
    than at the position before.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    prior = before.copy()
    compare = np.ones(n, bool)
    inner = np.flatnonzero(before[1:] > 0) + 1
    compare[inner] = text[inner - 1] != text[before[inner] - 1]
    common = np.zeros(n, np.int32)
    padded = np.concatenate([text.astype(np.uint16), np.zeros(4, np.uint16)])
    fours = np.ndarray((n + 1,), "<u8", padded.data, strides=(2,))
    a = np.flatnonzero(compare & (prior >= 0))
    b = prior[a]
    length = np.zeros(len(a), np.int32)
    left = np.arange(len(a))
    while len(left):
        x, y = a[left] + length[left], b[left] + length[left]
        differing = fours[x] ^ fours[y]
        equal = differing == 0
        done = left[~equal]
        bits = differing[~equal]
        low = bits & (~bits + np.uint64(1))
        length[done] += (
            (low >= np.uint64(1 << 16)).astype(np.int32) + (low >= np.uint64(1 << 32)) + (low >= np.uint64(1 << 48))
        )
        left = left[equal]
        length[left] += 4
    common[a] = length
    source = np.where(compare, np.arange(n), 0)
    np.maximum.accumulate(source, out=source)
    return before, np.maximum(common[source] - (np.arange(n) - source), 0).astype(np.int32)
