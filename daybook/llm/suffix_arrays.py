"""Suffix arrays by induced sorting, and permuted common prefixes, on whole numpy arrays.

The steps of induced sorting are linear, and each of them looks at a bucket (all suffixes
with the same first symbol) as one array: what a bucket induces is appended, in order, to
the buckets of the preceding symbols.
"""

from __future__ import annotations

import numpy as np

from daybook.llm.text_arrays import RUN_BASES, RunHashes, mixed

#: Reduced strings of more different symbols are ranked by doubling, not bucket by bucket.
MOST_BUCKETS = 2048


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the end is smaller than all)."""
    n = len(text)
    if n == 1:
        return np.zeros(1, bool)
    differs = np.flatnonzero(text[:-1] != text[1:])
    rises = text[:-1][differs] < text[1:][differs]
    upcoming = np.searchsorted(differs, np.arange(n))  # next place where neighbours differ
    return np.append(rises, False)[upcoming]


class _Buckets:
    """Suffixes waiting in the bucket of their first symbol, in order."""

    def __init__(self, count: int):
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(count)]

    def add(self, suffixes: np.ndarray, symbols: np.ndarray):
        if not len(suffixes):
            return
        order = np.argsort(symbols, kind="stable")
        suffixes, symbols = suffixes[order], symbols[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        starts = [0, *cuts.tolist(), len(symbols)]
        for a, b in zip(starts[:-1], starts[1:]):
            self.waiting[symbols[a]].append(suffixes[a:b])

    def take(self, symbol: int) -> np.ndarray:
        parts, self.waiting[symbol] = self.waiting[symbol], []
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, count: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones given in order."""
    seeds, larger = _Buckets(count), _Buckets(count)
    seeds.add(leftmost, text[leftmost])
    last = np.array([len(text) - 1])
    larger.add(last, text[last])  # the end comes before all and induces the last suffix
    larger_of = []
    for symbol in range(count):
        found = []
        current = larger.take(symbol)
        while len(current):
            found.append(current)
            before = current[current > 0] - 1
            before = before[~smaller[before]]
            heads = text[before]
            same = heads == symbol
            larger.add(before[~same], heads[~same])
            current = before[same]
        larger_of.append(np.concatenate(found) if found else current)
        before = seeds.take(symbol) - 1
        larger.add(before, text[before])
    smaller_ones = _Buckets(count)
    ordered: list[np.ndarray] = []
    for symbol in range(count - 1, -1, -1):
        found = []
        current = smaller_ones.take(symbol)
        while len(current):
            found.append(current)
            before = current[current > 0] - 1
            before = before[smaller[before]]
            heads = text[before]
            same = heads == symbol
            smaller_ones.add(before[~same], heads[~same])
            current = before[same]
        backwards = larger_of[symbol][::-1]
        before = backwards[backwards > 0] - 1
        before = before[smaller[before]]
        smaller_ones.add(before, text[before])
        ordered.extend(found)
        ordered.append(backwards)
    return np.concatenate(ordered)[::-1]


def _doubling(text: np.ndarray) -> np.ndarray:
    """Suffixes ranked by their first 1, 2, 4, ... symbols until all ranks differ."""
    n = len(text)
    rank = text.astype(np.int64) + 1
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:]
        pair = rank * (int(rank.max()) + 1) + after
        order = np.argsort(pair, kind="stable")
        changes = np.concatenate([[1], (pair[order][1:] != pair[order][:-1]).astype(np.int64)])
        rank[order] = np.cumsum(changes)
        if rank.max() == n:
            return order
        step *= 2


def suffix_array(text: np.ndarray, count: int) -> np.ndarray:
    """The starts of all suffixes in order; symbols are 0 .. count - 1."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    if count > MOST_BUCKETS:
        return _doubling(text)
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) < 2:
        return _induce(text, smaller, leftmost, count)
    by_substring = _induce(text, smaller, leftmost, count)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ordered = by_substring[is_leftmost[by_substring]]
    # a substring reaches to the start of the next one, inclusive, the last one past the end
    ends = np.append(leftmost[1:] + 1, n)
    hashes = RunHashes(mixed(text.astype(np.uint64) + np.uint64(1)), RUN_BASES[0]).of(leftmost, ends)
    hashes[-1] ^= np.uint64(1)
    number = np.empty(n, np.int64)
    number[leftmost] = np.arange(len(leftmost))
    places = number[ordered]
    new = np.concatenate([[0], (hashes[places][1:] != hashes[places][:-1]).astype(np.int64)])
    names = np.cumsum(new)
    if names[-1] + 1 < len(leftmost):
        reduced = np.empty(len(leftmost), np.int64)
        reduced[places] = names
        ordered = leftmost[suffix_array(reduced, int(names[-1]) + 1)]
    return _induce(text, smaller, ordered, count)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight symbols (below 2**16) from each place on, as two integers per place."""
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    n = len(text)
    pair = padded[: n + 6] | (padded[1 : n + 7] << np.uint64(16))
    return pair[: n + 4] | (pair[2 : n + 6] << np.uint64(32))


def common_prefixes(
    text: np.ndarray, order: np.ndarray, limits: np.ndarray, most: int, step: int = 16
) -> tuple[np.ndarray, np.ndarray]:
    """For each place the suffix before it in order (-1: none), and their common prefix.

    Prefixes end at each place's limit and at ``most``. In order of places a prefix is at most one
    shorter than the one before; so every ``step``-th is computed first and the others start from
    what those leave.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = _words(text)
    length = np.zeros(n, np.int64)

    def extend(places, start):
        partner = before[places]
        places, start, partner = (x[partner >= 0] for x in (places, start, partner))
        bound = np.minimum(np.minimum(limits[places], limits[partner]), most)
        length[places] = start
        for width in (4, 1):
            active = np.flatnonzero(length[places] + width <= bound)
            while len(active):
                here = length[places[active]]
                a, b = places[active] + here, partner[active] + here
                same = words[a] == words[b] if width == 4 else text[a] == text[b]
                active = active[same]
                length[places[active]] += width
                active = active[length[places[active]] + width <= bound[active]]

    sampled = np.arange(0, n, step)
    extend(sampled, np.zeros(len(sampled), np.int64))
    others = np.flatnonzero(np.arange(n) % step)
    base = others - others % step
    extend(others, np.maximum(length[base] - (others - base), 0))
    return before, length
