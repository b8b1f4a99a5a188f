"""FM-index over a shard of word sequences, with a wavelet matrix for rank queries.

The suffix order is exact to ``depth`` words (all that windows of that length can tell apart). Each
rank of the order also knows its class: the suffixes that agree in their first ``depth`` words. A
backward search narrows an interval of ranks by one word at a time; once it matches ``depth``
words it is widened to its class, which drops the last word, so the search slides over a streamed
document and gives every truncated matching statistic with its interval.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class WaveletMatrix:
    """Rank of any symbol before any place, in one step a bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros: list[int] = []
        self.ones: list[np.ndarray] = []
        s = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (s >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate((s[bit == 0], s[bit == 1]))

    def rank(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = ((symbols >> (self.bits - 1 - k)) & 1).astype(bool)
            s1, l1, h1 = ones[start], ones[low], ones[high]
            start = np.where(one, zeros + s1, start - s1)
            low = np.where(one, zeros + l1, low - l1)
            high = np.where(one, zeros + h1, high - h1)
        return low - start, high - start


def prefix_classes(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank class of every suffix by its first ``depth`` symbols (padded with -1 at the end)."""
    n = len(text)

    def ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return np.unique(first * np.int64(n + 2) + second + 1, return_inverse=True)[1].astype(np.int64)

    def shifted(c: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((c[by:], np.full(min(by, n), -1, np.int64)))[:n]

    c, length = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while length * 2 <= depth:
        c, length = ranked(c, shifted(c, length)), length * 2
    if length < depth:
        c = ranked(c, shifted(c, depth - length))
    return c


# Places of queries, with the padding to one length, that are streamed side by side.
SEARCH_CELLS = 1_000_000


def alike(sizes: list[int], cells: int) -> Iterator[list[int]]:
    """Numbers of the queries in groups of like size, each at most ``cells`` when padded (or one query)."""
    group: list[int] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if group and (len(group) + 1) * sizes[k] > cells:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


class FMIndex:
    """Index of documents given as arrays of symbols >= 1; 0 separates them."""

    def __init__(self, documents: list[np.ndarray], depth: int, sigma: int):
        self.depth = depth
        zero = np.zeros(1, np.int64)
        self.text = np.concatenate([x for d in documents for x in (d, zero)]) if documents else zero
        n = len(self.text)
        self.owner = np.repeat(np.arange(len(documents)), [len(d) + 1 for d in documents]) if documents else zero
        classes = prefix_classes(self.text, depth)
        order = np.argsort(classes, kind="stable")
        by_rank = classes[order]
        self.class_start = np.flatnonzero(np.concatenate(([True], by_rank[1:] != by_rank[:-1])))
        self.class_end = np.append(self.class_start[1:], n)
        self.class_of = by_rank  # classes are numbered in rank order
        self.order = order
        last = self.text[order - 1]  # the text as a ring: the word before each suffix
        self.before = np.concatenate(([0], np.cumsum(np.bincount(last, minlength=sigma))))
        self.wavelet = WaveletMatrix(last, sigma)

    def class_minimum(self, value_of_document: np.ndarray) -> np.ndarray:
        """Smallest value of the documents that each class of suffixes occurs in."""
        return np.minimum.reduceat(value_of_document[self.owner[self.order]], self.class_start)

    def matching_statistics(self, queries: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query and place: matched length, at most ``depth``, and the class where it is full (else -1).

        Queries of like size are streamed side by side, from right to left, so that one long query does not
        widen them all. A query's words must occur in the index together, as those of indexed documents do;
        where they do not, the match is cut to nothing and begins anew.
        """
        found: list = [None] * len(queries)
        for group in alike([len(q) for q in queries], SEARCH_CELLS):
            for k, one in zip(group, self._streamed([queries[k] for k in group])):
                found[k] = one
        return found

    def _streamed(self, queries: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        longest = max(map(len, queries), default=0)
        padded = np.zeros((len(queries), longest), np.int64)
        for k, q in enumerate(queries):
            padded[k, longest - len(q):] = q[::1]
        size = np.array([len(q) for q in queries])
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(self.text))
        length = np.zeros(len(queries), np.int64)
        lengths, classes = np.zeros(padded.shape, np.int32), np.full(padded.shape, -1, np.int64)
        for step in range(longest):
            at = longest - 1 - step
            live = np.flatnonzero(size > step)
            c = padded[live, at]
            below, above = self.wavelet.rank(c, low[live], high[live])
            lo, hi = self.before[c] + below, self.before[c] + above
            lost = lo >= hi
            n = np.where(lost, 0, length[live] + 1)
            lo, hi = np.where(lost, 0, lo), np.where(lost, len(self.text), hi)
            full = n >= self.depth
            k = self.class_of[lo]
            lo, hi = np.where(full, self.class_start[k], lo), np.where(full, self.class_end[k], hi)
            n = np.minimum(n, self.depth)
            low[live], high[live], length[live] = lo, hi, n
            lengths[live, at] = n
            classes[live, at] = np.where(full, k, -1)
        return [(lengths[k, longest - s:].copy(), classes[k, longest - s:].copy()) for k, s in enumerate(size)]
