"""Suffix arrays over the words of a shard of texts, and vectorised binary search in them."""

from __future__ import annotations

import numpy as np

from gaugemill.llm.words import Words

END = np.uint64(0)  # stands after each text; no word of a query equals it


class SuffixArray:
    """All suffixes of some texts, ordered by at least their first ``depth`` words.

    Words are ordered by hash. ``text`` and ``at`` give the text of a position and its place
    there.
    """

    def __init__(self, words: Words, depth: int) -> None:
        texts = len(words.first) - 1
        self.first = words.first[:-1] + np.arange(texts)  # a separator after each text
        self.counts = words.counts
        self.words = np.zeros(len(words.hashes) + texts, np.uint64)
        self.words[np.arange(len(words.hashes)) + words.text_of()] = words.hashes
        self.order = _ordered(self.words, depth)

    def text(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, positions, "right") - 1

    def at(self, positions: np.ndarray) -> np.ndarray:
        return positions - self.first[self.text(positions)]

    def find(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the range of the order whose suffixes begin with it.

        ``queries`` is a row of word hashes each, of which the first ``sizes`` count.
        """
        low = self._bound(queries, sizes, after=False)
        return low, self._bound(queries, sizes, after=True)

    def longest(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, the length of its longest prefix in the texts, and a position.

        It is shared with a neighbour of the place where the query would stand. The array
        must be as deep as the queries are long.
        """
        best, where = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        if len(self.order) == 0:
            return best, where
        place = self._bound(queries, sizes, after=False)
        for neighbour in (place - 1, place):
            known = (neighbour >= 0) & (neighbour < len(self.order))
            position = self.order[np.clip(neighbour, 0, len(self.order) - 1)]
            length = np.where(known, self._common(queries, sizes, position), 0)
            where = np.where(length > best, position, where)
            best = np.maximum(best, length)
        return best, where

    def _common(self, queries, sizes, positions) -> np.ndarray:
        length, same = np.zeros(len(queries), np.int64), sizes > 0
        for step in range(queries.shape[1]):
            at = np.minimum(positions + step, len(self.words) - 1)
            same = same & (step < sizes) & (positions + step < len(self.words))
            same &= self.words[at] == queries[:, step]
            if not same.any():
                break
            length += same
        return length

    def _bound(self, queries, sizes, after: bool) -> np.ndarray:
        """Binary search for all queries together, a step at a time."""
        low = np.zeros(len(queries), np.int64)
        high = np.full(len(queries), len(self.order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            up = self._before(self.order[middle], queries[open_], sizes[open_], after)
            low[open_[up]] = middle[up] + 1
            high[open_[~up]] = middle[~up]
        return low

    def _before(self, positions, queries, sizes, on_tie: bool) -> np.ndarray:
        """Whether each suffix stands before its query; ``on_tie`` if it begins with it."""
        result = np.full(len(queries), on_tie)
        rest = np.arange(len(queries))
        for step in range(queries.shape[1]):
            rest = rest[sizes[rest] > step]
            if not rest.size:
                break
            at = positions[rest] + step
            word = np.where(
                at < len(self.words), self.words[np.minimum(at, len(self.words) - 1)], END
            )
            asked = queries[rest, step]
            differs = word != asked
            result[rest[differs]] = word[differs] < asked[differs]
            rest = rest[~differs]
        return result


def _ordered(words: np.ndarray, depth: int) -> np.ndarray:
    """Prefix doubling; each round sorts only suffixes that are still tied."""
    size = len(words)
    order = np.argsort(words)
    ranks, tied = _ranked(order, words[order], np.arange(size), np.zeros(size, np.int64))
    reach = 1
    while reach < depth and tied.size:
        suffixes = order[tied]
        follows = suffixes + reach
        next_rank = np.where(follows < size, ranks[np.minimum(follows, size - 1)] + 1, 0)
        keys = (ranks[suffixes] << 32) | next_rank  # a shard has less than 2**31 words
        inner = np.argsort(keys)
        order[tied] = suffixes[inner]
        ranks, tied = _ranked(suffixes[inner], keys[inner], tied, ranks)
        reach *= 2
    return order


def _ranked(suffixes, keys, slots, ranks) -> tuple[np.ndarray, np.ndarray]:
    """Give suffixes of equal keys the slot of the first of them; which slots are tied."""
    starts = np.ones(len(keys), bool)
    starts[1:] = keys[1:] != keys[:-1]
    group = np.cumsum(starts) - 1
    ranks[suffixes] = slots[starts][group]
    return ranks, slots[np.bincount(group, minlength=1)[group] > 1]
