"""Pair merging of many short words side by side."""

from __future__ import annotations

import heapq

import numpy as np

from millrace.llm.token_bytes import gather

#: Words of up to so many symbols are merged side by side, in groups by length; longer ones one by one.
WIDTHS = (4, 8, 12, 16, 24, 40)
NONE = np.iinfo(np.int32).max
#: Ids that have a table of their pairs.
SMALL = 512


class PairMerger:
    """Merges the pair of least rank in each word, the leftmost first, until none has a rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        """Pairs of ids with their rank; pairs of one rank must merge to the same id."""
        self._base = int(max(left.max(), right.max(), merged.max())) + 1
        key = left.astype(np.int64) * self._base + right
        # Of a pair that is given twice the last rank counts.
        order = np.lexsort((np.arange(len(key)), key))
        order = order[np.append(key[order][1:] != key[order][:-1], True)]
        self._key, self._rank = key[order], rank[order].astype(np.int32)
        self._to = np.zeros(int(rank.max()) + 1, dtype=np.int32)
        self._to[rank] = merged
        #: The same for long words, made when one comes.
        self._ranks: dict[int, int] | None = None
        few = np.arange(SMALL)
        self._small = self.ranks(np.repeat(few, SMALL), np.tile(few, SMALL))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self._base + right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], NONE)

    def _first_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """As ``ranks``, with a table for the pairs of small ids, which symbols mostly are."""
        if left.size and max(left.max(), right.max()) < SMALL:
            return self._small[left * SMALL + right]
        return self.ranks(left, right)

    def _side_by_side(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of a matrix merged; only the first ``size`` columns of a row count."""
        width = words.shape[1]
        column = np.arange(width, dtype=np.int32)
        ranks = np.full((len(words), width), NONE, dtype=np.int32)
        ranks[:, :-1] = np.where(column[None, 1:] < size[:, None], self._first_ranks(words[:, :-1], words[:, 1:]), NONE)
        out, out_size, rows = words, size, np.arange(len(words))
        while len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            done = least == NONE
            if done.any():
                out[rows[done]], out_size[rows[done]] = words[done], size[done]
                more = ~done
                rows, words, ranks, size, at, least = rows[more], words[more], ranks[more], size[more], at[more], least[more]
                if not len(rows):
                    break
            here = np.arange(len(rows))
            # All that stands behind the pair moves up by one.
            behind = column[None, :] > at[:, None]
            words = np.where(behind, np.roll(words, -1, axis=1), words)
            ranks = np.where(behind, np.roll(ranks, -1, axis=1), ranks)
            # No pair begins in the last column.
            ranks[:, -1] = NONE
            words[here, at] = self._to[least]
            size = size - 1
            left, right = np.flatnonzero(at > 0), at + 1 < size
            ranks[here, at] = NONE
            ranks[left, at[left] - 1] = self.ranks(words[left, at[left] - 1], words[left, at[left]])
            ranks[here[right], at[right]] = self.ranks(words[here[right], at[right]], words[here[right], at[right] + 1])
        return out, out_size

    def _one(self, word: list[int]) -> list[int]:
        """A word of any length, by a heap: O(n log n)."""
        n = len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        if self._ranks is None:
            self._ranks = dict(zip(self._key.tolist(), self._rank.tolist(), strict=True))

        def offer(i: int) -> None:
            x, y = word[i], word[after[i]]
            if (r := self._ranks.get(x * self._base + y)) is not None:
                heapq.heappush(heap, (r, i, x, y))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            # Stale if either symbol has been merged since.
            if j < 0 or j >= n or word[i] != x or word[j] != y:
                continue
            word[i], after[i], after[j] = int(self._to[r]), after[j], -1
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(word[i])
            i = after[i]
        return out

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of words that come as ids of their symbols, one word after the other."""
        at = np.cumsum(sizes) - sizes
        parts: list[np.ndarray] = [symbols[:0]]
        out_size, out_at, used, low = sizes.copy(), np.zeros_like(sizes), 0, 1
        for width in WIDTHS:
            own = np.flatnonzero((sizes >= low) & (sizes <= width))
            low = width + 1
            if not len(own):
                continue
            inside = np.arange(width)[None, :] < sizes[own][:, None]
            matrix = np.zeros((len(own), width), dtype=np.int32)
            matrix[inside] = gather(symbols, at[own], sizes[own])
            matrix, size = self._side_by_side(matrix, sizes[own].copy())
            flat = matrix[np.arange(width)[None, :] < size[:, None]]
            out_size[own], out_at[own] = size, used + np.cumsum(size) - size
            parts.append(flat)
            used += len(flat)
        for i in np.flatnonzero(sizes >= low).tolist():
            ids = np.array(self._one(symbols[at[i]:at[i] + sizes[i]].tolist()), dtype=np.int32)
            out_size[i], out_at[i] = len(ids), used
            parts.append(ids)
            used += len(ids)
        return out_size, gather(np.concatenate(parts), out_at, out_size)
