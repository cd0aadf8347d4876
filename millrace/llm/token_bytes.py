"""Vocabularies as flat tables of bytes, and the gathering of many slices at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Output items that one step of ``gather`` makes, which bounds its index arrays.
STEP = 1 << 20


def gather(flat: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[at[i]:at[i] + sizes[i]]`` for every i, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    out = np.empty(total, dtype=flat.dtype)
    low, done = 0, 0
    while done < total:
        # At least one slice a step; a slice of any length is taken whole.
        high = max(low + 1, int(np.searchsorted(ends, done + STEP, side="right")))
        size = sizes[low:high]
        shift = at[low:high] - (ends[low:high] - size - done)
        upto = int(ends[high - 1])
        out[done:upto] = flat[np.repeat(shift, size) + np.arange(upto - done)]
        low, done = high, upto
    return out


class TokenBytes:
    """The bytes of every id of a vocabulary."""

    def __init__(self, tokens: Sequence[bytes]) -> None:
        self.size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self._at = np.cumsum(self.size) - self.size
        self._flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def __len__(self) -> int:
        return len(self.size)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        return gather(self._flat, self._at[ids], self.size[ids])
