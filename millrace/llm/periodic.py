"""Periodic runs of words, found as maximal pairs in the tree of LCP intervals."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has at least this many words, and as many periods.
LEAST, PERIODS = 6, 4
#: The two parts of a maximal pair of a run with period q have max(LEAST, PERIODS * q) - q words each, this many at least.
SHORTEST = min(max(LEAST, PERIODS * q) - q for q in range(1, LEAST + 1))


def _repeated(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places whose next ``SHORTEST`` words occur again in their document, by a hash (a few more by chance)."""
    n = len(words) - SHORTEST + 1
    if n <= 0:
        return np.zeros(len(words), dtype=bool)
    value = doc[:n].astype(np.uint64) + np.uint64(1)
    for i in range(SHORTEST):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[i:n + i].astype(np.uint64)
    whole = np.arange(n) + SHORTEST <= ends[doc[:n]]
    ordered = np.sort(value[whole])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(len(words), dtype=bool)
    if len(twice):
        near = np.minimum(np.searchsorted(twice, value), len(twice) - 1)
        out[:n] = whole & (twice[near] == value)
    return out


def _rank_levels(words: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of every suffix, until no two are equal.

    Suffixes end with their document and never equal one of another.  A rank is the place
    of the first of its equals in sorted order, so ranks that stand alone stay as they are
    and each level sorts the others only.  A last item stands for the place after the end.
    """
    n = len(words)
    order = np.lexsort((words, doc))
    same = np.zeros(n, dtype=bool)
    same[1:] = (words[order[1:]] == words[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    levels, step = [rank], 1
    shared = same.copy()
    shared[:-1] |= same[1:]
    active = order[shared]
    while len(active):
        then = active + step
        second = np.where(then < ends[doc[active]], rank[np.minimum(then, n)], -1)
        first = rank[active]
        order = np.lexsort((second, first))
        active, first, second = active[order], first[order], second[order]
        place = np.arange(len(active))
        old = np.ones(len(active), dtype=bool)
        old[1:] = first[1:] != first[:-1]
        new = old.copy()
        new[1:] |= second[1:] != second[:-1]
        group, part = np.maximum.accumulate(np.where(old, place, 0)), np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[active] = first + part - group
        levels.append(rank)
        shared = ~new
        shared[:-1] |= ~new[1:]
        active, step = active[shared], 2 * step
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of words that the suffixes at ``a`` and ``b`` have in common."""
    n, length = len(levels[0]) - 1, np.zeros(len(a), dtype=np.int64)
    for i in range(len(levels) - 1, -1, -1):
        x, y = np.minimum(a + length, n), np.minimum(b + length, n)
        length += np.where((levels[i][x] == levels[i][y]) & (x < n) & (y < n), 1 << i, 0)
    return length


def _pairs(order: Sequence[int], common: Sequence[int], left: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the maximal pairs that are runs.

    ``order`` are places in the order of their suffixes, ``common[i]`` the words that the
    i-th and the next have in common, ``left`` the class of the word before a place.  The
    intervals of the tree are closed bottom-up by a stack.  A closed one merges the list
    of its smaller part into that of the larger: two places of different parts have just
    the interval's words in common, so they are a maximal pair if their left words are of
    different classes.  It is a run if the words are enough for the distance.

    A list has the places in order, each with its class.  Of a place only the neighbours
    in the other list are looked at: places further off are at a multiple of a shorter
    distance or too far for the words, and neighbours of the same class are no pair.
    """
    out: list[tuple[int, int, int]] = []

    def meet(x: int, y: int, length: int) -> None:
        if left[x] != left[y] and y - x + length >= LEAST and length >= (PERIODS - 1) * (y - x):
            out.append((x, y + length, y - x))

    def merged(a: list[int], b: list[int], length: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        n = len(a)
        for p in b:
            i = bisect_left(a, p, 0, n)
            if i < n:
                meet(p, a[i], length)
            if i:
                meet(a[i - 1], p, length)
            if len(b) == 1:
                a.insert(i, p)
                return a
        if 16 * len(b) > n:
            a += b
            a.sort()
        else:
            for p in b:
                insort(a, p)
        return a

    stack: list[tuple[int, list[int]]] = []
    for place, length in zip(order, common, strict=True):
        own = [place]
        if length < SHORTEST:
            length = 0
        while stack and stack[-1][0] > length:
            above, held = stack.pop()
            own = merged(held, own, above)
        if length:
            if stack and stack[-1][0] == length:
                held = stack.pop()[1]
                own = merged(held, own, length)
            stack.append((length, own))
    return out


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period; and the documents' first places.

    ``words`` are the documents' words as numbers, one after the other, ``sizes`` the
    number of words of each.
    """
    ends = np.cumsum(sizes)
    begins = ends - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    again = _repeated(words, begins, ends, doc)
    some = np.bincount(doc[again], minlength=len(sizes)) > 0
    if not some.any():
        return np.zeros((0, 4), dtype=np.int64), begins
    # Only documents in which enough words are repeated go on, whole.
    inside = some[doc]
    places, words, again, doc = np.flatnonzero(inside), words[inside], again[inside], doc[inside]
    number = np.cumsum(some) - 1
    own = number[doc]
    own_ends = np.cumsum(sizes[some])
    levels = _rank_levels(words, own_ends, own)
    candidates = np.flatnonzero(again)
    order = candidates[np.argsort(levels[-1][candidates])]
    common = np.append(_common(levels, order[:-1], order[1:]), 0)
    starts_doc = np.ones(len(words), dtype=bool)
    starts_doc[1:] = own[1:] != own[:-1]
    left = np.where(starts_doc, -1, np.concatenate([[0], words[:-1]]))
    found = _pairs(order.tolist(), common.tolist(), left.tolist())
    if not found:
        return np.zeros((0, 4), dtype=np.int64), begins
    start, end, period = np.array(found, dtype=np.int64).T
    # A run is also a pair at multiples of its period: the shortest distance is the period.
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    whose = doc[start]
    out = np.column_stack([whose, places[start] - begins[whose], end - start, period])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))], begins


_RUNS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, its ``runs`` and the text ``collapsed`` to one period of each.

    Words stand between ASCII white space.  A run (``start`` by word from 0, ``length``,
    smallest ``period``; in order of start, then period) is a stretch of words that equal
    the word a period before them, of at least ``LEAST`` words and ``PERIODS`` periods,
    that no neighbouring word continues.  ``collapsed`` has the words that lie in no run
    after its first period, one space between them.

    Null texts and texts without words have no runs and collapse to an empty text.  Rows
    are worked on alone, so repeated rows and null ids are kept as they are; other columns,
    whatever their names, do not come along.  Memory follows the Arrow batch or the longest
    text; work is in proportion to the words, with a logarithm for the repeated ones.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [WORD.findall(t or "") for t in batch.column("text").to_pylist()]
            sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            flat = np.empty(int(sizes.sum()), dtype=object)
            flat[:] = [w for words in texts for w in words]
            runs, begins = find_runs(pd.factorize(flat)[0].astype(np.int64), sizes)
            covered = np.zeros(len(flat) + 1, dtype=np.int64)
            at = begins[runs[:, 0]] + runs[:, 1]
            np.add.at(covered, at + runs[:, 3], 1)
            np.add.at(covered, at + runs[:, 2], -1)
            kept = np.cumsum(covered[:-1]) == 0
            texts_out = [
                " ".join(words) if kept[a:a + len(words)].all() else " ".join([w for w, k in zip(words, kept[a:a + len(words)], strict=True) if k])
                for words, a in zip(texts, begins.tolist(), strict=True)
            ]
            offsets = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], fields=list(_RUNS))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), items), pa.array(texts_out, pa.string()),
            ], names=[id, "n_words", "runs", "collapsed"])

    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        scan, f"`{id}` long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
