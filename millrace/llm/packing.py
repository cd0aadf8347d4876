"""Best-fit decreasing packing of token sequences."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Sealed, numbered, salts_by_count
from millrace.llm.words import word_tokenizer


class OpenWindows:
    """A segment tree over remaining capacities: which is the smallest that holds a length?"""

    def __init__(self, capacity: int) -> None:
        self._leaves = 1 << capacity.bit_length()
        self._any = [False] * (2 * self._leaves)

    def set(self, remaining: int, some: bool) -> None:
        node = self._leaves + remaining
        self._any[node] = some
        while node > 1:
            node >>= 1
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that some window has."""
        node = self._leaves + length
        if not self._any[node]:
            while node > 1 and (node & 1 or not self._any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node + (not self._any[2 * node])
        return node - self._leaves


def best_fit(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, pieces per window, first window, offset).

    Pieces are taken by falling length, each into the tightest open window, the oldest
    first; a new window opens if none fits.  Windows that were filled alike are handled
    together: pieces of one length fill the tightest window to the end before the next,
    as they do one by one, so the work depends on the lengths and not on how many pieces
    there are.
    """
    open_at: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    tree, windows = OpenWindows(capacity), 0
    out: list[tuple[int, int, int, int, int]] = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            remaining = capacity if room is None else room
            first, there = (windows, left) if room is None else open_at[room].popleft()
            each = remaining // length
            n, each = (min(there, left // each), each) if left >= each else (1, left)
            if room is None:
                windows += n
            elif n < there:
                open_at[room].appendleft((first + n, there - n))
            elif not open_at[room]:
                tree.set(room, False)
            out.append((length, rank, each, first, capacity - remaining))
            rank, left = rank + n * each, left - n * each
            rest = remaining - each * length
            if rest:
                open_at[rest].append((first, n))
                tree.set(rest, True)
    return out


def token_pieces(
    docs: DataFrame, tokenizer: str, end: int, capacity: int, id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The ids of each text, its end id last, cut into full windows and a remainder.

    Rows: id, ``start``, ``length``, ``doc_tokens`` and ``ids`` (little-endian unsigned
    32-bit).  Null texts are empty: one piece with the end id.  Each id is in one piece.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            if coder is None:
                coder = word_tokenizer(tokenizer, end)
            texts = batch.column("text").to_pylist()
            names, starts, lengths, totals, cells = [], [], [], [], []
            for name, ids in zip(batch.column("id").to_pylist(), coder.encode(texts), strict=True):
                for at in range(0, len(ids), capacity):
                    piece = ids[at:at + capacity]
                    names.append(name)
                    starts.append(at)
                    lengths.append(len(piece))
                    totals.append(len(ids))
                    cells.append(piece.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(cells, pa.binary())],
                names=[id, "start", "length", "doc_tokens", "ids"],
            )

    schema = f"`{id}` long, start long, length long, doc_tokens long, ids binary"
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(pieces, schema)


def pack(pieces: DataFrame, length: str, capacity: int, tie: Sequence[str]) -> DataFrame:
    """Each piece with its ``sequence_id`` and its ``offset`` there, gapless from 0.

    Lengths must be 1 to ``capacity`` (an error otherwise).  The driver gets one count per
    length, at most ``capacity`` of them, and packs by those; Spark numbers the pieces of
    each length (``tie`` tells them apart; equal pieces may swap places) and looks up
    where the plan puts that number.  ``pieces`` is read twice, so settle it if it is
    costly.  An empty frame gives an empty one; other columns are kept, but old ones with
    the names of new ones are replaced.
    """
    sealed = Sealed(pieces, length, *tie)
    inner = sealed.inner
    checked = inner.withColumn("_length", F.when(
        F.col(length).between(1, capacity), F.col(length)
    ).otherwise(F.raise_error(F.lit(f"lengths must be 1 to {capacity}"))).cast("long"))
    counts = {r["_length"]: r["n"] for r in checked.groupBy("_length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit(counts, capacity)
    plan.sort()
    lengths, first, each, window, offset = (
        np.array(column, dtype=np.int64) for column in (zip(*plan, strict=True) if plan else [[]] * 5)
    )
    begins = np.searchsorted(lengths, np.arange(capacity + 2))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("_length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            hit = np.empty(len(size), dtype=np.int64)
            for s in np.unique(size):
                low, high = begins[s], begins[s + 1]
                own = size == s
                hit[own] = low + np.searchsorted(first[low:high], rank[own], side="right") - 1
            within = rank - first[hit]
            names = [n for n in batch.schema.names if n not in ("_length", "_rank")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(window[hit] + within // each[hit]),
                 pa.array(offset[hit] + within % each[hit] * size)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = T.StructType([
        *inner.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    ranked = numbered(checked, ["_length"], list(tie), "_rank", salts=salts_by_count(counts, F.col("_length")))
    placed = ranked.select(*inner.columns, "_length", "_rank").mapInArrow(look_up, schema)
    return sealed.open(placed, "sequence_id", "offset")
