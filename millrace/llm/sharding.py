"""Consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Sealed, numbered

#: Places on the ring.  Keys and virtual nodes sit on them; bounds everything the driver sees.
CELLS = 1 << 14


def owners(shards: int, vnodes: int, cells: int = CELLS) -> np.ndarray:
    """The shard of each cell: that of the first virtual node at or after it, clockwise."""
    at: dict[int, int] = {}
    for shard in range(shards):
        for v in range(vnodes):
            cell = xxhash.xxh64_intdigest(f"{shard}/{v}", seed=42) % cells
            at[cell] = min(shard, at.get(cell, shard))
    out, after = np.empty(cells, dtype=np.int32), at[min(at)]
    for cell in range(cells - 1, -1, -1):
        after = at.get(cell, after)
        out[cell] = after
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """The bound of each shard: an even share, or with ``slack`` that much above it."""
    if slack:
        return [int(np.ceil(total * (1 + slack) / shards))] * shards
    share, rest = divmod(total, shards)
    return [share + (s < rest) for s in range(shards)]


def fill(counts: Mapping[int, int], owner: np.ndarray, free: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Which keys of each cell go where: (cell, first rank, end rank, shard, first slot).

    A shard takes the keys of its own cells while it has room.  The keys left over go on
    clockwise from their cell, and each is taken by the first shard with room; those that
    started earlier are served first.
    """
    free, used = list(free), [0] * len(free)
    out: list[tuple[int, int, int, int, int]] = []

    def take(cell: int, first: int, most: int, shard: int) -> int:
        n = min(most, free[shard])
        if n:
            out.append((cell, first, first + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return n

    left: dict[int, tuple[int, int]] = {}
    for cell in sorted(counts):
        done = take(cell, 0, counts[cell], int(owner[cell]))
        if done < counts[cell]:
            left[cell] = (done, counts[cell])
    walking: deque[tuple[int, int, int]] = deque()
    for step in range(2 * len(owner)):
        cell = step % len(owner)
        if step < len(owner) and cell in left:
            walking.append((cell, *left[cell]))
        while walking and free[shard := int(owner[cell])]:
            start, first, end = walking.popleft()
            done = take(start, first, end - first, shard)
            if first + done < end:
                walking.appendleft((start, first + done, end))
        if step >= len(owner) and not walking:
            break
    return out


def ring_shards(
    df: DataFrame, key: str, shards: int, tie: Sequence[str] = (), vnodes: int = 64, slack: float = 0.0,
) -> DataFrame:
    """Each row with its ``shard`` and its ``slot`` there (gapless from 0).

    A key's cell on the ring is a hash of the key.  A shard takes at most its bound of
    rows: (1 + ``slack``) times the even share, or with ``slack`` 0 shares that differ by
    one row at most.  Because only counts decide how far keys overflow, the driver gets
    one count per cell (``CELLS`` at most) and Spark numbers the rows within the cells.

    Null keys are spread by the hash of ``tie``; equal keys start in one cell and overflow
    like others, and rows that agree in ``tie`` as well may swap places.  An empty frame
    gives an empty one.  Other columns are kept, but old ``shard`` and ``slot`` are replaced.
    """
    sealed = Sealed(df, key, *tie)
    place = F.when(F.col(key).isNull(), F.xxhash64(*tie) if tie else F.lit(0)).otherwise(
        F.xxhash64(F.col(key).cast("string"))
    )
    placed = sealed.inner.withColumn("_cell", F.pmod(place, F.lit(CELLS)).cast("int"))
    counts = {r["_cell"]: r["n"] for r in placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = sorted(fill(counts, owners(shards, vnodes), capacities(sum(counts.values()), shards, slack)))
    cells, first, _, shard, slot = (
        np.array(column, dtype=np.int64) for column in (zip(*plan, strict=True) if plan else [[]] * 5)
    )
    begins = np.searchsorted(cells, np.arange(CELLS + 1))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column("_cell").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            hit = np.empty(len(c), dtype=np.int64)
            for i, (cell, r) in enumerate(zip(c, rank, strict=True)):
                low, high = begins[cell], begins[cell + 1]
                hit[i] = low if high - low == 1 else low + np.searchsorted(first[low:high], r, side="right") - 1
            kept = [batch.column(n) for n in batch.schema.names if n not in ("_cell", "_rank")]
            names = [n for n in batch.schema.names if n not in ("_cell", "_rank")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(shard[hit].astype(np.int32)), pa.array(slot[hit] + rank - first[hit])],
                names=[*names, "shard", "slot"],
            )

    inner = sealed.inner
    schema = T.StructType([*inner.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    ranked = numbered(placed, ["_cell"], [key, *tie], "_rank").select(*inner.columns, "_cell", "_rank")
    return sealed.open(ranked.mapInArrow(look_up, schema), "shard", "slot")
