"""Mixing sources to target weights by fitting word budgets exactly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SALT_ROWS, SALTS, Sealed, numbered, salts_by_count

#: The rest of a budget that is fitted by ``nearest_sum`` at first; what is above it is filled in the seeded order of the lengths.
EXACT_BUDGET = 1 << 14
#: Bits of the sums that one search for a better fit may hold (64 MB).
MOST_BITS = 1 << 29


def targets(sizes: Mapping[str, int], weights: Mapping[str, float], most: float) -> dict[str, float]:
    """Shares of the total size by weight; none above ``most`` times its own size, the excess reshared by weight."""
    out: dict[str, float] = {}
    left, open_ = float(sum(sizes.values())), [s for s in sizes if sizes[s] > 0]
    out.update((s, 0.0) for s in sizes if not sizes[s])
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = [s for s in open_ if weights[s] * unit > most * sizes[s]]
        if not full:
            out.update((s, weights[s] * unit) for s in open_)
            break
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in set(full)]
    return out


def _reachable(lengths: Sequence[int], counts: Sequence[int], most: int, budget: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Sums up to ``most`` as the bits of one number, and the steps that reached them.

    A count is split into powers of two and a rest, each of which is used or not.  Stops
    when ``budget`` is reached, which takes few of many lengths, or when the steps hold
    ``MOST_BITS``: then the sums of the lengths so far are what there is to choose from.
    """
    reach, mask, steps, room = 1, (1 << (most + 1)) - 1, [], max(1, MOST_BITS // (most + 1))
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        part, left = 1, min(count, most // length)
        while left and len(steps) < room:
            part = min(part, left)
            steps.append((i, part, reach))
            reach |= reach << length * part & mask
            left, part = left - part, 2 * part
        if reach >> budget & 1 or len(steps) >= room:
            break
    return reach, steps


def _walk_back(lengths: Sequence[int], steps: list[tuple[int, int, int]], best: int) -> list[int]:
    picked = [0] * len(lengths)
    for i, part, before in reversed(steps):
        if not before >> best & 1:
            picked[i] += part
            best -= part * lengths[i]
    return picked


def knapsack(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length, at most their count, come closest to the budget from below."""
    reach, steps = _reachable(lengths, counts, budget, budget)
    return _walk_back(lengths, steps, reach.bit_length() - 1)


def nearest_sum(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each length, at most their count, come closest to the budget, from below if two are as close."""
    # A sum above the budget is no better than none at all from twice the budget on.
    reach, steps = _reachable(lengths, counts, 2 * budget, budget)
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    over = reach >> (budget + 1)
    above = budget + (over & -over).bit_length() if over else 2 * budget + 1
    return _walk_back(lengths, steps, below if budget - below <= above - budget else above)


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length to take so that their sizes add up to the budget, or come closest to it.

    Every length gives the same share first, rounded down.  The rest is filled by single
    documents, lengths in a seeded order, until it is small enough for ``nearest_sum``.
    If that misses, documents taken so far are given back, twice as many each time, and
    the larger rest is fitted again: until the budget is met or all of them are given back
    (no choice is closer then, if the sums of all lengths fit in ``MOST_BITS``).  The first
    rest is fitted at every size; only a larger one, of which not even one sum fits, is not.
    """
    total = int((lengths * counts).sum())
    budget = min(budget, total)
    if budget <= 0:
        return np.zeros(len(lengths), dtype=np.int64)
    length, count = [int(n) for n in lengths], [int(c) for c in counts]
    share = [c * budget // total for c in count]
    left = budget - sum(n * t for n, t in zip(length, share, strict=True))
    order = [int(i) for i in np.random.default_rng(seed).permutation(len(length))]
    progress = True
    while left > EXACT_BUDGET and progress:
        progress = False
        for i in order:
            if share[i] < count[i] and length[i] <= left and left > EXACT_BUDGET:
                share[i] += 1
                left -= length[i]
                progress = True
    best, miss, back = share, left, 0
    while miss:
        # Longer ones than twice the rest are further away than taking none.
        fits = [i for i in order if share[i] < count[i] and length[i] < 2 * left]
        if back and 2 * left + 1 > MOST_BITS:
            break
        trial = list(share)
        for i, n in zip(fits, nearest_sum([length[i] for i in fits], [count[i] - share[i] for i in fits], left), strict=True):
            trial[i] += n
        now = abs(budget - sum(n * t for n, t in zip(length, trial, strict=True)))
        if now < miss:
            best, miss = trial, now
        taken = sum(share)
        if not taken:
            break
        back = min(taken, 2 * back or 4)
        share, give, held = list(share), back, order
        while give:
            held = [i for i in held if share[i]]
            for i in held[:give]:
                share[i] -= 1
                left += length[i]
            give -= min(give, len(held))
    return np.array(best, dtype=np.int64)


def mix(
    df: DataFrame, size: str, source: str, weights: Sequence[float], tie: Sequence[str], most: int = 3, seed: int = 7,
) -> DataFrame:
    """Each row with ``source_size``, ``target`` and ``times``, how often the mix takes it.

    Sources in code-point order, null last, have the ``weights`` in turn, repeating.  They
    share the total size by weight, none above ``most`` times its own (``targets``).  A
    source's documents are all taken as often as its target holds them whole; the rest
    of the target is a budget for some of them once more.  Documents are counted by exact
    length, ``fit_budget`` picks a count per length, and those documents are selected by a
    seeded order of ``tie``.  The mix may end below or above a target, whichever is closer.
    It misses one only by what no choice of whole documents reaches if the sums of the
    source fit in ``MOST_BITS``, else by what no choice among as many lengths as fit does; of
    many lengths a few tens reach any rest.

    The driver sees one size per source; one task sees the distinct lengths of a source.
    Sizes must not be null or negative; documents of size 0 are taken ``times`` 0 or as
    often as their source is taken whole, which adds nothing.  Reruns agree; rows that tie
    on all of ``tie`` may swap.  An empty table gives an empty one.  ``df`` is read
    three times, so settle it if it is costly.  Old columns with the names of new ones are
    replaced.
    """
    sealed = Sealed(df, size, source, *tie)
    rows = sealed.inner.withColumns({
        "_source": F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")),
        "_size": F.col(size).cast("long"), "_seeded": F.xxhash64(F.lit(seed), *tie),
    })
    counted = rows.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("n"))
    # With the sizes come the lengths that most rows of a source share: one for each 16 million rows at most.
    heavy = F.collect_list(F.when(F.col("n") > SALTS * SALT_ROWS, F.struct("_size", "n")))
    held = counted.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("s"), heavy.alias("h")).collect()
    sizes = {r["_source"]: int(r["s"]) for r in held}
    large = {f"{h['_size']}{r['_source']}": h["n"] for r in held for h in r["h"]}
    turn = {s: float(weights[i % len(weights)]) for i, s in enumerate(sorted(sizes))}
    goal = targets(sizes, turn, most)
    plan = {}
    for s, t in goal.items():
        full = min(most, int(t // sizes[s])) if sizes[s] else 0
        plan[s] = (sizes[s], t, full, round(t - full * sizes[s]))
    by_source = df.sparkSession.createDataFrame(
        [(s, *p) for s, p in plan.items()], "_source string, source_size long, target double, _full int, _budget long"
    )

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_size").reset_index(drop=True)
        budget, used = plan[frame["_source"][0]][3], frame[frame["_size"] > 0]
        picks = np.zeros(len(frame), dtype=np.int64)
        picks[used.index] = fit_budget(used["_size"].to_numpy(), used["n"].to_numpy(), budget, seed)
        return frame[["_source", "_size"]].assign(_picks=picks)

    picks = counted.groupBy("_source").applyInPandas(fit, "_source string, _size long, _picks long")
    ranked = numbered(rows, ["_source", "_size"], ["_seeded", *tie], "_rank", extra=picks,
                      salts=salts_by_count(large, F.concat(F.col("_size").cast("string"), "_source")))
    # One row per source: its bound is the number of sources, which the driver has just held.
    out = ranked.join(F.broadcast(by_source), "_source").withColumn(
        "times", F.col("_full") + (F.col("_rank") < F.col("_picks")).cast("int")
    )
    return sealed.open(out, "source_size", "target", "times")
