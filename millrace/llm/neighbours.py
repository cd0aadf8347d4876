"""Nearest neighbours by inner product: inverted lists scanned by adaptive dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import settle

#: Least number of vectors that the lists, thresholds and number of probes are fitted on: a bounded sample by hash.
SAMPLE = 8192
#: Sample vectors per list, and lists per square root of the table: the sample grows with the square root.
PER_LIST, LISTS = 8, 0.25
#: Share of vectors by length beyond which, and a margin, a vector counts as very long; all such are in one list.
LENGTHS, MARGIN, LONG = 0.999, 1.25, -1
#: Vectors and queries that meet in one step of a scan.
BLOCK = 2048
QUERIES = 256
#: Dimensions of a column block, and how sure the test must be (in standard errors) to abandon a candidate.
COLUMNS = 16
EPSILON = 2.1
#: Recall that the number of probed lists must reach on the sample.
RECALL = 0.97
SEED = 5


@dataclass(frozen=True)
class Index:
    """What the tasks need: the length ``top`` that candidates are lifted to, rotation, centres, number of probes."""

    top: float
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    def rotate(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors with a coordinate more, rotated; ``top`` is the unit, so that no length leaves the range of floats.

        The extra coordinate lifts candidates to one length, so that the nearest in
        distance is the largest in inner product; queries have 0 there, and any length
        gives them the same order, so they get length 1.
        """
        if query:
            x, lift = x / np.sqrt((x**2).sum(axis=1))[:, None], np.zeros(len(x))
        else:
            x = x / self.top
            lift = np.sqrt(np.maximum(1 - (x**2).sum(axis=1), 0))
        return (np.column_stack([x, lift]) @ self.rotation).astype(np.float32)

    def _distances(self, rotated: np.ndarray) -> np.ndarray:
        return (self.centres**2).sum(axis=1) - 2 * rotated @ self.centres.T

    def home(self, rotated: np.ndarray) -> np.ndarray:
        """The nearest list of each vector, a block at a time."""
        return np.concatenate([np.zeros(0, np.int64), *[
            np.argmin(self._distances(rotated[i:i + BLOCK]), axis=1) for i in range(0, len(rotated), BLOCK)]])

    def order(self, rotated: np.ndarray) -> np.ndarray:
        """All lists, nearest first."""
        return np.argsort(self._distances(rotated), axis=1, kind="stable")


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dim)


def _centres(x: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:lists]].copy()
    for _ in range(rounds):
        near = Index(1, x, centres, 1).home(distinct)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, distinct)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit_index(vectors: DataFrame, n: int, dim: int, k: int) -> Index:
    """Lists, rotation and number of probes from a sample by hash of the id; the unit of length from all vectors.

    There are ``LISTS`` times the square root of n lists; the sample has ``PER_LIST`` vectors
    for each, ``SAMPLE`` at least.  So what the driver and every task hold grows with the
    square root of the table.
    """
    rng = np.random.default_rng(SEED)
    top = MARGIN * vectors.agg(F.percentile_approx("norm", LENGTHS, 10_000).alias("m")).first()["m"]
    lists = max(1, int(LISTS * np.sqrt(n)))
    usual = vectors.where(F.col("norm") <= top)
    picked = usual.orderBy(F.xxhash64("id"), "id").limit(max(SAMPLE, PER_LIST * lists)).select("v").toArrow()
    x = np.unique(_matrix(picked["v"].combine_chunks(), dim), axis=0)
    rotation = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
    rotated = Index(top, rotation, np.zeros((1, dim + 1), np.float32), 1).rotate(x, False)
    index = Index(top, rotation, _centres(rotated, lists, rng), 1)
    # How many lists, nearest first, hold the neighbours of some sample vectors within the sample?
    asked = x[:: max(1, len(x) // 256)]
    near = np.argsort(-(asked @ x.T), axis=1, kind="stable")[:, 1:k + 1]
    place = np.argsort(index.order(index.rotate(asked, True)), axis=1)
    needed = np.sort(np.take_along_axis(place, index.home(rotated)[near], axis=1).ravel())
    probes = int(needed[min(len(needed) - 1, int(RECALL * len(needed)))]) + 1 if len(needed) else 1
    return Index(top, rotation, index.centres, probes)


def whole_scan(queries: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that may be a query's k best of the block, its own id left out."""
    rough = queries @ x.T
    rough[q_ids[:, None] == ids[None, :]] = -np.inf
    if rough.shape[1] > k:
        # The product sums in another order than the exact score, so what is as good within rounding stays.
        slack = 1e-9 * np.sqrt((queries**2).sum(axis=1)) * np.sqrt((x**2).sum(axis=1).max())
        floor = -np.partition(-rough, k - 1, axis=1)[:, k - 1] - slack
        return np.nonzero((rough >= floor[:, None]) & (rough > -np.inf))
    return np.nonzero(rough > -np.inf)


def adaptive_scan(
    queries: np.ndarray, rotated: np.ndarray, columns: list[np.ndarray], norms: np.ndarray, radius: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) pairs that survive: candidates are abandoned as soon as a test on partial distances fails.

    ``columns`` are the rotated candidates in blocks of dimensions, ``norms`` their squared
    lengths per block.  After each block the partial squared distance, scaled up to all
    dimensions, estimates the whole one; a pair whose estimate is above the query's
    ``radius`` (squared) by more than ``EPSILON`` standard errors is dropped.  While most
    pairs live, blocks are multiplied whole; afterwards only for the survivors.
    """
    dim = rotated.shape[1]
    q, c, partial, seen = None, None, np.zeros((len(queries), len(rotated)), np.float32), 0
    for i, block in enumerate(columns):
        part = queries[:, seen:seen + block.shape[1]]
        own = (part**2).sum(axis=1)
        if q is None:
            partial += own[:, None] + norms[i][None, :] - 2 * part @ block.T
        else:
            partial = partial + own[q] + norms[i][c] - 2 * np.einsum("ij,ij->i", part[q], block[c])
        seen += block.shape[1]
        loose = (1 + EPSILON / np.sqrt(seen)) ** 2 * seen / dim if seen < dim else 1 + 1e-4
        limit = radius * loose + 1e-5
        if q is None:
            alive = partial <= limit[:, None]
            if alive.mean() < 0.25 or seen == dim:
                q, c = np.nonzero(alive)
                partial = partial[q, c]
        else:
            alive = partial <= limit[q]
            q, c, partial = q[alive], c[alive], partial[alive]
    return q, c


_FOUND = ("query_id", "vec_id", "h", "score")
_FOUND_SCHEMA = "query_id long, vec_id long, h long, score double"


def _best(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    frame = frame.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return frame[frame.groupby("query_id").cumcount() < k]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    embeddings: DataFrame, asked, k: int = 20, id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(``query_id``, ``rank`` from 1, id, ``score``): the nearest found of the rows that ``asked`` selects.

    Nearness is the inner product in double precision, ties to the smaller id; a query's
    own id is no candidate.  Null vectors, zero vectors, those with null or non-finite
    components, of another dimension than most, or without an id take no part.  Rows with
    equal id and vector count once.  An empty table gives an empty one.

    Every vector is put in the list of its nearest centre; lists of any size are cut into
    blocks of about ``BLOCK`` vectors, and the queries of a list into groups of about
    ``QUERIES``, so a list that holds a third of all vectors is many small steps.  A query
    first scans its nearest lists whole, as many as hold k candidates; the k-th best found
    there is the radius with which it goes on through the further lists, as many as reach
    ``RECALL`` on the sample, abandoning candidates early.  So each query has min(k,
    candidates) rows at every size, and lists that are not probed may hold better ones.

    Candidates are lifted to one length, which must not be that of a few very long vectors:
    those beyond ``MARGIN`` times the ``LENGTHS`` quantile, one of a thousand at most, are a
    list of their own that every query scans whole.
    """
    spark = embeddings.sparkSession
    sized = embeddings.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), asked.alias("asked"))
    good = sized.where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    ).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))).where("norm > 0")
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], f"query_id long, rank int, `{id}` long, score double")
    if sizes is None:
        return empty
    n, dim = sizes["n"], sizes["d"]
    good = settle(good.where(F.size("v") == dim), "vectors")
    index = fit_index(good, n, dim, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = index.home(index.rotate(_matrix(batch.column("v"), dim), False)).astype(np.int32)
            home[batch.column("norm").to_numpy() > index.top] = LONG
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), batch.column("h"), pa.array(home)], names=["id", "v", "h", "list"]
            )

    placed = settle(good.select("id", "v", "norm", F.xxhash64("v").alias("h")).mapInArrow(place, "id long, v array<double>, h long, list int"), "lists")
    # One row per list; there are as many as the driver has centres.
    counts = settle(placed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")), "list_sizes")
    sizes_of = {r["list"]: r["ids"] for r in counts.collect()}
    held = np.array([sizes_of.get(i, 0) for i in range(len(index.centres))], dtype=np.int64)
    slices = F.broadcast(counts.select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("slices")))
    blocks = placed.join(slices, "list").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).groupBy(
        "list", "slice"
    ).agg(F.sort_array(F.collect_set(F.struct("id", "v", "h"))).alias("rows"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = _matrix(batch.column("v"), dim), batch.column("id").to_numpy()
            lists = index.order(index.rotate(x, True))
            # The lists before which there are fewer candidates than k, the query's own id aside.
            size = held[lists]
            first = np.cumsum(size, axis=1) - size < k + 1
            use = (first | (np.arange(lists.shape[1])[None, :] < index.probes)) & (size > 0)
            take, nth = np.nonzero(use)
            chosen, whole = lists[take, nth].astype(np.int32), first[take, nth]
            if LONG in sizes_of:
                every = np.arange(len(ids))
                take, chosen = np.concatenate([take, every]), np.concatenate([chosen, np.full(len(ids), LONG, np.int32)])
                whole = np.concatenate([whole, np.ones(len(ids), dtype=bool)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[take]), batch.column("v").take(pa.array(take)), pa.array(chosen), pa.array(whole)],
                names=["query_id", "q", "list", "whole"])

    wanted = good.where("asked").select("id", "v").dropDuplicates(["id", "v"])
    probes = settle(wanted.mapInArrow(probe, "query_id long, q array<double>, list int, whole boolean"), "probes")

    def scanned(asks: DataFrame) -> DataFrame:
        """Queries (``query_id``, ``q``, ``least``) meet the blocks of their lists, a group and a block at a time."""
        groups = F.broadcast(asks.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups")))
        gathered = (
            asks.join(groups, "list").join(slices, "list")
            .withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int"))
            .groupBy("list", "group", "slices").agg(F.collect_list(F.struct("query_id", "q", "least")).alias("queries"))
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices", "group")
        )
        return gathered.join(blocks, ["list", "slice"]).select("queries", "rows").mapInArrow(scan, _FOUND_SCHEMA)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                queries, rows = batch.column("queries")[row].values, batch.column("rows")[row].values
                q, x = _matrix(queries.field("q"), dim), _matrix(rows.field("v"), dim)
                q_ids, ids = queries.field("query_id").to_numpy(), rows.field("id").to_numpy()
                least = queries.field("least").to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isnan(least).any():
                    qi, ci = whole_scan(q, q_ids, x, ids, k)
                else:
                    r = index.rotate(x, False)
                    columns = [np.ascontiguousarray(r[:, a:a + COLUMNS]) for a in range(0, r.shape[1], COLUMNS)]
                    norms = [(b**2).sum(axis=1) for b in columns]
                    # In units of top and for queries of length 1: |q - x|^2 = 2 - 2 qx, the least product as a largest distance.
                    radius = np.maximum(2 - 2 * least / (np.sqrt((q**2).sum(axis=1)) * index.top), 0)
                    qi, ci = adaptive_scan(index.rotate(q, True), r, columns, norms, radius)
                    other = q_ids[qi] != ids[ci]
                    qi, ci = qi[other], ci[other]
                # Summed the same way for every pair, so that equal vectors tie exactly.
                score = (q[qi] * x[ci]).sum(axis=1)
                frame = _best(pd.DataFrame({"query_id": q_ids[qi], "vec_id": ids[ci], "h": rows.field("h").to_numpy()[ci], "score": score}), k)
                yield pa.RecordBatch.from_arrays([pa.array(frame[c].to_numpy()) for c in _FOUND], names=list(_FOUND))

    first = settle(_ranked(scanned(probes.where("whole").select("query_id", "q", "list", F.lit(None).cast("double").alias("least"))), k), "first")
    # The k-th best so far; a query with fewer has seen all lists.
    radius = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    further = settle(probes.where("NOT whole").join(radius, "query_id").select("query_id", "q", "list", "least"), "further")
    found = first.select(*_FOUND).unionByName(scanned(further))
    return _ranked(found, k).select("query_id", F.col("rank").cast("int"), F.col("vec_id").alias(id), "score")
