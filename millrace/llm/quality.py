"""Quality scores: random Fourier features, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

#: Random features and the width of the kernel, in standard deviations of the statistics.
FEATURES = 192
WIDTH = 4.0
RIDGE = 1e-2
#: Bins of the ridge score for the calibration; bounds what the driver sees.
BINS = 2000
SEED = 11

_BYTE_KIND = np.zeros(256, dtype=np.int64)
for _kind, _bytes in enumerate((
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:'\"-", b"!?", bytes(range(128, 256)),
), 1):
    _BYTE_KIND[list(_bytes)] = _kind
STATISTICS = 19


def statistics(text: str | None) -> list[float]:
    """What the classifier sees of a text; zeros for an empty one."""
    words = (text or "").split()
    if not words:
        return [0.0] * STATISTICS
    raw = text.encode()
    kinds = np.bincount(_BYTE_KIND[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / len(raw)
    lines = text.split("\n")
    filled = [x for x in lines if x.strip()]
    n = len(words)
    lower = [w.lower() for w in words]
    seen = len(set(lower))
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=n)
    return [
        float(np.log1p(n)), float(np.log1p(len(lines))), float(np.log1p(n / len(filled))),
        *map(float, kinds),
        float(np.log1p(sizes.mean())), float(np.log1p(sizes.std())), float(np.log1p(sizes.max())),
        seen / n, float(np.log1p(n / seen)), len(set(filled)) / len(filled),
        sum(map(str.isupper, words)) / n,
        sum(1 for a, b in zip(lower, lower[1:], strict=False) if a == b) / n,
    ]


def with_statistics(df: DataFrame, text: str, *kept: str) -> DataFrame:
    """The ``kept`` columns and ``x``, the statistics of the text."""
    types = dict(df.dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array(x, pa.list_(pa.float64()))], names=[*kept, "x"]
            )

    schema = ", ".join([*[f"`{k}` {types[k]}" for k in kept], "x array<double>"])
    return df.select(*kept, F.col(text).alias("_text")).mapInArrow(scan, schema)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``y`` in weighted squares (pool adjacent violators)."""
    means, weights, sizes = [], [], []
    for value, w in zip(y, weight, strict=True):
        means.append(float(value))
        weights.append(float(w))
        sizes.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            w = weights[-2] + weights[-1]
            means[-2:] = [(means[-2] * weights[-2] + means[-1] * weights[-1]) / w]
            weights[-2:] = [w]
            sizes[-2:] = [sizes[-2] + sizes[-1]]
    return np.repeat(means, sizes)


@dataclass(frozen=True)
class Model:
    """Statistics are standardised, mapped to random cosines and weighted; the sum is calibrated."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of a Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        return np.hstack([np.cos(z) * np.sqrt(2 / self.directions.shape[1]), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, with a thousandth of the raw score to keep the order within flat stretches."""
        raw = self.raw(x)
        return np.clip(0.999 * np.interp(raw, self.knots, self.values) + 0.001 * np.clip(raw, 0, 1), 0.0, 1.0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), STATISTICS)


def fit(rows: DataFrame, ridge: float = RIDGE, features: int = FEATURES) -> Model:
    """A model from ``rows`` of statistics ``x``, label ``y`` (0 or 1) and ``calibrate`` (boolean).

    Each partition sums its normal equations; the sums meet row by row of the matrix, so
    neither a task nor the driver ever holds more than ``features`` squared numbers.  The
    isotonic curve comes from rows the ridge has not seen, counted in ``BINS`` bins; this
    holds for every number of rows.  If the rows for the ridge or those for the curve lack
    a label, the score is constant: the share of label 1 in all rows, or 0.5 without rows.
    """
    rng = np.random.default_rng(SEED)
    moments = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")
    ).collect()
    mean, scale = np.zeros(STATISTICS), np.ones(STATISTICS)
    for r in moments:
        mean[r["i"]], scale[r["i"]] = r["m"], r["s"] if r["s"] > 1e-9 else 1.0
    flat = np.zeros(features + 1)
    model = Model(
        mean, scale, rng.normal(0, 1 / WIDTH, (STATISTICS, features)), rng.uniform(0, 2 * np.pi, features), flat,
        np.array([0.0]), np.array([0.5]),
    )

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n, part = np.zeros((features + 1, features + 2)), 0, TaskContext.get().partitionId()
        for frame in frames:
            z = model.features(_matrix(frame["x"]))
            y = frame["y"].to_numpy(dtype=np.float64)
            total += z.T @ np.column_stack([z, y])
            n += len(frame)
        if n:
            yield pd.DataFrame({"i": range(features + 1), "part": part, "n": n, "v": list(total)})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")  # one order of summing, so that reruns agree
        return pd.DataFrame({"i": frame["i"][:1], "n": [frame["n"].sum()], "v": [np.sum(frame["v"].tolist(), axis=0)]})

    shape = "i int, part int, n long, v array<double>"
    equations = (
        rows.where("NOT calibrate").select("x", "y").mapInPandas(sums, shape)
        .groupBy("i").applyInPandas(add, "i int, n long, v array<double>").toPandas().sort_values("i")
    )
    if len(equations):
        table = np.array(equations["v"].tolist())
        gram, n = table[:, :-1], int(equations["n"].iloc[0])
        penalty = np.full(features + 1, ridge * n / features)
        penalty[-1] = 1e-9
        model = Model(**{**vars(model), "weights": np.linalg.solve(gram + np.diag(penalty), table[:, -1])})

    def bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw = np.clip(model.raw(_matrix(frame["x"])), -0.5, 1.5)
            yield pd.DataFrame({"bin": ((raw + 0.5) * (BINS / 2)).astype(int), "raw": raw, "y": frame["y"], "own": frame["calibrate"]})

    counted = rows.select("x", "y", "calibrate").mapInPandas(bins, "bin int, raw double, y int, own boolean").groupBy("own", "bin").agg(
        F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")
    ).toPandas().sort_values("bin")
    if not len(counted):
        return model
    both = counted.assign(good=counted["y"] * counted["n"]).groupby("own")[["good", "n"]].sum()
    if len(both) < 2 or not both["good"].between(0, both["n"], inclusive="neither").all():
        share = both["good"].sum() / both["n"].sum()
        return Model(**{**vars(model), "weights": flat, "values": np.array([share])})
    counted = counted[counted["own"]]
    values = isotonic(counted["y"].to_numpy(), counted["n"].to_numpy())
    knots = np.maximum.accumulate(counted["raw"].to_numpy())
    return Model(**{**vars(model), "knots": knots, "values": values})


def held_out_by(id: str) -> Column:
    """Every third id by checksum is kept from training (null ids count as empty strings)."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 3 == 1


def quality_scores(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", also: tuple[str, ...] = (), label: str = "quality",
) -> DataFrame:
    """(id, ``also``, ``held_out``, ``score``, ``predicted``) of every row of ``docs``.

    ``labels`` has id and ``label`` (0 or 1); other values and nulls are ignored.  Only
    rows that are not held out train: of those, crc32 remainder 0 fits the ridge and 2 the
    calibration.  The score depends on the text alone, so equal texts score alike; empty
    and null texts have statistics of zero.  The statistics are written once and the text
    is read once, a row at a time.  An empty table gives an empty one.
    """
    kept = [id, *[c for c in also if c != id]]
    rows = settle(with_statistics(docs, text, *kept), "statistics")
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id).alias("_label_id"), F.col(label).cast("int").alias("y"))
    training = rows.join(known, F.col(id) == F.col("_label_id")).where(~held_out_by(id)).select(
        "x", "y", (F.crc32(F.col(id).cast("string")) % 3 == 2).alias("calibrate")
    )
    model = fit(settle(training, "training"))
    types = dict(rows.dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.float64).reshape(batch.num_rows, STATISTICS)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in kept], pa.array(model.score(x))], names=[*kept, "score"]
            )

    schema = ", ".join([*[f"`{k}` {types[k]}" for k in kept], "score double"])
    return rows.mapInArrow(scan, schema).select(
        *kept, held_out_by(id).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
