"""What the classifiers of this subpackage share: folds, label samples, logistic fits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(key: str | Column, folds: int) -> Column:
    """A fold from 0 on by CRC-32 of the key's text; null without a key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % folds


def label_sample(labels: DataFrame, key: str, label: str, most: int, where: Column | None = None) -> DataFrame:
    """``key, label`` of at most ``most`` labelled rows, chosen by a hash of the key.

    Only labels 0 and 1 count. Rows with the same key are one row, of the larger label.
    """
    rows = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    rows = rows if where is None else rows.filter(where)
    one = rows.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("double").alias("label"))
    return one.orderBy(F.xxhash64("key"), "key").limit(most)


@dataclass(frozen=True)
class Logistic:
    """A linear classifier: the log-odds of 1 are ``bias`` and ``weights`` times features."""

    weights: tuple[float, ...] = ()
    bias: float = 0.0

    def log_odds(self, features: Column) -> Column:
        if not self.weights:
            return F.lit(self.bias)
        terms = F.zip_with(features, F.lit(list(self.weights)), lambda x, w: x * w)
        return F.aggregate(terms, F.lit(self.bias), lambda total, x: total + F.coalesce(x, F.lit(0.0)))


def logistic(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def _sums(rows: DataFrame, of_batch: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``of_batch`` makes of features, labels and weights.

    Each task adds up its rows; the driver gets one row for each number of the sum.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0)
                features = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                part = of_batch(features, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = rows.select("x", "y", "weight").mapInArrow(added, "sums array<double>")
    sums = parts.select(F.posexplode("sums").alias("i", "part")).groupBy("i").agg(F.sum("part").alias("total"))
    return np.array([row["total"] for row in sorted(sums.collect())])


def fit_logistic(rows: DataFrame, ridge: float = 5e-3, steps: int = 15, start: Logistic | None = None) -> Logistic | None:
    """Fit on columns ``x`` (array), ``y`` (0 or 1) and ``weight`` by Newton's method,
    one pass over the rows for each step, from ``start`` if that is given; None unless
    both labels have weight."""
    moments = _sums(rows, lambda x, y, w: np.concatenate([[w.sum(), (w * y).sum()], w @ x, w @ (x * x)]))
    if not len(moments) or not 0 < moments[1] < moments[0]:
        return None
    mass, size = moments[0], (len(moments) - 2) // 2
    mean = moments[2 : 2 + size] / mass
    spread = np.sqrt((moments[2 + size :] / mass - mean * mean).clip(0))
    scale = np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)
    beta = np.zeros(size + 1)
    if start is not None:
        known = np.array(start.weights)
        beta = np.append(known * np.where(scale > 0, spread, 0.0), start.bias + known @ mean)
    penalty = np.append(np.full(size, ridge), 1e-9)
    for _ in range(steps):

        def slopes(x: np.ndarray, y: np.ndarray, w: np.ndarray, beta: np.ndarray = beta) -> np.ndarray:
            z = np.column_stack([(x - mean) * scale, np.ones(len(x))])
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            return np.concatenate([z.T @ (w * (p - y)), (z.T @ (z * (w * p * (1 - p))[:, None])).ravel()])

        sums = _sums(rows, slopes) / mass
        gradient, bend = sums[: size + 1], sums[size + 1 :].reshape(size + 1, size + 1)
        step = np.linalg.solve(bend + np.diag(penalty + 1e-9), gradient + penalty * beta)
        beta = beta - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 0.02 * (1 + np.abs(beta).max()):
            break
    weights = beta[:-1] * scale
    return Logistic(tuple(weights.tolist()), float(beta[-1] - weights @ mean))
