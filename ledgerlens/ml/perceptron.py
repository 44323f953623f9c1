"""Many perceptrons at once: every (point, fold) of a cross-validated search (M4, M9).

The learner is Spark ML's ``MultilayerPerceptronClassifier`` with one hidden layer and the solver
``gd``: sigmoid units, softmax on top, the mean cross entropy of stacks of 128 rows, full steps
from the learner's own first weights until these stand still or ``max_iter`` steps were tried.  There a
step of every fold is a job of its own and multiplies in plain JVM code; here the rows are packed
once and one pass over the blocks serves the steps of all fits, as matrix products over Arrow batches.

While the loss comes down the steps are Spark ML's.  There it may also rise for good, as features have very
different ranges; here a step that raises it is taken back and the fit goes on with half the step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.ml.logistic_path import BLOCK_ROWS, _sum_over

#: Rows of one of Spark ML's stacks, whose means a step averages.
STACK_ROWS = 128
#: Rows that a worker takes through the layers at once.
ROWS_AT_ONCE = 512
#: Rows of a partition of the packed blocks; their number follows the rows alone, as sums depend on it in their last digits.
PART_ROWS = 65536


@dataclass
class Perceptron:
    """One fit: its fold, weights in Spark ML's order and the loss before the first and after every step that was kept."""

    point: int
    fold: int
    hidden: int
    weights: np.ndarray
    losses: list[float]


def pack(data: DataFrame, label: str, features: str, fold: str, folds: int) -> DataFrame:
    """Blocks (fold, x, y, weights) of the rows of ``data``, the rows of one fold and partition.  ``weights``: of every
    row for each fold that is left out, the share of its stack and of that fold's stacks."""
    rows = data.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))
    sizes = np.zeros((data.rdd.getNumPartitions(), folds), np.int64)
    for r in rows.groupBy(F.spark_partition_id().alias("part"), "fold").count().collect():  # one row a partition and fold
        sizes[r["part"], r["fold"]] = r["count"]
    kept = sizes.sum(axis=1, keepdims=True) - sizes  # rows of a partition without a fold
    stacks = (-(-kept // STACK_ROWS)).sum(axis=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list] = {}
        made: list[int] = []
        own, seen = kept[TaskContext.get().partitionId()], np.zeros(folds, np.int64)

        def block(f):
            x, y, w = (np.concatenate(v) for v in zip(*held.pop(f)))
            made.append(f)
            return pa.record_batch([pa.array([v], pa.int32()) for v in (f, TaskContext.get().partitionId(), len(made))] + [pa.array([v.tobytes()]) for v in (x, y, w)],
                                   names=["fold", "part", "no", "x", "y", "weights"])

        for batch in batches:
            if not batch.num_rows:
                continue
            of, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels other than 0 and 1")
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            used = of[:, None] != np.arange(folds)
            place = seen + used.cumsum(axis=0) - 1
            seen = seen + used.sum(axis=0)
            size = np.minimum(STACK_ROWS, own - place // STACK_ROWS * STACK_ROWS)
            weights = np.where(used, 1 / (np.maximum(size, 1) * np.maximum(stacks, 1)), 0.0)
            for f in np.unique(of).tolist():
                mine = of == f
                held.setdefault(f, []).append((x[mine], y[mine], weights[mine]))
                if sum(len(part[1]) for part in held[f]) >= BLOCK_ROWS:
                    yield block(f)
        for f in sorted(held):
            yield block(f)

    blocks = rows.mapInArrow(work, "fold int, part int, no int, x binary, y binary, weights binary")
    parts = int(sizes.sum()) // PART_ROWS
    if parts <= len(sizes):
        return blocks
    return blocks.repartitionById(parts, (F.col("no") * len(sizes) + F.col("part")) % parts).sortWithinPartitions("no", "part")


def _layers(weights: np.ndarray, d: int, hidden: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The hidden units' weights and, last row, offsets, negated; the differences of the two classes' weights and offsets."""
    a, b = d * hidden, d * hidden + hidden
    w2, b2 = weights[b:b + 2 * hidden].reshape(hidden, 2), weights[b + 2 * hidden:]
    return -np.concatenate((weights[:a].reshape(d, hidden), weights[a:b][None])), w2[:, 1] - w2[:, 0], b2[1] - b2[0]


def _forward(full: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The hidden units' outputs, and the margin of class 1; ``full``: rows with a one at their end."""
    first, diff, offset = layers
    h = full @ first
    with np.errstate(over="ignore"):
        np.exp(h, out=h)
    h += 1
    np.reciprocal(h, out=h)
    return h, h @ diff + offset


def _full(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    for k in range(0, len(x), ROWS_AT_ONCE):
        at = slice(k, min(k + ROWS_AT_ONCE, len(x)))
        yield at, np.column_stack((x[at], np.ones(at.stop - k)))


def _gradient(full, y, w, layers) -> np.ndarray:
    """Loss and gradient of the weighted cross entropy."""
    first, diff, _ = layers
    h, margin = _forward(full, layers)
    delta = (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y) * w  # of class 1; of class 0 it is the negative
    loss, right = w @ (np.logaddexp(0, margin) - y * margin), delta @ h
    slope = h * h
    np.subtract(h, slope, out=slope)
    below = ((full * delta[:, None]).T @ slope) * diff
    return np.concatenate(([loss], below.ravel(), np.stack((-right, right), axis=1).ravel(), [-delta.sum(), delta.sum()]))


def fit_many(blocks: DataFrame, n_features: int, starts: list[np.ndarray], folds: list[int], *, hidden: list[int], steps: list[float],
             max_iter: list[int], tolerance: float = 1e-6) -> list[Perceptron]:
    """Fit every point (its first weights, units, step and most steps) without every fold.  ``blocks`` come from
    ``pack`` and should be cached.  Fits are returned point by point, fold by fold."""
    fits = [Perceptron(p, f, hidden[p], starts[p].copy(), []) for p in range(len(starts)) for f in folds]
    tried = {id(f): f.weights for f in fits}
    slopes: dict[int, np.ndarray] = {}
    step = {id(f): steps[f.point] for f in fits}
    left = {id(f): max_iter[f.point] for f in fits}
    active = fits
    while active:
        bounds = np.cumsum([0, *[1 + len(f.weights) for f in active]])
        layers = [(f.fold, _layers(tried[id(f)], n_features, f.hidden)) for f in active]

        def sums(fold, x, y, weights):
            total, weights = np.zeros(bounds[-1]), np.frombuffer(weights).reshape(len(y), -1)
            for at, full in _full(x):
                for k, (left_out, own) in enumerate(layers):
                    if left_out != fold:
                        total[bounds[k]:bounds[k + 1]] += _gradient(full, y[at], weights[at, left_out], own)
            return total

        found, moving = _sum_over(blocks, (int(bounds[-1]),), sums, ("weights",)), []
        for k, fit in enumerate(active):
            own, key = found[bounds[k]:bounds[k + 1]], id(fit)
            if not fit.losses or own[0] <= fit.losses[-1]:
                moved = np.linalg.norm(tried[key] - fit.weights) if fit.losses else np.inf
                fit.weights, slopes[key] = tried[key], own[1:]
                fit.losses.append(float(own[0]))
                if moved < tolerance * max(np.linalg.norm(fit.weights), 1.0):
                    continue
            else:
                step[key] /= 2
            tried[key] = fit.weights - step[key] * slopes[key]
            left[key] -= 1
            if left[key] >= 0:
                moving.append(fit)
        active = moving
    return fits


def fold_accuracy(blocks: DataFrame, fits: list[Perceptron], n_features: int) -> np.ndarray:
    """Share of right predictions of every fit on the fold it has left out."""
    layers = [(f.fold, _layers(f.weights, n_features, f.hidden)) for f in fits]

    def right(fold, x, y):
        total = np.zeros((len(layers), 2))
        for k, (left_out, own) in enumerate(layers):
            if left_out == fold:
                total[k] = sum(((_forward(full, own)[1] > 0) == (y[at] > 0.5)).sum() for at, full in _full(x)), len(y)
        return total

    found = _sum_over(blocks, (len(layers), 2), right)
    return found[:, 0] / np.maximum(found[:, 1], 1)
