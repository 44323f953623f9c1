"""Many logistic regressions at once: every (point, fold) of a cross-validated search (M4, M6).

All fits of a search read the same rows and differ only in their penalty and in
the fold they leave out.  So the rows are packed into blocks once and cached,
and one pass over the blocks serves every fit: a task adds up each fit's loss,
gradient and Hessian (matrix products over its blocks), the driver takes a
proximal Newton step for each.  A search needs as many passes as its slowest fit
needs steps, about ten, whatever the number of points and folds.

The objective is Spark ML's: mean log loss plus ``reg * (l1_ratio * |b|_1 +
(1 - l1_ratio) / 2 * |b|_2^2)`` over coefficients of features divided by their
standard deviation in the fold's training rows; the intercept has no penalty.
Fits are started along the regularisation path: the strongest penalty of every
fold is fitted first and the others start from its solution.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one packed block.
BLOCK_ROWS = 4096
#: A fit has converged when no coefficient violates its optimality condition by more; or by up to a hundred
#: times as much while a whole step changes the objective by less than STILL of it.
TOLERANCE = 1e-6
STILL = 1e-9
MAX_PASSES = 60
#: Partial sums of more tasks than this are added up on the executors first.
DRIVER_PARTIALS = 16


@dataclass
class Fit:
    """One fit: its fold, penalties and evidence of convergence (``violation`` of the optimality
    conditions, objective after every accepted step)."""

    point: int
    fold: int | None
    l1: float
    l2: float
    coefficients: np.ndarray
    intercept: float
    converged: bool
    violation: float
    objectives: list[float]


def pack(data: DataFrame, label: str, features: str, fold: str | None = None) -> DataFrame:
    """Blocks (fold, x, y) of the rows of ``data``: up to BLOCK_ROWS rows of one fold and partition, as
    the bytes of a matrix of doubles and of the labels."""
    rows = data.select((F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
                       F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(f):
            x, y = (np.concatenate(v) for v in zip(*held.pop(f)))
            return pa.record_batch([pa.array([f], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])], names=["fold", "x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            folds, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for f in np.unique(folds).tolist():
                own = folds == f
                held.setdefault(f, []).append((x[own], y[own]))
                if sum(len(part[1]) for part in held[f]) >= BLOCK_ROWS:
                    yield block(f)
        for f in sorted(held):
            yield block(f)

    return rows.mapInArrow(work, "fold int, x binary, y binary")


def _sum_over(blocks: DataFrame, shape: tuple[int, ...], work, more: tuple[str, ...] = ()) -> np.ndarray:
    """The sum of ``work(fold, x, y, *more)`` (arrays of ``shape``) over all blocks.  A task sends one array;
    beyond DRIVER_PARTIALS tasks the arrays are added up in groups before the driver adds the rest."""

    def partial(batches):
        from pyspark import TaskContext

        total = np.zeros(shape)
        for batch in batches:
            for fold, x, y, *own in zip(*[batch.column(c).to_pylist() for c in ("fold", "x", "y", *more)]):
                y = np.frombuffer(y)
                total += work(fold, np.frombuffer(x).reshape(len(y), -1), y, *own)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()])], names=["task", "sums"])

    def added(batches):
        total, first = np.zeros(shape), None
        for batch in batches:
            for task, sums in zip(batch.column("task").to_pylist(), batch.column("sums").to_pylist()):
                first = task if first is None else first
                total += np.frombuffer(sums).reshape(shape)
        if first is not None:
            yield pa.record_batch([pa.array([first], pa.int32()), pa.array([total.tobytes()])], names=["task", "sums"])

    sums = blocks.mapInArrow(partial, "task int, sums binary")
    tasks = blocks.rdd.getNumPartitions()
    if tasks > DRIVER_PARTIALS:
        groups = int(np.ceil(np.sqrt(tasks)))
        sums = (sums.repartitionById(groups, F.col("task") % groups).sortWithinPartitions("task")
                .mapInArrow(added, "task int, sums binary"))
    out = np.zeros(shape)
    for r in sorted(sums.collect(), key=lambda r: r["task"]):  # a fixed order: the same sum every time
        out += np.frombuffer(r["sums"]).reshape(shape)
    return out


def _step(g: np.ndarray, h: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The coefficients at which one fit's quadratic model plus its penalties is least: an active-set
    method, exact up to rounding.  ``g`` and ``h`` are gradient and Hessian at ``b``."""
    d = len(b)
    h = h + np.diag(1e-10 * np.diag(h) + 1e-14)  # features that depend on each other: stay near b
    x = b.copy()
    sign = np.sign(x)
    on = (x != 0) | (l1 == 0)
    for _ in range(20 * d):
        rows = np.flatnonzero(on)
        # h (x - b) + g + l2 x + l1 sign = 0 on the active set, where the others are 0
        right = h[rows] @ b - g[rows] - l1[rows] * sign[rows]
        to = np.zeros(d)
        if len(rows):
            to[rows] = np.linalg.solve(h[np.ix_(rows, rows)] + np.diag(l2[rows]), right)
        crossed = on & (l1 > 0) & (to * sign < 0)
        if crossed.any():  # as far as the first coefficient that would change its sign; it is 0 from there
            at = np.flatnonzero(crossed)
            share = x[at] / (x[at] - to[at])
            x += share.min() * (to - x)
            gone = at[share <= share.min()]
            x[gone], sign[gone], on[gone] = 0.0, 0.0, False
            continue
        x = to
        slope = h @ (x - b) + g
        excess = np.where(on, -np.inf, np.abs(slope) - l1)
        worst = int(excess.argmax())
        if excess[worst] <= 1e-12:
            break
        on[worst], sign[worst] = True, -np.sign(slope[worst])
    return x


def fit_many(blocks: DataFrame, n_features: int, penalties: list[tuple[float, float]], folds: list[int | None],
             tolerance: float = TOLERANCE, max_passes: int = MAX_PASSES) -> list[Fit]:
    """Fit every penalty (``l1``, ``l2``) without every fold (``None``: on all rows).  ``blocks`` come from
    ``pack`` and should be cached.  Fits are returned point by point, fold by fold."""
    d = n_features
    kinds = sorted({f for f in folds if f is not None})

    # rows, sums and squares of every fold's blocks, for the standard deviations
    def moments(fold, x, y):
        out = np.zeros((len(kinds) + 1, 2 * d + 1))
        out[kinds.index(fold) if fold in kinds else -1] = np.concatenate(([len(y)], x.sum(axis=0), np.square(x - about).sum(axis=0)))
        return out

    about = np.zeros(d)
    first = _sum_over(blocks, (len(kinds) + 1, 2 * d + 1), moments)
    if not first[:, 0].sum():
        raise ValueError("no training rows")
    about = first[:, 1:d + 1].sum(axis=0) / first[:, 0].sum()  # squares from the mean: no cancellation
    per = _sum_over(blocks, (len(kinds) + 1, 2 * d + 1), moments)
    n, sd, apart_by = {}, {}, {}
    for f in dict.fromkeys(folds):
        own = np.ones(len(per), bool)
        if f is not None:
            own[kinds.index(f)] = False
        rows, total, squares = per[own, 0].sum(), per[own, 1:d + 1].sum(axis=0), per[own, d + 1:].sum(axis=0)
        n[f], apart_by[f] = rows, total / max(rows, 1) - about
        apart = squares - (total - rows * about) ** 2 / max(rows, 1)
        # what is left of the squares of a feature that is constant in these rows is rounding
        sd[f] = np.sqrt(np.where(apart > 1e-12 * squares, apart, 0) / max(rows - 1, 1))

    keys = [(p, f) for p in range(len(penalties)) for f in folds]
    state = {}
    strongest = max(range(len(penalties)), key=lambda p: sum(penalties[p]))
    for wave in ([k for k in keys if k[0] == strongest], [k for k in keys if k[0] != strongest]):
        if wave:
            start = {k: state[strongest, k[1]] if (strongest, k[1]) in state else None for k in wave}
            state |= _newton(blocks, wave, penalties, start, n, sd, about, apart_by, tolerance, max_passes)
    out = []
    for p, f in keys:
        s = state[p, f]
        scale = np.where(sd[f] > 0, sd[f], 1)
        weights = np.where(sd[f] > 0, s["b"][:-1] / scale, 0.0)
        out.append(Fit(p, f, *penalties[p], weights, float(s["b"][-1] - weights @ (about + apart_by[f])), s["converged"], s["violation"], s["objectives"]))
    return out


def _newton(blocks, keys, penalties, start, n, sd, about, apart, tolerance, max_passes) -> dict:
    """Proximal Newton for a wave of fits; a fit that has converged leaves the passes.  Features are
    measured from their means in the fit's own rows (``about + apart``): only the intercept changes, and it
    no longer depends on them.  The passes measure them from ``about``, the same for all fits."""
    d = len(about)
    moved = {}  # from a fit's own intercept to the one of the passes
    for f, by in apart.items():
        moved[f] = np.eye(d + 1)
        moved[f][d, :d] = -by
    one_over = {f: np.append(np.where(s > 0, 1 / np.where(s > 0, s, 1), 0), 1.0) for f, s in sd.items()}
    l1 = np.array([[penalties[p][0]] * d + [0.0] for p, _ in keys])
    l2 = np.array([[penalties[p][1]] * d + [0.0] for p, _ in keys])
    b = np.array([start[k]["b"] if start[k] else np.zeros(d + 1) for k in keys])
    kept = [{"b": b[i].copy(), "value": np.inf, "g": None, "h": None, "violation": np.inf, "converged": False, "objectives": []} for i in range(len(keys))]
    active = list(range(len(keys)))
    for _ in range(max_passes):
        if not active:
            break
        tried = b[active]
        of = [keys[i][1] for i in active]
        scale = np.array([one_over[f] for f in of])
        weights = np.array([moved[f] @ w for f, w in zip(of, tried * scale)])  # in the features' own units

        def sums(fold, x, y):
            total = np.zeros((len(of), 1 + (d + 1) + (d + 1) ** 2))
            use = [k for k, f in enumerate(of) if f is None or f != fold]
            full = np.column_stack((x - about, np.ones(len(y))))
            margin = full @ weights[use].T
            loss = np.logaddexp(0, margin) - y[:, None] * margin
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            total[use, 0] = loss.sum(axis=0)
            total[use, 1:d + 2] = (p - y[:, None]).T @ full
            for at, k in enumerate(use):
                w = p[:, at] * (1 - p[:, at])
                total[k, d + 2:] = (full.T @ (full * w[:, None])).ravel()
            return total

        found = _sum_over(blocks, (len(of), 1 + (d + 1) + (d + 1) ** 2), sums)
        moving = []
        for at, i in enumerate(active):
            rows, k = n[of[at]], kept[i]
            value = found[at, 0] / rows + (l1[i] * np.abs(tried[at])).sum() + (l2[i] * tried[at] ** 2).sum() / 2
            if not value <= k["value"] + 1e-12 * abs(k["value"]):  # no descent: half the way back
                if np.abs(tried[at] - k["b"]).max() > 1e-12:
                    b[i] = (tried[at] + k["b"]) / 2
                    moving.append(i)
                continue
            to = moved[of[at]] * scale[at]
            g = to.T @ found[at, 1:d + 2] / rows
            h = to.T @ (found[at, d + 2:].reshape(d + 1, d + 1) / rows) @ to
            smooth = g + l2[i] * tried[at]
            gap = np.where(tried[at] != 0, np.abs(smooth + l1[i] * np.sign(tried[at])), np.maximum(np.abs(smooth) - l1[i], 0))
            still = k["value"] - value <= STILL * abs(value) and gap.max() <= 100 * tolerance
            k |= {"b": tried[at].copy(), "value": value, "g": g, "h": h, "violation": float(gap.max()),
                  "converged": bool(gap.max() <= tolerance or still)}
            k["objectives"].append(float(value))
            if not k["converged"]:
                moving.append(i)
        stepping = [i for i in moving if (b[i] == kept[i]["b"]).all()]
        if stepping:
            for i in stepping:
                b[i] = _step(kept[i]["g"], kept[i]["h"], b[i], l1[i], l2[i])
        active = moving
    return {key: kept[i] for i, key in enumerate(keys)}


def fold_accuracy(blocks: DataFrame, fits: list[Fit], n_features: int) -> np.ndarray:
    """Share of right predictions of every fit on the fold it has left out (all rows for ``None``)."""
    weights = np.array([np.append(f.coefficients, f.intercept) for f in fits])
    of = [f.fold for f in fits]

    def right(fold, x, y):
        total = np.zeros((len(of), 2))
        use = [k for k, f in enumerate(of) if f is None or f == fold]
        margin = x @ weights[use, :-1].T + weights[use, -1]
        total[use, 0] = ((margin > 0) == (y[:, None] > 0.5)).sum(axis=0)
        total[use, 1] = len(y)
        return total

    found = _sum_over(blocks, (len(of), 2), right)
    return found[:, 0] / np.maximum(found[:, 1], 1)
