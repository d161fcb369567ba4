"""L2 logistic regressions of many nested training sets at once, by Newton's method.

The training sets of a walk-forward evaluation only grow: a row belongs to every fold
from ``fold_from`` on.  One Spark job a step sums, for all folds that have not ended, the
loss, gradient and Hessian over the distinct (features, label, fold_from) rows: each
task adds up its rows in Arrow batches, and the sums of tasks are added by key.  The
driver solves one small system a fold.  A step that does not lower a fold's objective
is halved.

Objective (as scikit-learn's): ``C * sum of w_i * loss_i + |coefficients|^2 / 2``, intercept
free.  A fold ends when the largest component of the gradient, over ``C`` times the sum of
the weights, is at most ``limit``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FOLD_FROM = "fold_from"
#: Steps after which a fold is not looked after any more; Newton takes about 8.
MAX_STEPS = 100


class NotConverged(ArithmeticError):
    pass


@dataclass
class FoldProblem:
    """Scaling, class weights and present levels (over ``levels`` of all folds) of a fold."""
    means: np.ndarray
    scales: np.ndarray
    weights: tuple[float, float]
    total_weight: float


def _design(numeric: np.ndarray, level: np.ndarray, n_levels: int, problem: FoldProblem) -> np.ndarray:
    return np.hstack([(numeric - problem.means) / problem.scales, np.eye(n_levels)[level], np.ones((len(level), 1))])


def step_sums(rows: DataFrame, numeric: list[str], category: str, label: str, count: str, levels: list[str],
              problems: dict[int, FoldProblem], points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Loss, gradient and Hessian (without the penalty) of each fold at its point."""
    shared = rows.sparkSession.sparkContext.broadcast((levels, problems, points))    # a few rows a fold
    size = len(numeric) + len(levels) + 1

    def partial(batches):
        levels, problems, points = shared.value
        code = {v: i for i, v in enumerate(levels)}
        sums = {k: np.zeros(1 + size + size * size) for k in points}
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in numeric])
            level = np.array([code[v] for v in batch.column(category).to_pylist()], dtype=np.int64)
            y = batch.column(label).to_numpy(zero_copy_only=False).astype(float)
            n = batch.column(count).to_numpy(zero_copy_only=False).astype(float)
            first = batch.column(FOLD_FROM).to_numpy(zero_copy_only=False)
            for k, point in points.items():
                own = first <= k
                if not own.any():
                    continue
                a = _design(x[own], level[own], len(levels), problems[k])
                weight = n[own] * np.where(y[own] == 1, problems[k].weights[1], problems[k].weights[0])
                margin = a @ point
                p = 0.5 * (1 + np.tanh(margin / 2))
                sums[k][0] += weight @ (np.logaddexp(0, margin) - y[own] * margin)
                sums[k][1: 1 + size] += a.T @ (weight * (p - y[own]))
                sums[k][1 + size:] += ((a * (weight * p * (1 - p))[:, None]).T @ a).ravel()
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
                              names=["fold", "sums"])

    added = (rows.mapInArrow(partial, "fold int, sums array<double>").select("fold", F.posexplode("sums").alias("at", "v"))
             .groupBy("fold", "at").agg(F.sum("v").alias("v"))
             .groupBy("fold").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias("sums")).collect())
    out = {}
    for r in added:
        s = np.array(r["sums"])
        out[r["fold"]] = (s[0], s[1: 1 + size], s[1 + size:].reshape(size, size))
    return out


def fit(rows: DataFrame, numeric: list[str], category: str, label: str, count: str, levels: list[str],
        problems: dict[int, FoldProblem], c: float, limit: float, max_steps: int = MAX_STEPS) -> dict[int, np.ndarray]:
    """Coefficients (numeric, levels, intercept) of every fold."""
    size = len(numeric) + len(levels) + 1
    penalty = np.append(np.ones(size - 1), 0.0)
    done: dict[int, np.ndarray] = {}
    point = {k: np.zeros(size) for k in problems}
    base: dict[int, tuple[float, np.ndarray]] = {}
    worst: dict[int, float] = {}
    for _ in range(max_steps):
        sums = step_sums(rows, numeric, category, label, count, levels, problems, point)
        for k, (loss, gradient, hessian) in sums.items():
            at = point[k]
            value = c * loss + 0.5 * penalty @ (at * at)
            slope = c * gradient + penalty * at
            worst[k] = float(np.abs(slope).max() / (c * problems[k].total_weight))
            if worst[k] <= limit:
                done[k] = at
                del point[k]
            elif k in base and value > base[k][0] + 1e-12 * abs(base[k][0]):
                point[k] = (base[k][1] + at) / 2
            else:
                base[k] = (value, at)
                point[k] = at - np.linalg.solve(c * hessian + np.diag(penalty), slope)
        if not point:
            return done
    raise NotConverged(f"gradient {max(worst[k] for k in point):.3g} after {max_steps} step(s), limit {limit:.3g}")
