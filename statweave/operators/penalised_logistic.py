"""L2-regularised logistic regression with the bias under the penalty, by limited-memory BFGS.

The bias is a feature of constant 1 like any other, so it is penalised; estimators of the
library leave the intercept out of the penalty and drop a constant feature. An evaluation is
one pass: a task adds up its rows' loss and gradient over Arrow batches, Spark adds
the tasks' entries up by position, and the driver holds the last ``corrections`` steps and gradients (model state). Rows
with a null label or vector are left out; no rows give a zero model with the loss 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.functions.arrays import as_array
from statweave.plans.staging import persisted


def _evaluated(rows: DataFrame, weights: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
    """Mean loss plus penalty, and its gradient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights) + 2)  # gradient, loss, rows
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.array(batch.column(0).to_pylist(), float), np.ones(batch.num_rows)])
            y = batch.column(1).to_numpy()
            margin = x @ weights
            p = 0.5 * (1 + np.tanh(margin / 2))
            total[:-2] += x.T @ (p - y)
            total[-2] += (np.logaddexp(0, margin) - y * margin).sum()
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["j", "v"])

    sums = {r["j"]: r["v"] for r in rows.mapInArrow(run, "j int, v double").groupBy("j").agg(F.sum("v").alias("v")).collect()}
    total = np.array([sums.get(j, 0.0) for j in range(len(weights) + 2)])
    n = max(total[-1], 1.0)
    return total[-2] / n + reg / 2 * float(weights @ weights), total[:-2] / n + reg * weights


def fit_penalised_logistic(
    train: DataFrame, reg: float = 0.1, max_iter: int = 20, tol: float = 1e-4, corrections: int = 10
) -> tuple[np.ndarray, list[float]]:
    """(weights with the bias last, loss at the start and after every step) of ``features``, ``label``.

    Ends after ``max_iter`` steps or when a step lowers the loss by less than ``tol`` of it.
    """
    rows = train.select(as_array(train, "features").alias("x"), F.col("label").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    with persisted(rows) as kept:
        first = kept.select(F.size("x").alias("d")).first()
        weights = np.zeros((first["d"] if first else 0) + 1)
        loss, gradient = _evaluated(kept, weights, reg)
        history, pairs = [loss], []
        for _ in range(max_iter):
            direction = -_two_loops(gradient, pairs)
            slope, length = float(gradient @ direction), 1.0
            if slope >= -1e-18:
                break
            while True:
                after, steeper = _evaluated(kept, weights + length * direction, reg)
                if after <= loss + 1e-4 * length * slope or length < 1e-10:
                    break
                length /= 2
            step, change = length * direction, steeper - gradient
            if step @ change > 1e-18:
                pairs = [*pairs, (step, change)][-corrections:]
            done = loss - after <= tol * max(abs(loss), abs(after), 1e-300)
            weights, loss, gradient = weights + step, after, steeper
            history.append(loss)
            if done:
                break
    return weights, history


def _two_loops(gradient: np.ndarray, pairs: list) -> np.ndarray:
    """The inverse Hessian of the last steps times ``gradient``."""
    q, shares = gradient.copy(), []
    for step, change in reversed(pairs):
        share = (step @ q) / (step @ change)
        q -= share * change
        shares.append(share)
    if pairs:
        step, change = pairs[-1]
        q *= (step @ change) / (change @ change)
    for (step, change), share in zip(pairs, reversed(shares)):
        q += (share - (change @ q) / (step @ change)) * step
    return q
