"""Logistic regressions of many labels on the same texts, trained together.

Each regression has half the squared norm of its weights (not the intercept) plus the log loss
of its texts, weighted so that both classes count the same. L-BFGS runs on the driver, which
holds a few vectors per label; the values and gradients of all labels come from one pass over the
texts per step, as one sum over tasks of a matrix (labels x terms).
"""

from __future__ import annotations

import contextlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from civiltext.operators.features import TfidfModel
from civiltext.operators.sums import summed
from civiltext.sources.shared import stored

GRADIENT = 0.01     # largest entry of the gradient at the end
MAX_STEPS = 500
MEMORY = 100        # steps kept per label: with few, more texts take ever more passes
BLOCK_ENTRIES = 1 << 15     # of a block, or a single text
# A reader holds a row group, and a writer so many rows before it looks at their size.
FILES = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 8,
         "parquet.page.size.row.check.min": 1, "compression": "uncompressed"}
TASKS_A_CORE = 2            # of a pass; each hands on a matrix (labels x terms)
_DECREASE = 1e-4    # share of the promised decrease that a step has to bring


@contextlib.contextmanager
def blocks(training: DataFrame, labels: list[str], tfidf: TfidfModel) -> Iterator[DataFrame]:
    """The texts' vectors and labels as blocks of sparse rows, a column per part of a block.

    Written to the shared folder, for every step reads them, and deleted at the end.
    """
    sent = tfidf.sent(training.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = np.stack([batch.column(c).to_numpy() for c in labels]).astype(np.int8)
            for texts, row, idx, weight in sent.value.by_piece(batch.column("tokens")):
                y, first = every[:, texts], 0
                starts = np.searchsorted(row, np.arange(y.shape[1] + 1))
                while first < y.shape[1]:
                    last = int(np.searchsorted(starts, starts[first] + BLOCK_ENTRIES, side="right")) - 1
                    last = max(first + 1, last)
                    own = slice(starts[first], starts[last])
                    parts = (y[:, first:last], np.diff(starts[first:last + 1]).astype(np.int32),
                             idx[own].astype(np.int32), weight[own])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts],
                        names=["y", "size", "idx", "weight"])
                    first = last

    made = training.select("tokens", *labels).mapInArrow(
        run, "y binary, size binary, idx binary, weight binary")
    with stored(made, "blocks", **FILES) as made:
        yield made


def value_and_gradient(made: DataFrame, points: dict[int, np.ndarray], rows: int,
                       positives: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Value and gradient of the objectives of some labels, each at its point (weights, then
    intercept); ``points`` has them by the label's number."""
    which, points = list(points), np.stack(list(points.values()))
    n, size, every = len(points), points.shape[1] - 1, len(positives)
    balance = np.array([[rows / (2.0 * (rows - positives[i])), rows / (2.0 * positives[i])]
                        for i in which])
    sent = made.sparkSession.sparkContext.broadcast(points)

    def losses(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        at, found = sent.value, np.zeros((n, size + 2))
        for batch in batches:
            # Looked at where they are: a batch is not held twice.
            for parts in zip(*batch.columns):
                y, entries, idx, weight = (np.frombuffer(p.as_buffer(), kind) for p, kind in zip(
                    parts, (np.int8, np.int32, np.int32, np.float64)))
                y, idx = y.reshape(every, -1)[which], idx.astype(np.intp)
                row = np.repeat(np.arange(len(entries)), entries)
                for i in range(n):
                    z = np.bincount(row, weight * at[i, idx], y.shape[1]) + at[i, size]
                    cost = balance[i, y[i]]
                    error = cost * (1 / (1 + np.exp(-z)) - y[i])
                    found[i, :size] += np.bincount(idx, weight * error[row], size)
                    found[i, size] += error.sum()
                    found[i, size + 1] += (cost * (np.logaddexp(0, z) - y[i] * z)).sum()
        return found

    tasks = TASKS_A_CORE * made.sparkSession.sparkContext.defaultParallelism
    total = summed(made.coalesce(tasks), losses, (n, size + 2))
    sent.destroy()
    gradient = total[:, :size + 1]
    gradient[:, :size] += points[:, :size]
    return total[:, size + 1] + (points[:, :size] ** 2).sum(axis=1) / 2, gradient


class _Descent:
    """L-BFGS for one label: asks for values at ``trial`` and is told them."""

    def __init__(self, size: int):
        self.point, self.value, self.gradient = np.zeros(size), None, None
        self.trial, self.direction, self.step = self.point, None, 1.0
        self.pairs = deque(maxlen=MEMORY)

    def tell(self, value: float, gradient: np.ndarray) -> None:
        if self.value is not None:
            slope = self.gradient @ self.direction
            if value > self.value + _DECREASE * self.step * slope and self.step > 1e-12:
                # The minimum of the parabola through both values, within limits.
                bend = value - self.value - self.step * slope
                self.step *= min(0.5, max(0.1, -slope * self.step / (2 * bend)))
                self.trial = self.point + self.step * self.direction
                return
            # Half the bytes: a step kept is a hint at the curvature, never part of a result.
            moved = (self.trial - self.point).astype(np.float32)
            turned = (gradient - self.gradient).astype(np.float32)
            if (bend := moved.astype(float) @ turned) > 1e-12:
                self.pairs.append((moved, turned, 1 / bend))
        self.point, self.value, self.gradient = self.trial, value, gradient
        self.direction = -self._solved(gradient)
        self.step = 1.0 if self.pairs else 1 / max(1.0, np.linalg.norm(gradient))
        self.trial = self.point + self.step * self.direction

    def _solved(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient times the inverse curvature that the last steps tell."""
        q, shares = gradient.copy(), []
        for moved, turned, rho in reversed(self.pairs):
            shares.append(rho * (moved @ q))
            q -= shares[-1] * turned
        if self.pairs:
            moved, turned, rho = self.pairs[-1]
            q /= rho * (turned.astype(float) @ turned)
        for (moved, turned, rho), share in zip(self.pairs, reversed(shares)):
            q += (share - rho * (turned @ q)) * moved
        return q

    @property
    def steepest(self) -> float:
        return np.inf if self.gradient is None else float(abs(self.gradient).max())


def minimize(made: DataFrame, size: int, rows: int,
             positives: list[int]) -> tuple[np.ndarray, list[float]]:
    """The minimum of every label (weights, then intercept) and its largest gradient entry.

    A pass serves all labels that are not solved yet.
    """
    labels = [_Descent(size + 1) for _ in positives]
    for _ in range(MAX_STEPS):
        trials = {i: x.trial for i, x in enumerate(labels) if x.steepest > GRADIENT}
        if not trials:
            break
        for i, value, gradient in zip(trials, *value_and_gradient(made, trials, rows, positives)):
            labels[i].tell(value, gradient)
            if labels[i].steepest <= GRADIENT:
                labels[i].pairs.clear()
    return np.stack([x.point for x in labels]), [x.steepest for x in labels]
