"""Labelled training rows and fits whose sums over all rows are Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD_OUT = 2
#: Labels beyond this number are not broadcast.
MAX_BROADCAST_LABELS = 500_000


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2: such rows are never learnt from. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, text: str = "text") -> DataFrame:
    """(text, label) of all labelled rows that are not held out.

    An id with several labels counts with the largest; null ids and labels are left out, repeated documents
    stay. Labels are broadcast only where few; else the texts of the join are shuffled by id.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("_label"))
    )
    few = chosen.limit(MAX_BROADCAST_LABELS + 1).count() <= MAX_BROADCAST_LABELS
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(chosen) if few else chosen, "doc_id").select("doc_id", "_text", "_label")


def totals(rows: DataFrame, size: int, make: Callable[[np.ndarray], Callable], w: np.ndarray) -> np.ndarray:
    """Sum over all rows of the `size` numbers that `make(w)` gives for a batch: one job, one row per task to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, total = make(w), np.zeros(size)
        for batch in batches:
            total += work(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    return sum((np.frombuffer(r.total) for r in rows.mapInArrow(run, "total binary").collect()), np.zeros(size))


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = 60, tolerance: float = 1e-5, memory: int = 10) -> np.ndarray:
    """Weights of least loss by L-BFGS with halved steps; `loss` gives value and gradient over all rows."""
    w, moves = start, []
    value, grad = loss(w)
    for _ in range(steps):
        way, parts = -grad, []
        for s, y in reversed(moves):
            parts.append((s @ way) / (s @ y))
            way = way - parts[-1] * y
        if moves:
            s, y = moves[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), part in zip(moves, reversed(parts)):
            way = way + s * (part - (y @ way) / (s @ y))
        rate, fall = 1.0 if moves else 1 / max(float(np.linalg.norm(grad)), 1.0), float(grad @ way)
        new, there = loss(w + rate * way)
        while new > value + 1e-4 * rate * fall and rate > 1e-6:
            rate /= 2
            new, there = loss(w + rate * way)
        if new >= value:
            break
        s, y = rate * way, there - grad
        if s @ y > 1e-14 * (y @ y):
            moves = [*moves, (s, y)][-memory:]
        done = value - new <= tolerance * abs(value)
        w, value, grad = w + s, new, there
        if done:
            break
    return w


def logistic_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and intercept of a one-variable logistic fit by damped Newton steps; `weight` counts each point so often."""
    if not len(x) or y.min() == y.max():
        return 0.0, 0.0
    share = np.full(len(x), 1 / len(x)) if weight is None else weight / weight.sum()
    scale = max(float(np.abs(x).max()), 1e-12)
    z = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)

    def loss(w):
        m = z @ w
        return float(share @ np.logaddexp(0, m) - share @ (y * m) + ridge * w[0] ** 2 / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        grad = z.T @ (share * (p - y)) + ridge * np.array([w[0], 0])
        hess = (z * (share * p * (1 - p))[:, None]).T @ z + np.diag([ridge, 1e-9])
        step, rate = np.linalg.solve(hess, grad), 1.0
        while loss(w - rate * step) > loss(w) and rate > 1e-4:
            rate /= 2
        w = w - rate * step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])
