"""Bounded samples of labelled rows for fitting the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(text, y, turn) of at most `rows` labelled rows whose id meets `learn`,
    in the order of a hash of the id (turn).

    Labels of one id are averaged and rounded; rows without a label or id are
    left out. The ids are chosen on the narrow label table, and only as many
    as `rows` are broadcast to the documents. Of an id on several documents the
    smallest text is taken.
    """
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & learn)
              .groupBy(id_col).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
              .withColumn("turn", F.xxhash64(id_col)).orderBy("turn", id_col).limit(rows))
    return (docs.select(id_col, F.col(text_col).alias("text"))
            .join(F.broadcast(chosen), id_col).groupBy(id_col, "turn", "y").agg(F.min("text").alias("text"))
            .select("text", "y", "turn"))


def collected(features: DataFrame, width: int, dtype: str, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sample's (features, y, turn) rows as arrays of `width` columns, in
    the order of turn; a row with which there would be more than `most` numbers
    in all is left out of the fit, which bounds what the driver holds."""
    sizes = features.select("turn", F.octet_length("features").alias("n")).orderBy("turn").collect()
    total, kept = 0, []
    for r in sizes:
        n = r.n // np.dtype(dtype).itemsize
        if total + n <= most:
            total += n
            kept.append((r.turn,))
    if not kept:
        return [], np.zeros(0)
    turns = features.sparkSession.createDataFrame(kept, "turn long")
    got = sorted(features.join(F.broadcast(turns), "turn", "left_semi").collect(), key=lambda r: (r.turn, r.y, bytes(r.features)))
    arrays = [np.frombuffer(r.features, dtype=dtype).reshape(-1, width) for r in got]
    return arrays, np.array([r.y for r in got], dtype=np.float64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def threshold(logits: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap between logits at which the mean of the
    two classes' shares of right answers is highest."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], y[order]
    right = np.concatenate([[0], np.cumsum(y == 0)]) / max(1, (y == 0).sum()) \
        + np.concatenate([[(y == 1).sum()], (y == 1).sum() - np.cumsum(y == 1)]) / max(1, (y == 1).sum())
    gaps = np.diff(x)
    inner = right[1:-1]
    if not len(gaps):
        return 0.0
    best = np.flatnonzero((inner >= inner.max() - 1e-9) & (gaps > 0))
    if not len(best):
        return float(np.median(x))
    k = best[np.argmax(gaps[best])]
    return float((x[k] + x[k + 1]) / 2)


class Adam:
    """Adam steps on a dictionary of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= self.rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)
