"""Small pieces for the classifiers: bounded labelled samples and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import P, fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int, max_bytes: int, doc_id: str = "doc_id", text: str = "text") -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(texts with labels, label counts): of each class the per_class labelled ids that hash lowest.

    keep is a condition on the column doc_id of the labels; only rows of at most max_bytes of text
    are taken, so the sample is bounded in rows and bytes. Ids and labels that are null are left
    out; an id labelled more than once takes its largest label. Counts cover all labels kept.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    own = own.where(keep).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in own.groupBy("y").count().collect()}
    chosen = None
    for y in (0, 1):
        part = own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    picked = [(r.doc_id, r.y) for r in chosen.collect()]
    if not picked:
        return [], counts
    small = docs.sparkSession.createDataFrame(picked, f"{P}id long, {P}y int")
    rows = docs.select(F.col(doc_id).cast("long").alias(f"{P}doc"), F.col(text).cast("string").alias("text")).where(F.octet_length("text") <= max_bytes)
    hit = rows.join(F.broadcast(small), F.col(f"{P}doc") == F.col(f"{P}id")).groupBy(f"{P}id").agg(F.min(F.struct("text", f"{P}y")).alias("r"))
    return [(r.r[0], r.r[1]) for r in hit.orderBy(F.xxhash64(f"{P}id")).collect()], counts


def held_out(parts: int, part: int, doc_id: str = "doc_id") -> Column:
    return fold(F.col(doc_id).cast("long"), parts) == part


class Logistic:
    """Weighted ridge logistic regression on a few standardised features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 60):
        self.mean, self.std = np.zeros(x.shape[1]), np.ones(x.shape[1])
        self.beta = np.zeros(x.shape[1] + 1)
        if len(y) == 0:
            return
        weight = weight / weight.sum() * len(y)
        self.mean = np.average(x, axis=0, weights=weight)
        self.std = np.sqrt(np.average((x - self.mean) ** 2, axis=0, weights=weight)) + 1e-9
        if y.min() == y.max():
            self.beta[0] = 4.0 if y[0] else -4.0
            return
        a = np.c_[np.ones(len(y)), (x - self.mean) / self.std]
        penalty = np.eye(a.shape[1]) * ridge * len(y) / 100
        penalty[0, 0] = 1e-9
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ self.beta, -30, 30)))
            grad = a.T @ (weight * (y - p)) - penalty @ self.beta
            hess = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty + np.eye(a.shape[1]) * 1e-9
            step = np.linalg.solve(hess, grad)
            size = np.abs(step).max()
            self.beta += step * min(1.0, 5.0 / size if size else 1.0)
            if size < 1e-8:
                break

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = self.beta[0] + (x - self.mean) / self.std @ self.beta[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def class_weights(y: np.ndarray, counts: dict[int, int]) -> np.ndarray:
    """Weights that give a class-balanced sample the class shares of all labels."""
    w = np.ones(len(y))
    for c in (0, 1):
        n = int((y == c).sum())
        if n:
            w[y == c] = counts.get(c, n) / n
    return w
