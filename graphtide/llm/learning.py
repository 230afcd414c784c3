"""Bounded labelled samples and a small logistic regression, shared by the two classifiers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphtide.llm.common import named


def known(labels: DataFrame, label: str, trusted: Column, *, id: str = "doc_id") -> DataFrame:
    """(␟id, label) of the labels that ``trusted`` lets through; null ids or labels are left out."""
    return labels.where(trusted).select(named(id).alias("␟id"), named(label).cast("int").alias("label")).where("`␟id` is not null and label in (0, 1)").distinct()


def labelled(docs: DataFrame, labels: DataFrame, label: str, trusted: Column, most: int, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts with their label (1 or 0), at most ``most`` of each class, taken in the order of a hash of the id.

    ``trusted`` is a condition on the id column of ``labels``; rows that fail it, and
    null ids or labels, are never looked at.  Only ids are sorted; the ``2 * most`` ids
    are a proven bound for the broadcast.
    """
    rows = known(labels, label, trusted, id=id)
    order = F.xxhash64(F.col("␟id").cast("string"))
    ids = [rows.where(F.col("label") == value).orderBy(order, "␟id").limit(most) for value in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))
    texts = docs.select(named(id).alias("␟own"), named(text).cast("string").alias("text"))
    return texts.join(chosen, F.col("␟own") == F.col("␟id")).select(F.col("␟id").alias("id"), "text", "label")


@dataclass
class Logistic:
    """Weights over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30, counts: np.ndarray | None = None) -> Logistic:
        """Newton's method; both classes must occur or the weights only hold the (smoothed) share.

        A row counts ``counts`` times (once by default).
        """
        c = np.ones(len(x)) if counts is None else counts
        mean = np.average(x, 0, c)
        scale = np.sqrt(np.average((x - mean) ** 2, 0, c)) + 1e-9
        z = np.c_[(x - mean) / scale, np.ones(len(x))]
        w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-3]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (c * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (c * (y - p)) - penalty * w)
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1], -30, 30)))
