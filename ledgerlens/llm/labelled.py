"""Bounded samples of labelled documents, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text


def sample_ids(labels: DataFrame, label_col: str, usable: Column, per_class: int) -> DataFrame:
    """``(doc_id, label)``: for each of the labels 0 and 1 the ``per_class`` ids
    with the smallest hashes.  Ids with contradicting or null labels are left
    out; repeated rows count once."""
    one = (labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high"))
           .where("label = high").select("doc_id", "label"))
    order = F.xxhash64("doc_id", F.lit(11))
    return (one.where("label = 0").orderBy(order, "doc_id").limit(per_class)
            .union(one.where("label = 1").orderBy(order, "doc_id").limit(per_class)))


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int,
                   max_chars: int | None = None) -> DataFrame:
    """``(doc_id, text, label)`` of the sampled ids, at most ``2 * per_class``
    distinct ids, so that side is broadcast."""
    ids = sample_ids(labels, label_col, usable, per_class)
    docs = id_text(docs)
    if max_chars is not None:
        docs = docs.where(F.length("text") <= max_chars)
    return docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])


def label_counts(labels: DataFrame, label_col: str, usable: Column) -> dict[int, int]:
    """How many usable rows each of the labels 0 and 1 has."""
    rows = (labels.where(F.col(label_col).isin(0, 1) & usable).groupBy(F.col(label_col).cast("int").alias("label"))
            .count().collect())
    return {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3,
                 rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one
    is the intercept.  Without both classes the intercept alone is set."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    if len(y) == 0 or y.min() == y.max():
        w[-1] = 0.0 if len(y) == 0 else (2.0 if y[0] else -2.0)
        return w
    weight = np.ones(len(y)) if weight is None else weight / weight.mean()
    for _ in range(rounds):
        p = sigmoid(a @ w)
        grad = a.T @ (weight * (p - y)) / len(y) + ridge * np.r_[w[:-1], 0]
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))
