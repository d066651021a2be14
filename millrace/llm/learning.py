"""Bounded samples of labelled documents, and a small logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import texts


def class_sizes(labels: DataFrame, label: str, learnable: Column) -> dict[int, int]:
    """Number of labelled rows per class among those that may be learnt from."""
    usable = labels.where(learnable & F.col(label).isin(0, 1))
    return {int(r[0]): r[1] for r in usable.groupBy(label).count().collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learnable: Column, most: dict[int, int]) -> DataFrame:
    """doc_id, label, text of at most ``most[c]`` documents of class c, those whose doc_id has the
    smallest hash. Rows with a null doc_id or label are not learnt from; an id with several rows
    is taken once, with one of its texts; one text with many ids also counts once."""
    usable = labels.where(learnable & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    picked = None
    for value, n in most.items():
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        picked = part if picked is None else picked.unionAll(part)
    picked = picked.groupBy("doc_id").agg(F.max("label").alias("label"))
    # At most sum(most.values()) rows of two numbers: a bounded broadcast.
    return texts(docs).join(F.broadcast(picked), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (the constant last) by Newton steps with a ridge; needs both classes."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    keep = ridge * np.eye(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + keep @ w
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + keep
        step = np.linalg.solve(curvature, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w
