"""Labelled rows for training, and a plain logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import held_out


def training_sample(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most about ``most`` labelled rows that are not held out.

    Rows whose ``crc32`` of the id leaves 0 when divided by 5 are never among them, nor are
    rows without a label or id. Which rows are taken depends on a hash of the id alone. The
    ids, of bounded number, are sent to all tasks; the texts are not shuffled.
    """
    usable = labels.filter(
        F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    ).select("doc_id", F.col(label).cast("int").alias("label")).dropDuplicates(["doc_id"])
    total = usable.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if total > most:
        share = int(most / total * 1_000_000)
        usable = usable.filter(F.pmod(F.xxhash64(F.lit("training"), "doc_id"), F.lit(1_000_000)) < share)
    return documents.select("doc_id", "text").join(F.broadcast(usable), "doc_id")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights, the intercept last, of a logistic fit by Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(design.shape[1])
    penalty = np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(design @ weights)
        gradient = design.T @ (p - y) + penalty * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        move = np.linalg.solve(hessian, gradient)
        weights -= move
        if np.abs(move).max() < 1e-8:
            break
    return weights


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
