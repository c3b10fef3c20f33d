"""Shared by the classifiers: labelled samples and sparse batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import bounded_sample


def labelled(docs: DataFrame, labels: DataFrame, target: str, learn_on: Column, per_class: int,
             id_col: str = "doc_id") -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample of learning rows with ``__y``, and the number of labelled rows
    of each class among all. ``learn_on`` is a condition on the labels' id. An id with
    several labels counts once, with its largest; null labels and ids are left out. The
    sample's ids, about 2 * per_class at most, are broadcast; texts are not shuffled."""
    rows = labels.filter(F.col(target).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        (F.max(target) > 0).cast("int").alias("__y")).filter(learn_on)
    sizes = {int(r["__y"]): int(r["n"]) for r in rows.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = bounded_sample(rows, "__y", id_col, per_class).withColumnRenamed(id_col, "__label_id")
    # proven bound: a sample of at most about per_class rows of two classes
    found = docs.join(F.broadcast(sample), docs[id_col] == F.col("__label_id")).drop("__label_id")
    return found, sizes


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def scores_of(z: np.ndarray) -> np.ndarray:
    """Probabilities, rounded so that a score doesn't depend on its batch."""
    return np.round(sigmoid(z), 6)


def prior_shift(sizes: dict[int, int], sampled: dict[int, int]) -> float:
    """What a bias learnt on the sample lacks to fit the classes' shares of all rows."""
    if not all(sizes.get(c) and sampled.get(c) for c in (0, 1)):
        return 0.0
    return float(np.log(sizes[1] / sizes[0]) - np.log(sampled[1] / sampled[0]))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]`` (0 for empty rows)."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[first[1:]] - total[first[:-1]]
