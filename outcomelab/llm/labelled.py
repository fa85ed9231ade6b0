"""What the classifiers of this subpackage share: folds of the labelled rows, a
bounded training draw and the logistic curve."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str) -> Column:
    """crc32(id as text) mod 5; rows of fold 0 are held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def training_draw(labels: DataFrame, label_id: str, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """((id, y, part) of at most ``per_class`` training rows of either class,
    those with the smallest id hash; the number of all training rows by class).
    ``part`` is the fold.  Labels other than 0 and 1 and null ids are left out;
    of contradicting labels of an id 1 counts."""
    known = (labels.where(F.col(label_id).isNotNull() & F.col(label).isin(0, 1) & (fold(label_id) != 0))
             .groupBy(F.col(label_id).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    known = known.withColumn("part", fold("__id"))
    order = [F.xxhash64(F.col("__id").cast("string")), F.col("__id")]
    one = [known.where(F.col("y") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    return one[0].unionByName(one[1]), sizes


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """(slope of each column of ``x``, offset) by Newton steps with a small
    ridge on standardised columns."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd = np.where(sd > 0, sd, 1.0)
    a = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    ridge = np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slopes = beta[:-1] / sd
    return [float(s) for s in slopes], float(beta[-1] - slopes @ mean)


def prior_shift(known: dict[int, int], per_class: int) -> float:
    """What the offset of a curve fitted on the draw lacks, where the draw has
    thinned one class."""
    drawn = [min(per_class, known[c]) for c in (0, 1)]
    return float(np.log(known[1] / known[0]) - np.log(drawn[1] / drawn[0]))
