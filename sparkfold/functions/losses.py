"""Losses as aggregate columns; the caller decides the grouping."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.functions.scalar import clip_probability, col, finite

BAD_TARGET = "a target is missing or not finite."
BAD_PREDICTION = "a prediction is missing or not finite."
BAD_PROBABILITY = "a probability is missing or not finite."
BAD_INDEX = "a class index has no probability."
PENALTIES = ("l1", "l2", None)


def positive_total(total: Column) -> Column:
    """The weight total, or an error when it is not positive."""
    message = F.lit("sample weights must add up to a positive value.")
    return F.when(total > 0.0, total).otherwise(F.raise_error(message).cast("double"))


def weighted_mean(value: Column | str, weight: Column | str | None = None) -> Column:
    if weight is None:
        return F.avg(col(value))
    w = col(weight)
    return F.sum(col(value) * w) / positive_total(F.sum(w))


def squared_error(y: Column | str, prediction: Column | str) -> Column:
    gap = finite(y, BAD_TARGET) - finite(prediction, BAD_PREDICTION)
    return gap * gap


def binary_entropy(y: Column | str, p: Column | str) -> Column:
    """Per-row cross-entropy of a 0/1 target against a probability."""
    q = clip_probability(finite(p, BAD_PROBABILITY))
    t = finite(y, BAD_TARGET)
    return -(t * F.log(q) + (1.0 - t) * F.log(1.0 - q))


def class_entropy(index: Column | str, proba: Column | str) -> Column:
    """Per-row cross-entropy of a class index against an array of probabilities.

    A missing index, one without an entry, and an entry that is no finite number are errors.
    """
    i, arr = col(index).cast("int"), col(proba)
    known = F.coalesce((i >= 0) & (i < F.size(arr)), F.lit(False))
    entry = finite(F.get(arr, i), BAD_PROBABILITY)
    return -F.log(
        clip_probability(
            F.when(known, entry).otherwise(F.raise_error(F.lit(BAD_INDEX)).cast("double"))
        )
    )


def mse_loss(y, prediction, weight=None) -> Column:
    return weighted_mean(squared_error(y, prediction), weight)


def binary_cross_entropy(y, p, weight=None) -> Column:
    return weighted_mean(binary_entropy(y, p), weight)


def categorical_cross_entropy(index, proba, weight=None) -> Column:
    return weighted_mean(class_entropy(index, proba), weight)


def penalty_sum(weights: Sequence[float] | np.ndarray, penalty: str | None, strength: float):
    """Penalty before division by the number of rows (or the weight total)."""
    w = np.asarray(weights, dtype=float)
    if penalty not in PENALTIES:
        raise ValueError("penalty must be 'l1', 'l2', or None.")
    if penalty is None or strength == 0.0:
        return 0.0
    if penalty == "l2":
        return float(strength * np.square(w).sum() / 2.0)
    return float(strength * np.abs(w).sum())


def objective(
    df: DataFrame,
    row_loss: Column,
    weights: Sequence[float],
    *,
    penalty: str | None = None,
    strength: float = 0.0,
    weight: Column | str | None = None,
    out: str = "objective",
) -> DataFrame:
    """Penalised objective of one parameter vector over a table (biases are not penalised)."""
    total = F.count(F.lit(1)).cast("double") if weight is None else F.sum(col(weight))
    return df.agg(
        (
            weighted_mean(row_loss, weight)
            + F.lit(penalty_sum(weights, penalty, strength)) / total
        ).alias(out)
    )
