"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words is trained from confirmed toxic texts (P) and unlabelled text (U).
With the class prior p the risk is p R_P(+) + max(0, R_U(-) - p R_P(-)): the second term estimates
the risk on clean text from unlabelled text and is kept from going negative, where the model would
only fit the labelled examples. Training runs in numpy on a bounded sample; scoring runs on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets of words.
SIZE = 1 << 18
#: What separates words here: anything but letters and digits.
OTHER = r"[^\p{L}\p{N}]+"


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def features(text: Column) -> Column:
    """Distinct hash buckets of the lower-case words of a text and of their first 4 and 5 letters."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), OTHER), lambda w: w != "")
    found = F.array_distinct(found)
    parts = [F.transform(found, lambda w: _bucket(w))]
    for k in (4, 5):
        long_enough = F.filter(found, lambda w, k=k: F.length(w) >= k)
        parts.append(
            F.transform(long_enough, lambda w, k=k: _bucket(F.lit(k), F.substring(w, 1, k)))
        )
    return F.array_distinct(F.concat(*parts))


def _bucket(*values: Column) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(SIZE)).cast("int")


def _first_by_hash(ids: DataFrame, limit: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def sample(
    docs: DataFrame, positive: DataFrame, max_positive: int, max_unlabelled: int
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Features of at most so many positive and unlabelled documents, chosen by hash of their id."""
    known = docs.select("doc_id").where("doc_id IS NOT NULL")
    p = _first_by_hash(positive.select("doc_id").distinct(), max_positive)
    u = _first_by_hash(known, max_unlabelled)
    # at most max_positive + max_unlabelled ids
    ids = p.withColumn("is_p", F.lit(True)).unionByName(u.withColumn("is_p", F.lit(False)))
    rows = (
        docs.join(F.broadcast(ids), "doc_id")
        .select("is_p", "doc_id", features(F.col("text")).alias("f"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("is_p", "ascending")])
    )
    lists = rows.column("f").combine_chunks()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    parts = [values[a:b] for a, b in zip(offsets, offsets[1:])]
    is_p = rows.column("is_p").to_pylist()
    return (
        [x for x, yes in zip(parts, is_p) if yes],
        [x for x, yes in zip(parts, is_p) if not yes],
    )


def _scores(weights: np.ndarray, bias: float, rows: list[np.ndarray]) -> np.ndarray:
    sizes = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    return bias + np.bincount(owner, weights[flat], minlength=len(rows))


def _gradient(rows: list[np.ndarray], slope: np.ndarray, size: int) -> np.ndarray:
    sizes = np.array([len(r) for r in rows])
    return np.bincount(np.concatenate(rows), np.repeat(slope, sizes), minlength=size)


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    *,
    epochs: int = 120,
    batches: int = 3,
    rate: float = 0.02,
    decay: float = 1e-3,
    sparse: float = 0.1,
    least: int = 5,
    seed: int = 7,
) -> Model:
    """Fit the weights by Adam on the non-negative risk with logistic loss.

    ``sparse`` and ``decay`` are the L1 and L2 penalties: with few positive examples most words are
    noise. Only buckets of at least ``least`` positive examples get a weight. Where the clean part of the
    risk is negative, the step goes against its gradient instead, which undoes the over-fit.
    """
    weights, bias = np.zeros(SIZE), float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(weights.astype(np.float32), bias)
    seen = np.bincount(np.concatenate(positive), minlength=SIZE)
    keep = np.flatnonzero(seen >= min(least, max(1, len(positive) // 4)))
    place = np.full(SIZE, -1)
    place[keep] = np.arange(len(keep))
    small = [[x[x >= 0] for x in (place[r] for r in rows)] for rows in (positive, unlabelled)]
    size = len(keep)
    w = np.zeros(size + 1)  # the last one is the bias
    w[-1] = bias
    m, v, step = np.zeros(size + 1), np.zeros(size + 1), 0
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        orders = [np.array_split(draw.permutation(len(r)), batches) for r in small]
        for take_p, take_u in zip(*orders):
            if not len(take_p) or not len(take_u):
                continue
            p, u = [small[0][i] for i in take_p], [small[1][i] for i in take_u]
            zp, zu = _scores(w[:-1], w[-1], p), _scores(w[:-1], w[-1], u)
            # loss(+) = log(1 + e^-z), loss(-) = log(1 + e^z)
            sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            plus_p = prior * (sp - 1) / len(p)
            minus_p, minus_u = -prior * sp / len(p), su / len(u)
            if clean >= 0:
                slope_p, slope_u = plus_p + minus_p, minus_u
            else:
                slope_p, slope_u = -minus_p, -minus_u
            g = np.zeros(size + 1)
            g[:-1] = _gradient(p, slope_p, size) + _gradient(u, slope_u, size) + decay * w[:-1]
            g[-1] = slope_p.sum() + slope_u.sum()
            step += 1
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - rate * sparse, 0)
    weights[keep] = w[:-1]
    return Model(weights.astype(np.float32), float(w[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    prior: float | None = None,
    max_positive: int = 4_000,
    max_unlabelled: int = 16_000,
) -> Model:
    """Train on docs (doc_id, text) with the confirmed toxic ids of labels (doc_id, toxic).

    Every text counts as unlabelled, whatever its label. The sample holds at most ``max_positive``
    and ``max_unlabelled`` documents. Without a prior, the share of toxic labels is taken. NULL ids
    and labels are ignored; without any toxic label the model has no weight and answers the prior.
    """
    said = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if prior is None:
        share = said.agg(F.avg("toxic")).first()[0]
        prior = 0.01 if share is None else share
    prior = min(max(prior, 1e-3), 0.999)
    texts = docs.select("doc_id", "text")
    return train(*sample(texts, said.where("toxic = 1"), max_positive, max_unlabelled), prior)


def _scored(rows: DataFrame, name: str, model) -> DataFrame:
    """(name, score) of rows (name, f); the model is a broadcast value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            lists = batch.column(1)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            z = bias + np.bincount(
                owner, weights[flat[offsets[0] : offsets[-1]]], minlength=batch.num_rows
            )
            done = pa.array(1 / (1 + np.exp(-z)))
            yield pa.RecordBatch.from_arrays([batch.column(0), done], [name, "score"])

    kind = rows.schema[name].dataType.simpleString()
    return rows.mapInArrow(run, f"{name} {kind}, score double")


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with a column `score`: the probability of toxicity of every whole text.

    One row per row of docs, all columns kept (a column named score is replaced). NULL and empty
    texts get the score of no words; nothing but the text is read.
    """
    names = [c for c in docs.columns if c != "score"]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    rows = whole.select("row", features(F.col("row.text")).alias("f"))
    scored = _scored(rows, "row", docs.sparkSession.sparkContext.broadcast(model))
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in names], "score")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of docs (doc_id, text); see with_score."""
    rows = docs.select("doc_id", features(F.col("text")).alias("f"))
    return _scored(rows, "doc_id", docs.sparkSession.sparkContext.broadcast(model))
