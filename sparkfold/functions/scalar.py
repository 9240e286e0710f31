"""Numerically safe maths as column expressions (no Python in the tasks)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfold.constants import COMPILED_WIDTH, LEAKY_SLOPE, LOGIT_CLIP, PROBABILITY_EPS


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def clip(value: Column, low: float, high: float) -> Column:
    """Value within bounds; NULL and NaN stay what they are (greatest and least would hide them)."""
    inside = F.greatest(F.least(value, F.lit(high)), F.lit(low))
    return F.when(value.isNull() | F.isnan(value.cast("double")), value).otherwise(inside)


def sigmoid(z: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(col(z), -LOGIT_CLIP, LOGIT_CLIP)))


def softmax(z: Column | str) -> Column:
    """Softmax of an array column."""

    def normalise(exps: Column) -> Column:
        return bind(
            F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e),
            lambda total: F.transform(exps, lambda e: e / total),
        )

    def shift(arr: Column) -> Column:
        return bind(
            F.array_max(arr),
            lambda top: bind(F.transform(arr, lambda v: F.exp(v - top)), normalise),
        )

    return bind(col(z), shift)


def softmax_of(logits: Sequence[Column]) -> Column:
    """Softmax over a known number of logit columns, free of lambdas so that it is compiled."""
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    exps = [F.exp(z - top) for z in logits]
    total = reduce(lambda a, b: a + b, exps)
    return F.array(*[e / total for e in exps])


def log_sum_exp(z: Column | str) -> Column:
    """log(sum(exp(z))) of an array column."""
    return bind(
        col(z),
        lambda arr: bind(
            F.array_max(arr),
            lambda top: top
            + F.log(F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))),
        ),
    )


def grouped_log_sum_exp(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """log(sum(exp(value))) per group in one shuffle.

    Every row is shifted by the floor of its own value to a multiple of the clip bound, so partial
    sums can be combined on the map side without knowing the group's maximum first; only the few
    (group, step) partial sums are shuffled, which also takes the weight off a hot group.
    """
    width = LOGIT_CLIP
    step = F.floor(F.col(value) / width)
    partial = df.groupBy(*by, step.alias("_step")).agg(
        F.sum(F.exp(F.col(value) - step * width)).alias("_part")
    )
    top = F.max("_step").over(Window.partitionBy(*by))
    scaled = F.col("_part") * F.exp((F.col("_step") - F.col("_top")) * width)
    return (
        partial.withColumn("_top", top)
        .groupBy(*by)
        .agg((F.max("_top") * width + F.log(F.sum(scaled))).alias(out))
    )


def clip_probability(p: Column | str, eps: float = PROBABILITY_EPS) -> Column:
    if not 0.0 < eps < 0.5:
        raise ValueError("eps must lie strictly between 0 and 0.5.")
    return clip(col(p), eps, 1.0 - eps)


def one_hot(index: Column | str, n_classes: int) -> Column:
    """Array of zeros with a one at ``index``; an index outside 0..n_classes-1 is an error."""
    i = col(index)
    row = F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda k: (k == i).cast("double")
    )
    return F.when(
        i.isNull() | (i < 0), F.raise_error(F.lit("a label index has to be a non-negative number.")).cast("array<double>")
    ).when(
        i >= n_classes,
        F.raise_error(F.lit("n_classes must exceed the largest label.")).cast("array<double>"),
    ).otherwise(row)


def squared_l2_norm(arr: Column | str) -> Column:
    return F.aggregate(col(arr), F.lit(0.0), lambda acc, v: acc + v * v)


def l2_norm(arr: Column | str) -> Column:
    return F.sqrt(squared_l2_norm(arr))


def column_l2_norm(value: Column | str) -> Column:
    """Euclidean norm over all rows (aggregate)."""
    return F.sqrt(F.sum(col(value) * col(value)))


def activation(name: str, z: Column) -> Column:
    """One hidden-layer activation applied to a scalar column."""
    if name == "relu":
        return F.when(z.isNull() | (z > 0.0), z).otherwise(F.lit(0.0))  # NULL and NaN stay
    if name == "leaky_relu":
        return F.when(z > 0.0, z).otherwise(z * LEAKY_SLOPE)
    if name == "sigmoid":
        return sigmoid(z)
    if name == "tanh":
        return F.tanh(z)
    raise ValueError(f"unknown activation {name!r}; known: relu, leaky_relu, sigmoid, tanh.")


def activate(name: str, arr: Column | str) -> Column:
    """The same activation applied to every entry of an array column."""
    return F.transform(col(arr), lambda z: activation(name, z))


def sql_number(value: float) -> str:
    """A double literal in SQL."""
    return f"({float(value)!r}D)"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def linear_score(
    features: Sequence[str] | str, weights: Sequence[float], bias: float = 0.0
) -> Column:
    """w·x + b over separate feature columns or over one array column.

    A plain sum of products is compiled with the rest of the stage; it is handed over as SQL text,
    since a long sum built operator by operator costs a call for each. Only a wide array is folded.
    """
    w = [float(v) for v in weights]
    if isinstance(features, str) and len(w) > COMPILED_WIDTH:
        products = F.zip_with(
            F.col(features), F.array(*[F.lit(v) for v in w]), lambda x, v: x * v
        )
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v) + F.lit(float(bias))
    if isinstance(features, str):
        inputs = [f"double(get({sql_name(features)}, {i}))" for i in range(len(w))]
    else:
        inputs = [sql_name(name) for name in features]
    terms = [f"{x} * {sql_number(v)}" for x, v in zip(inputs, w, strict=True)]
    return F.expr(" + ".join([*terms, sql_number(bias)]))


def dense(inputs: Sequence[Column], weights, bias) -> list[Column]:
    """Dense layer over scalar columns: one column per unit, ``weights`` is inputs x units."""
    units = len(bias)
    return [
        reduce(
            lambda a, b: a + b,
            [x * F.lit(float(weights[i][k])) for i, x in enumerate(inputs)],
        )
        + F.lit(float(bias[k]))
        for k in range(units)
    ]


def dense_array(arr: Column | str, weights, bias) -> Column:
    """Dense layer on an array column."""
    x = col(arr)
    units = []
    for k in range(len(bias)):
        w = F.array(*[F.lit(float(row[k])) for row in weights])
        dot = F.aggregate(
            F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
        )
        units.append(dot + F.lit(float(bias[k])))
    return F.array(*units)


def first_argmax(arr: Column | str) -> Column:
    """0-based position of the first maximum of an array column."""
    return bind(
        col(arr), lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("int")
    )


def finite(value: Column | str, message: str) -> Column:
    """The value as a double; NULL, NaN and infinities are errors."""
    v = col(value)
    return F.when(is_violation(v), F.raise_error(F.lit(message)).cast("double")).otherwise(
        v.cast("double")
    )


def is_violation(value: Column) -> Column:
    """NULL, NaN and infinities are all violations for numbers."""
    v = value.cast("double")
    return v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf))


def as_class(value: Column | str) -> Column:
    """Labels are compared as integers, truncated toward zero; a missing label is an error."""
    label = col(value)
    bad = F.raise_error(F.lit("a label or prediction is missing or not finite.")).cast("long")
    return F.when(is_violation(label), bad).otherwise(label.cast("long"))
