"""Scoring: predictions as columns over a table or a stream."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.constants import COMPILED_WIDTH
from sparkfold.functions.scalar import (
    activation,
    dense,
    first_argmax,
    is_violation,
    linear_score,
    sigmoid,
    softmax_of,
    sql_name,
)
from sparkfold.operators import checks
from sparkfold.operators.metrics import accuracy, regression_metric
from sparkfold.operators.models import Model
from sparkfold.operators.network import predict as predict_block
from sparkfold.operators.passes import feature_columns, matrix

EXPRESSION_PARAMETERS = 512  # larger models are scored with NumPy on Arrow batches


def outputs(model: Model) -> list[Column]:
    """Raw outputs of a small model as compiled expressions (logits or values)."""
    layers = model.layers()
    if len(layers) == 1:
        weights, bias = layers[0]
        return [
            linear_score(model.features, weights[:, k], bias[k]) for k in range(len(bias))
        ]
    names = model.features
    if isinstance(names, str):
        values = [F.get(names, F.lit(i)) for i in range(model.n_features)]
    else:
        values = [F.col(name) for name in names]
    for weights, bias in layers[:-1]:
        values = [
            activation(model.settings["activation"], z) for z in dense(values, weights, bias)
        ]
    return dense(values, *layers[-1])


def _label_column(model: Model, index: Column) -> Column:
    known = F.array(*[F.lit(int(c)).cast("long") for c in model.classes])
    return F.get(known, index)


def n_parameters(model: Model) -> int:
    return sum(int(np.size(value)) for value in model.params.values())


def invalid_rows(model: Model) -> Column:
    """True for a row that must not be scored: a feature is missing, NaN or infinite, or an array
    has another width. For narrow arrays the test is one compiled sum, since zero times any such
    value is not zero."""
    names = model.features
    if not isinstance(names, str):
        return checks.bad_features(names)
    arr = F.col(names)
    wrong = arr.isNull() | (F.size(arr) != model.n_features)
    if model.n_features > COMPILED_WIDTH:
        return wrong | F.exists(arr, is_violation)
    column = sql_name(names)
    zero = F.expr(
        " + ".join(f"double(get({column}, {i})) * 0D" for i in range(model.n_features))
    )
    return wrong | F.coalesce(zero != 0.0, F.lit(True)) | F.isnan(zero)


def _checked(df: DataFrame, model: Model) -> DataFrame:
    """Reject a table without the model's features, and every row that must not be scored.

    The test stands in a feature that every output reads, so both forms of scoring make it.
    """
    if model.kind in ("mean", "majority"):
        return df
    checks.require_columns(df, model.features)
    one = model.features if isinstance(model.features, str) else model.features[0]
    kind = (
        T.ArrayType(T.DoubleType()) if isinstance(model.features, str) else df.schema[one].dataType
    )
    message = "a feature is missing or not finite, or the number of features is not the model's."
    error = F.raise_error(F.lit(message)).cast(kind)
    return df.withColumn(
        one, F.when(invalid_rows(model), error).otherwise(F.col(one).cast(kind))
    )


INVALID = ("raise", "null")


def _masked(df: DataFrame, model: Model, out: str, proba: str | None) -> DataFrame:
    """Score every row in one pass; a row that must not be scored gets NULL outputs.

    Its features are replaced before they reach the model, in both forms of scoring, so the source
    and the test of its rows are read once. The row itself travels as it is.
    """
    checks.require_columns(df, model.features)
    bad = F.coalesce(invalid_rows(model), F.lit(True))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    if isinstance(model.features, str):
        zeros = F.array_repeat(F.lit(0.0), model.n_features)
        safe = [F.when(F.col("_bad"), zeros).otherwise(
            F.col(f"_row.`{model.features}`").cast("array<double>")).alias(model.features)]
    else:
        safe = [
            F.when(F.col("_bad"), F.lit(0.0)).otherwise(F.col(f"_row.`{c}`").cast("double")).alias(c)
            for c in model.features
        ]
    masked = df.select(row.alias("_row"), bad.alias("_bad")).select("_row", "_bad", *safe)
    scored = predict(masked, model, "_said", "_chance" if proba else None)
    added = {out: "_said"} | ({proba: "_chance"} if proba else {})
    own = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c not in added]
    return scored.select(
        *own, *[F.when(~F.col("_bad"), F.col(name)).alias(alias) for alias, name in added.items()]
    )


def predict_proba(df: DataFrame, model: Model, out: str = "probability") -> DataFrame:
    """Class probabilities, one array entry per class in ascending label order."""
    if not model.is_classifier or model.kind == "majority":
        raise ValueError(f"{model.kind} has no probabilities.")
    rows = _checked(df, model)
    if n_parameters(model) > EXPRESSION_PARAMETERS:
        return _arrow_outputs(rows, df, model, out)
    raw = outputs(model)
    if model.kind == "logistic":
        scored = rows.withColumn("_p", sigmoid(raw[0]))
        proba = F.array(1.0 - F.col("_p"), F.col("_p"))
        return scored.select(*df.columns, proba.alias(out))
    names = [f"_z{k}" for k in range(len(raw))]
    scored = rows.withColumns(dict(zip(names, raw, strict=True)))
    return scored.select(*df.columns, softmax_of([F.col(n) for n in names]).alias(out))


def _arrow_outputs(rows: DataFrame, df: DataFrame, model: Model, out: str) -> DataFrame:
    """Outputs of a large model: matrix products on Arrow batches, other columns untouched."""
    layers = model.layers()
    family = {"logistic": "logistic", "softmax": "softmax", "mlp_classifier": "softmax"}.get(
        model.kind, "linear"
    )
    name = model.settings.get("activation", "relu")
    columns, wide = feature_columns(model.features, model.n_features)
    names = ["_x"] if wide else [f"_x{i}" for i in range(model.n_features)]
    width, passed = model.n_features, df.columns
    single = model.kind in ("linear", "mlp_regressor")

    def run(batches):
        for batch in batches:
            result = predict_block(layers, name, family, matrix(batch, names, width))
            if single:
                column = pa.array(result[:, 0])
            else:
                if family == "logistic":
                    result = np.hstack([1.0 - result, result])
                count, k = result.shape
                offsets = pa.array(np.arange(count + 1, dtype=np.int32) * k)
                column = pa.ListArray.from_arrays(offsets, pa.array(result.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], column], names=[*passed, out]
            )

    source = rows.select(*passed, *columns)
    kind = T.DoubleType() if single else T.ArrayType(T.DoubleType())
    schema = rows.select(*passed).schema.add(out, kind)
    return source.mapInArrow(run, schema)


def decide(
    model: Model, proba: Column | str, threshold: float | None = None
) -> Column:
    """Predicted label from probabilities: the threshold for two classes in binary form, the
    first largest entry otherwise."""
    arr = F.col(proba) if isinstance(proba, str) else proba
    if model.kind == "logistic":
        cut = model.settings.get("threshold", 0.5) if threshold is None else threshold
        return _label_column(model, F.when(F.get(arr, F.lit(1)) >= cut, 1).otherwise(0))
    return _label_column(model, first_argmax(arr))


def predict(
    df: DataFrame,
    model: Model,
    out: str = "prediction",
    proba: str | None = None,
    *,
    invalid: str = "raise",
) -> DataFrame:
    """Predicted label or value; with ``proba`` also the probabilities, computed once.

    A missing or non-finite feature is an error; with ``invalid="null"`` such rows are kept with
    NULL outputs instead.
    """
    if invalid not in INVALID:
        raise ValueError(f"invalid must be one of {INVALID}.")
    if invalid == "null" and model.kind not in ("mean", "majority"):
        return _masked(df, model, out, proba)
    if model.kind == "majority":
        return df.withColumn(out, F.lit(int(model.params["label"][0])).cast("long"))
    if model.kind == "mean":
        return df.withColumn(out, F.lit(float(model.params["mean"][0])))
    if model.is_classifier:
        scored = predict_proba(df, model, proba or "_proba")
        decided = scored.withColumn(out, decide(model, proba or "_proba"))
        return decided if proba else decided.drop("_proba")
    rows = _checked(df, model)
    if n_parameters(model) > EXPRESSION_PARAMETERS:
        return _arrow_outputs(rows, df, model, out)
    return rows.withColumn("_out", outputs(model)[0]).select(*df.columns, F.col("_out").alias(out))


def score(df: DataFrame, model: Model, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Default score: accuracy of a classifier, R2 of a regressor."""
    scored = predict(df, model, "_prediction")
    if model.is_classifier:
        return accuracy(scored, label, "_prediction", by).withColumnRenamed("accuracy", "score")
    return regression_metric(scored, "r2", label, "_prediction", by=by).withColumnRenamed(
        "r2", "score"
    )


def score_batch(
    df: DataFrame,
    model: Model,
    version: str,
    *,
    per_class: bool = False,
    invalid: str = "raise",
) -> DataFrame:
    """Scored rows of a batch job: prediction, probability and model version.

    The probability is that of the second class, of two or of more; with ``per_class`` the array
    of all of them is added. Regressors and baselines have a prediction only.
    """
    if not model.is_classifier or model.kind == "majority":
        scored = predict(df, model, "prediction", invalid=invalid)
        return scored.withColumn("model_version", F.lit(version))
    scored = predict(df, model, "prediction", proba="_proba", invalid=invalid)
    if per_class:
        scored = scored.withColumn("probabilities", F.col("_proba"))
    return scored.withColumn("probability", F.get("_proba", F.lit(1))).drop("_proba").withColumn(
        "model_version", F.lit(version)
    )


def monitor_columns(n_features: int, probability: str = "probability") -> list[Column]:
    """What a scoring job logs about itself; rows without an output are in no range."""
    p = F.col(probability)
    return [
        F.count(F.lit(1)).alias("n_predictions"),
        F.lit(n_features).alias("n_features"),
        F.min(p).alias("probability_min"),
        F.avg(p).alias("probability_mean"),
        F.max(p).alias("probability_max"),
    ]


def score_monitor(
    scored: DataFrame, n_features: int, probability: str = "probability"
) -> DataFrame:
    """One row of monitoring values over scored rows."""
    return scored.agg(*monitor_columns(n_features, probability))


def write_scored(
    df: DataFrame, model: Model, version: str, path: str, *, invalid: str = "raise"
) -> dict:
    """Batch scoring job: store the scored rows and return the monitoring values, which are
    observed while the rows are written. Regressors are watched by their prediction."""
    watched = Observation()
    scored = score_batch(df, model, version, invalid=invalid)
    output = "probability" if "probability" in scored.columns else "prediction"
    scored = scored.observe(watched, *monitor_columns(model.n_features, output))
    scored.write.mode("overwrite").parquet(path)
    return watched.get
