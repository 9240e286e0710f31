"""Model table: fitted models as rows, pruned by (model_id, version) when one is loaded.

``<path>/parameters`` (param, idx, value), ``<path>/metadata`` (metadata, metrics as JSON) and
``<path>/history`` are Parquet tables partitioned by model_id and version. Writing a version again
replaces that version only.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfold.constants import MODEL_SCHEMA_VERSION
from sparkfold.operators.models import Model
from sparkfold.operators.updates import HISTORY_SCHEMA

KINDS = (
    "mean", "majority", "linear", "logistic", "softmax", "mlp_classifier", "mlp_regressor",
)
KEYS = ["model_id", "version"]
PARAMETERS = "model_id string, version string, param string, idx array<int>, value double"
METADATA = "model_id string, version string, metadata string, metrics string"


@dataclass
class StoredModel:
    model: Model
    metadata: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)

    @property
    def version(self) -> str:
        return str(self.metadata["version"])


def describe(model: Model, meta: Mapping | None = None) -> dict:
    """Metadata of a model. The caller may name and version it; what describes the model itself
    always comes from the model."""
    now = datetime.now(UTC).isoformat()
    own = {
        "schema_version": MODEL_SCHEMA_VERSION,
        "model_type": model.kind,
        "n_features": model.n_features,
        "features": model.features,
        "classes": model.classes,
        "hyperparameters": model.settings,
    }
    defaults = {"model_name": "sparkfold-model", "version": now, "created_at": now}
    fitted = {"converged": model.converged}
    return {**defaults, **fitted, **(meta or {}), **own}


def parameter_rows(model: Model, model_id: str, version: str) -> list[tuple]:
    return [
        (model_id, version, name, list(idx), float(value))
        for name, values in model.params.items()
        for idx, value in np.ndenumerate(np.asarray(values, dtype=float))
    ]


def _write(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*KEYS)
        .parquet(path)
    )


def save_models(spark: SparkSession, stored: Sequence[StoredModel], path: str) -> None:
    """Store any number of models in one write per table."""
    parameters, metadata, history = [], [], []
    for item in stored:
        name, version = str(item.metadata["model_name"]), item.version
        parameters += parameter_rows(item.model, name, version)
        metadata.append(
            (name, version, json.dumps(item.metadata), json.dumps(item.metrics, default=str))
        )
        history += [(name, version, *row) for row in item.model.history_rows]
    _write(spark.createDataFrame(parameters, PARAMETERS), f"{path}/parameters")
    _write(
        spark.createDataFrame(history, f"model_id string, version string, {HISTORY_SCHEMA}"),
        f"{path}/history",
    )
    # the metadata comes last: a model without it does not exist yet
    _write(spark.createDataFrame(metadata, METADATA), f"{path}/metadata")


def save_model(
    spark: SparkSession,
    model: Model,
    path: str,
    meta: Mapping | None = None,
    metrics: Mapping | None = None,
) -> StoredModel:
    stored = StoredModel(model, describe(model, meta), dict(metrics or {}))
    save_models(spark, [stored], path)
    return stored


def _one_version(df: DataFrame, model_id: str, version: str) -> DataFrame:
    return df.filter((F.col("model_id") == model_id) & (F.col("version") == version))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no model table at {path}.") from error


def check_metadata(metadata: Mapping) -> None:
    found = metadata.get("schema_version")
    if found != MODEL_SCHEMA_VERSION:
        raise ValueError(f"model schema version {found} is not {MODEL_SCHEMA_VERSION}.")
    if metadata.get("model_type") not in KINDS:
        raise ValueError(f"unknown model type {metadata.get('model_type')!r}.")
    if "hyperparameters" not in metadata:
        raise ValueError("the model metadata has no hyperparameters.")


def load_model(spark: SparkSession, path: str, model_id: str, version: str) -> StoredModel:
    """Load one version of a model and check that it can be scored."""
    rows = _one_version(_read(spark, f"{path}/metadata", METADATA), model_id, version).collect()
    if not rows:
        raise ValueError(f"no version {version!r} of model {model_id!r}.")
    metadata = json.loads(rows[0]["metadata"])
    check_metadata(metadata)
    values = _one_version(_read(spark, f"{path}/parameters", PARAMETERS), model_id, version)
    history = _one_version(
        _read(spark, f"{path}/history", f"model_id string, version string, {HISTORY_SCHEMA}"),
        model_id, version,
    ).drop(*KEYS).orderBy("epoch")
    settings = dict(metadata["hyperparameters"])
    if isinstance(settings.get("class_weight"), dict):
        settings["class_weight"] = {int(k): v for k, v in settings["class_weight"].items()}
    model = Model(
        metadata["model_type"],
        metadata["features"],
        metadata["n_features"],
        _arrays(values.collect()),
        metadata["classes"],
        settings,
        [tuple(row) for row in history.collect()],
        metadata["converged"],
    )
    return StoredModel(model, metadata, json.loads(rows[0]["metrics"]))


def _arrays(rows) -> dict[str, np.ndarray]:
    grouped: dict[str, list] = {}
    for row in rows:
        grouped.setdefault(row["param"], []).append((tuple(row["idx"]), row["value"]))
    arrays = {}
    for name, cells in grouped.items():
        shape = tuple(np.max([idx for idx, _ in cells], axis=0) + 1)
        arrays[name] = np.zeros(shape)
        for idx, value in cells:
            arrays[name][idx] = value
    return arrays
