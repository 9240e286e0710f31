"""A fitted model: parameter-sized state on the driver, scoring as columns over a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from sparkfold.operators.updates import HISTORY_SCHEMA

CLASSIFIER_KINDS = ("majority", "logistic", "softmax", "mlp_classifier")


@dataclass
class Model:
    kind: str
    features: list[str] | str
    n_features: int
    params: dict[str, np.ndarray]
    classes: list[int] | None = None
    settings: dict = field(default_factory=dict)
    history_rows: list[tuple] = field(default_factory=list)
    converged: bool = True

    @property
    def is_classifier(self) -> bool:
        return self.kind in CLASSIFIER_KINDS

    @property
    def n_iter(self) -> int:
        return len(self.history_rows)

    def history(self, spark: SparkSession) -> DataFrame:
        """(epoch, train_loss, val_loss, grad_norm, param_norm, learning_rate)."""
        return spark.createDataFrame(self.history_rows, HISTORY_SCHEMA)

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(weights, bias) per layer; linear models have one layer."""
        if "weights" in self.params:
            weights = np.atleast_1d(self.params["weights"])
            if weights.ndim == 1:
                weights = weights[:, None]
            return [(weights, np.atleast_1d(self.params["bias"]))]
        count = sum(name.endswith(".weights") for name in self.params)
        return [
            (self.params[f"{i}.weights"], self.params[f"{i}.bias"]) for i in range(count)
        ]


def feature_names(features: Sequence[str] | str) -> list[str] | str:
    return features if isinstance(features, str) else list(features)
