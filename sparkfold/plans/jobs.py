"""End-to-end jobs: train and register, load and evaluate."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.operators import checks
from sparkfold.operators.fit import fit
from sparkfold.operators.metrics import accuracy_column, classification_report, log_loss_column
from sparkfold.operators.models import Model
from sparkfold.operators.score import predict
from sparkfold.operators.specs import LogisticRegression
from sparkfold.operators.splits import train_test_split
from sparkfold.sources.models import StoredModel, load_model, save_model

SPLIT = "_is_test"


@dataclass
class TrainOutcome:
    stored: StoredModel
    report: DataFrame


def holdout_report(test: DataFrame, model: Model, label: str, id_col: str) -> DataFrame:
    """Report of a classifier on held-out rows, with log loss and the number of rows.

    The areas under the curves rank rows by the second class, so models of two classes have them;
    with more classes the report has the log loss over all of them and no areas. The scored rows
    are read by every part of the report, so narrow columns of them are kept for its duration.
    """
    if model.classes is None or len(model.classes) < 2 or model.kind == "majority":
        raise ValueError("train and evaluate jobs serve models with probabilities.")
    binary = len(model.classes) == 2
    scored = predict(test, model, "_prediction", proba="_proba")
    second = F.get("_proba", F.lit(1))
    # of two classes one probability tells the other
    kept_proba = second.alias("_score") if binary else F.col("_proba")
    kept = scored.select(id_col, label, "_prediction", kept_proba).persist(StorageLevel.MEMORY_AND_DISK)
    proba = F.array(1.0 - F.col("_score"), F.col("_score")) if binary else "_proba"
    columns = {
        "log_loss": log_loss_column(label, proba, model.classes),
        "n_test_samples": F.count(F.lit(1)),
    }
    ranked = {"score": "_score", "id_col": id_col} if binary else {}
    try:
        report = classification_report(kept, label, "_prediction", extra=columns, **ranked)
        return test.sparkSession.createDataFrame(report.collect(), report.schema)
    finally:
        kept.unpersist()


@contextmanager
def split_rows(
    df: DataFrame, names: Sequence[str], id_col: str, label: str, test_size: float, seed: int
) -> Iterator[DataFrame]:
    """The named columns with their part of the split, kept: the source is read once."""
    wanted = dict.fromkeys([id_col, label, *names])
    narrow = df.select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)
    split = None
    try:
        split = train_test_split(
            narrow, id_col, test_size=test_size, stratify=label, seed=seed, out=SPLIT
        ).persist(StorageLevel.MEMORY_AND_DISK)
        yield split
    finally:
        if split is not None:
            split.unpersist()
        narrow.unpersist()


def train_job(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    path: str,
    *,
    spec: LogisticRegression | None = None,
    test_size: float = 0.25,
    seed: int = 42,
    meta: Mapping | None = None,
) -> TrainOutcome:
    """Split, fit, report on the test part, store the model with its metrics."""
    spec = spec or LogisticRegression()
    spark = df.sparkSession
    names = [features] if isinstance(features, str) else list(features)
    checks.require_columns(df, features)
    with split_rows(df, names, id_col, label, test_size, seed) as split:
        train, test = split.filter(~F.col(SPLIT)), split.filter(SPLIT)
        model = fit(spec, train, features, label, id_col=id_col)
        on_test = holdout_report(test, model, label, id_col)
        found = predict(train, model, "_prediction").agg(
            accuracy_column(label, "_prediction").alias("train_accuracy"),
            F.count(F.lit(1)).alias("n_train_samples"),
        ).first()
    report = on_test.select(
        "*",
        F.col("accuracy").alias("test_accuracy"),
        F.lit(found["train_accuracy"]).alias("train_accuracy"),
        F.lit(found["n_train_samples"]).cast("long").alias("n_train_samples"),
    )
    named = {
        "training": {"seed": seed, "test_size": test_size, "id": id_col, "label": label},
        **(meta or {}),
    }
    metrics = report.first().asDict()
    return TrainOutcome(save_model(spark, model, path, named, metrics), report)


def evaluate_job(
    df: DataFrame,
    label: str,
    id_col: str,
    path: str,
    model_id: str,
    version: str,
    *,
    test_size: float = 0.25,
    seed: int = 42,
) -> DataFrame:
    """Report of a stored model on the test part of the same split."""
    stored = load_model(df.sparkSession, path, model_id, version)
    one = stored.model.features
    checks.require_columns(df, one)
    names = [one] if isinstance(one, str) else list(one)
    with split_rows(df, names, id_col, label, test_size, seed) as split:
        report = holdout_report(split.filter(SPLIT), stored.model, label, id_col)
    return report.withColumn("model_version", F.lit(stored.version))
