"""Data checks: all checks on a dataset are counted in one aggregate pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.constants import MAX_CLASSES
from sparkfold.functions.scalar import is_violation

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integer(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, INTEGER_TYPES)


def is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)


def bad_features(features: Sequence[str] | str) -> Column:
    """True for a row with a missing, NaN or infinite feature."""
    if isinstance(features, str):
        arr = F.col(features)
        return arr.isNull() | F.exists(arr, is_violation)
    bad = F.lit(False)
    for name in features:
        bad = bad | is_violation(F.col(name))
    return bad


def feature_checks(features: Sequence[str] | str) -> dict[str, Column]:
    """V1 as aggregates."""
    if not isinstance(features, str) and not features:
        raise ValueError("name at least one feature.")
    checks = {"n_rows": F.count(F.lit(1)), "bad_features": F.count_if(bad_features(features))}
    if isinstance(features, str):
        checks["min_width"] = F.min(F.size(features))
        checks["max_width"] = F.max(F.size(features))
    return checks


def target_checks(label: str) -> dict[str, Column]:
    """V2 as aggregates."""
    return {"bad_targets": F.count_if(is_violation(F.col(label)))}


def binary_checks(label: str) -> dict[str, Column]:
    """V3 as aggregates."""
    outside = F.coalesce(~F.col(label).isin(0, 1), F.lit(True))
    return {"not_binary": F.count_if(outside)}


def class_checks(label: str) -> dict[str, Column]:
    """V4 as aggregates: two distinct labels exist when the least differs from the greatest."""
    return {"min_label": F.min(label), "max_label": F.max(label)}


def weight_checks(weight: str) -> dict[str, Column]:
    """V5 as aggregates."""
    w = F.col(weight).cast("double")
    return {
        "bad_weights": F.count_if(is_violation(w)),
        "negative_weights": F.count_if(w < 0.0),
        "weight_total": F.sum(w),
    }


def width_checks(features: str, width: int) -> dict[str, Column]:
    """V6 for an array column as aggregates."""
    return {"wrong_width": F.count_if(F.coalesce(F.size(features) != width, F.lit(True)))}


def probability_checks(
    proba: str, label: str, labels: Sequence[int], *, single: bool = False
) -> dict[str, Column]:
    """V7 as aggregates; ``single`` means one probability of the second label per row."""
    known = F.col(label).cast("long").isin(*[int(v) for v in labels])
    checks = {"unknown_labels": F.count_if(F.coalesce(~known, F.lit(True)))}
    if single:
        p = F.col(proba)
        checks["bad_probabilities"] = F.count_if(is_violation(p))
        checks["outside_unit"] = F.count_if((p < 0.0) | (p > 1.0))
        checks["too_few_columns"] = F.lit(0 if len(labels) <= 2 else 1).cast("long")
    else:
        arr = F.col(proba)
        checks["bad_probabilities"] = F.count_if(arr.isNull() | F.exists(arr, is_violation))
        checks["outside_unit"] = F.count_if(F.exists(arr, lambda p: (p < 0.0) | (p > 1.0)))
        checks["too_few_columns"] = F.count_if(F.size(arr) < len(labels))
    return checks


def unknown_labels(df: DataFrame, label: str, known: DataFrame, known_label: str) -> DataFrame:
    """Distinct labels of ``df`` that are missing from a table of known labels."""
    seen = df.select(F.col(label).cast("long").alias("label")).distinct()
    allowed = known.select(F.col(known_label).cast("long").alias("label"))
    return seen.join(allowed, "label", "left_anti")


def check_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with every requested count, from a single pass."""
    return df.agg(*[value.alias(name) for name, value in checks.items()])


# What to say when a count is not zero.
MESSAGES = {
    "bad_features": "a feature is missing, NaN or infinite.",
    "bad_targets": "a target is missing, NaN or infinite.",
    "not_binary": "binary targets must be 0 or 1.",
    "bad_weights": "a sample weight is missing, NaN or infinite.",
    "negative_weights": "sample_weight must not be negative.",
    "wrong_width": "X has a different number of features than the fitted model.",
    "bad_probabilities": "a probability is missing, NaN or infinite.",
    "outside_unit": "y_proba must lie between 0 and 1.",
    "too_few_columns": "y_proba needs a column for each class label.",
    "unknown_labels": "y_true has labels that are not in the label list.",
}


def require(df: DataFrame, checks: dict[str, Column]) -> dict:
    """Run the checks and raise on the first violation; returns the counts."""
    row = check_counts(df, checks).first().asDict()
    judge(row)
    return row


def judge(row: dict) -> None:
    """Raise on the first violation among the counts."""
    if row.get("n_rows") == 0:
        raise ValueError("at least one sample is needed.")
    for name, message in MESSAGES.items():
        if row.get(name):
            raise ValueError(f"{message} ({row[name]} rows)")
    if "min_width" in row:
        if row["min_width"] != row["max_width"]:
            raise ValueError("X must have the same number of features in every row.")
        if row["min_width"] == 0:
            raise ValueError("arrays hold at least one feature.")
    if "min_label" in row and row["min_label"] == row["max_label"]:
        raise ValueError("classification needs at least two classes.")
    if "weight_total" in row and not row["weight_total"] > 0.0:
        raise ValueError("sample weights must add up to a positive value.")


def require_class_type(df: DataFrame, label: str) -> None:
    if not is_integer(df, label):
        raise ValueError("class labels must have an integer type.")


def require_columns(df: DataFrame, features: Sequence[str] | str) -> None:
    """V6 for separate columns: the columns seen while fitting must be there, as numbers."""
    names = [features] if isinstance(features, str) else list(features)
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"X lacks features of the fitted model: {missing}.")
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(features, str):
            kind = kind.elementType if isinstance(kind, T.ArrayType) else T.StringType()
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"feature {name!r} is not numeric.")


def _class_rows(df: DataFrame, label: str, by: Sequence[str], extra: Sequence[Column]) -> list:
    """(by..., label, n, extra...) rows; refuses a column with more labels than a class table may
    hold, so what reaches the driver is bounded."""
    counts = df.groupBy(*by, F.col(label).cast("long").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), *extra
    )
    rows = counts.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} labels; it is not a class label.")
    return rows


def count_classes(df: DataFrame, label: str, *by: str) -> list:
    """(by..., label, n) rows, sorted."""
    return sorted(_class_rows(df, label, by, []), key=lambda r: tuple(r[:-1]))


def require_by_class(
    df: DataFrame, checks: dict[str, Column], label: str, *by: str
) -> tuple[dict, list]:
    """Checks and class counts from the same pass: the checks are counted per class and added up."""
    rows = _class_rows(df, label, by, [c.alias(name) for name, c in checks.items()])
    total: dict = {"n_rows": 0}
    for name in checks:
        values = [row[name] for row in rows if row[name] is not None]
        add = {"min_width": min, "max_width": max}.get(name, sum)
        total[name] = add(values) if values else 0
    judge(total)
    return total, rows
