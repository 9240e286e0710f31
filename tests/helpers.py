"""Small tables for tests: every row has an explicit id, since order matters."""

import contextlib

import pytest


def rows_cls(spark, points, labels):
    rows = [(i, [float(v) for v in p], int(y)) for i, (p, y) in enumerate(zip(points, labels))]
    return spark.createDataFrame(rows, "id long, features array<double>, label int").coalesce(1)


def rows_reg(spark, points, targets, weights=None):
    weights = [1.0] * len(points) if weights is None else weights
    rows = [
        (i, [float(v) for v in p], float(y), float(w))
        for i, (p, y, w) in enumerate(zip(points, targets, weights))
    ]
    return spark.createDataFrame(
        rows, "id long, features array<double>, label double, weight double"
    ).coalesce(1)


def rows_pred(spark, y_true, y_pred):
    rows = [(i, t, p) for i, (t, p) in enumerate(zip(y_true, y_pred))]
    kind = "double" if any(isinstance(v, float) for v in [*y_true, *y_pred]) else "int"
    return spark.createDataFrame(rows, f"id long, y_true {kind}, y_pred {kind}")


def rows_score(spark, y_true, score):
    rows = [(i, t, float(s)) for i, (t, s) in enumerate(zip(y_true, score))]
    return spark.createDataFrame(rows, "id long, y_true int, score double")


@contextlib.contextmanager
def spark_error(message):
    """An error raised inside a Spark job."""
    with pytest.raises(Exception) as caught:
        yield
    assert message in str(caught.value)
