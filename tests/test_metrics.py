import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_pred, rows_score, spark_error

from sparkfold.operators import metrics


def value(df):
    (row,) = df.collect()
    return row[0]


def by_hand(y, s):
    """Curve points and areas with a plain loop, ties in row order."""
    order = sorted(range(len(y)), key=lambda i: (-s[i], i))
    pos, neg = sum(y), len(y) - sum(y)
    tp = fp = 0
    roc, pr = [(0.0, 0.0)], [(0.0, 1.0)]
    for i in order:
        tp, fp = tp + y[i], fp + 1 - y[i]
        roc.append((fp / neg, tp / pos))
        pr.append((tp / pos, tp / (tp + fp)))

    def area(points):
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))

    return roc, pr, area(roc), area(pr)


def test_binary_labels(spark):
    df = rows_pred(spark, [0, 1, 1, 0], [0, 1, 0, 0])
    assert value(metrics.accuracy(df, "y_true", "y_pred")) == 0.75
    cells = metrics.confusion_matrix(df, "y_true", "y_pred").orderBy("y_true", "y_pred")
    assert [r["n"] for r in cells.collect()] == [2, 0, 1, 1]
    assert value(metrics.precision(df, "y_true", "y_pred")) == 1.0
    assert value(metrics.recall(df, "y_true", "y_pred")) == 0.5
    assert value(metrics.f1(df, "y_true", "y_pred")) == pytest.approx(2 / 3)


def test_three_classes_with_zero_division(spark):
    df = rows_pred(spark, [0, 1, 2, 2], [0, 0, 0, 2])
    assert value(metrics.precision(df, "y_true", "y_pred", average="macro")) == pytest.approx(
        (1 / 3 + 0 + 1) / 3
    )
    assert value(metrics.recall(df, "y_true", "y_pred", average="micro")) == 0.5
    weighted = value(metrics.f1(df, "y_true", "y_pred", average="weighted"))
    assert weighted == pytest.approx((0.5 * 1 + 0 * 1 + 2 / 3 * 2) / 4)
    with_one = value(
        metrics.precision(df, "y_true", "y_pred", average="macro", zero_division=1.0)
    )
    assert with_one == pytest.approx((1 / 3 + 1 + 1) / 3)


def test_labels_are_truncated(spark):
    df = rows_pred(spark, [-0.9, 1.7, 2.0], [0.2, 1.0, 1.9])
    assert value(metrics.accuracy(df, "y_true", "y_pred")) == pytest.approx(2 / 3)


def test_class_metric_errors(spark):
    df = rows_pred(spark, [0, 2], [0, 2])
    with spark_error("positive_label"):
        metrics.f1(df, "y_true", "y_pred").collect()
    with spark_error("labels must cover"):
        metrics.confusion_matrix(df, "y_true", "y_pred", labels=[0, 1]).collect()
    with pytest.raises(ValueError, match="average"):
        metrics.f1(df, "y_true", "y_pred", average="median")


def test_binary_scores(spark):
    df = rows_score(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    assert value(metrics.roc_auc(df, "y_true", "score", "id")) == 0.75
    assert value(metrics.pr_auc(df, "y_true", "score", "id")) == pytest.approx(
        (1 + 1) / 4 + (1 / 2 + 2 / 3) / 4
    )
    assert value(metrics.log_loss(df, "y_true", "score", [0, 1], single=True)) == pytest.approx(
        -np.mean(np.log([0.9, 0.6, 0.35, 0.8]))
    )


def test_ties_stay_in_id_order(spark):
    df = rows_score(spark, [1, 0, 1, 0], [0.5, 0.5, 0.8, 0.1])
    got = metrics.curve_areas(df, "y_true", "score", "id").first()
    assert (got["roc_auc"], got["pr_auc"]) == (1.0, 1.0)


@pytest.mark.parametrize("bucket_rows", [10**6, 11])
def test_curves_match_a_plain_loop(spark, bucket_rows):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300).tolist()
    # a third of the rows in one tie, and negative zero next to zero
    s = np.where(rng.random(300) < 0.33, 0.5, np.round(rng.normal(0, 1, 300), 1))
    s = np.where(np.abs(s) < 0.05, -0.0 * (rng.random(300) < 0.5), s).tolist()
    roc, pr, roc_area, pr_area = by_hand(y, s)
    df = rows_score(spark, y, s).repartition(5)
    got = metrics.curve_areas(df, "y_true", "score", "id", bucket_rows=bucket_rows).first()
    assert got["roc_auc"] == pytest.approx(roc_area, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(pr_area, abs=1e-12)
    curve = metrics.roc_curve(df, "y_true", "score", "id", bucket_rows=bucket_rows)
    points = curve.orderBy("point").collect()
    assert np.allclose([(r["fpr"], r["tpr"]) for r in points], roc)
    assert points[0]["threshold"] == max(s) + max(1.0, abs(max(s))) * 2.0**-52
    curve = metrics.pr_curve(df, "y_true", "score", "id", bucket_rows=bucket_rows)
    points = curve.orderBy("point").collect()
    assert np.allclose([(r["recall"], r["precision"]) for r in points], pr)


def test_curves_need_both_classes(spark):
    df = rows_score(spark, [1, 1], [0.1, 0.4])
    for run in (metrics.roc_auc, metrics.pr_auc, metrics.roc_curve, metrics.pr_curve):
        with spark_error("positive and negative"):
            run(df, "y_true", "score", "id").collect()


def test_log_loss_positions_and_errors(spark):
    df = spark.createDataFrame(
        [(5, [0.2, 0.7, 0.1]), (9, [0.1, 0.6, 0.3])], "y int, p array<double>"
    )
    # the second column belongs to label 9; rows are not renormalised, a third column is ignored
    assert value(metrics.log_loss(df, "y", "p", [5, 9])) == pytest.approx(
        -(math.log(0.2) + math.log(0.6)) / 2
    )
    with spark_error("not in the label list"):
        metrics.log_loss(df, "y", "p", [5, 7]).collect()
    with spark_error("column for each class label"):
        metrics.log_loss(df, "y", "p", [5, 9, 10, 11]).collect()
    for bad in (1.2, -0.2, float("nan")):
        with spark_error("between 0 and 1"):
            metrics.log_loss(
                df.withColumn("p", F.array(F.lit(bad), F.lit(0.5))), "y", "p", [5, 9]
            ).collect()


def test_only_one_label_observed(spark):
    # the label list decides the column, even when label 1 alone occurs
    df = spark.createDataFrame([(1, 0.9), (1, 0.8)], "y int, p double")
    assert value(metrics.log_loss(df, "y", "p", [0, 1], single=True)) == pytest.approx(
        -(math.log(0.9) + math.log(0.8)) / 2
    )


def test_regression(spark):
    df = rows_pred(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 4.0])
    got = metrics.regression_report(df, "y_true", "y_pred", n_features=1).first().asDict()
    assert got == pytest.approx({
        "mae": 1 / 3, "mse": 1 / 3, "rmse": math.sqrt(1 / 3), "r2": 0.5, "adjusted_r2": 0.0,
        "explained_variance": 2 / 3,
    })
    with spark_error("n_features + 1"):
        metrics.regression_metric(df, "adjusted_r2", "y_true", "y_pred", n_features=2).collect()


def test_constant_target(spark):
    same = rows_pred(spark, [0.1] * 3, [0.1] * 3)
    off = rows_pred(spark, [0.1] * 3, [0.1, 0.2, 0.1])
    shifted = rows_pred(spark, [0.1] * 3, [0.3] * 3)
    r2 = [value(metrics.regression_metric(d, "r2", "y_true", "y_pred")) for d in (same, off)]
    assert r2 == [1.0, 0.0]
    ev = [
        value(metrics.regression_metric(d, "explained_variance", "y_true", "y_pred"))
        for d in (same, off, shifted)
    ]
    assert ev == [1.0, 0.0, 1.0]


def test_report(spark):
    df = rows_score(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.4]).withColumn(
        "y_pred", (F.col("score") > 0.5).cast("int")
    )
    got = metrics.classification_report(
        df, "y_true", "y_pred", score="score", id_col="id"
    ).first().asDict()
    assert got["accuracy"] == 0.75 and got["confusion_matrix"] == [[2, 0], [1, 1]]
    assert got["precision_macro"] == pytest.approx((2 / 3 + 1) / 2)
    assert got["roc_auc"] == 1.0 and got["pr_auc"] == 1.0 and got["labels"] == [0, 1]
    plain = metrics.classification_report(df, "y_true", "y_pred")
    assert "roc_auc" not in plain.columns
    with pytest.raises(ValueError, match="id_col"):
        metrics.classification_report(df, "y_true", "y_pred", score="score")


def test_groups(spark):
    df = rows_pred(spark, [0, 1, 1, 0], [0, 1, 0, 0]).withColumn("g", F.col("id") < 2)
    got = {r["g"]: r["accuracy"] for r in metrics.accuracy(df, "y_true", "y_pred", ["g"]).collect()}
    assert got == {True: 1.0, False: 0.5}
    cells = metrics.confusion_matrix(df, "y_true", "y_pred", by=["g"])
    assert cells.count() == 8


def test_a_matrix_of_many_labels_is_sparse(spark):
    n = 100_000
    df = spark.range(n).select(
        "id", F.col("id").alias("y_true"), F.when(F.col("id") % 4 == 0, 0).otherwise(F.col("id")).alias("y_pred")
    )
    cells = metrics.confusion_matrix(df, "y_true", "y_pred")
    assert cells.count() == n and cells.agg(F.sum("n")).first()[0] == n
    assert cells.filter("y_true = 8").collect() == [(8, 0, 1)]
    report = metrics.classification_report(df, "y_true", "y_pred").first()
    assert report["confusion_matrix"] is None and report["labels"] is None
    assert report["accuracy"] == (n * 3 // 4 + 1) / n


def test_zero_cells_by_group(spark, monkeypatch):
    rows = [("a", 0, 0), ("a", 1, 0), ("b", 0, 5), ("b", 1, 2), (None, 3, 3), (None, 4, 3)]
    df = spark.createDataFrame(rows, "g string, y_true int, y_pred int")
    monkeypatch.setattr(metrics, "DENSE_CLASSES", 2)
    cells = metrics.confusion_matrix(df, "y_true", "y_pred", by=["g"]).collect()
    found = {}
    for r in cells:
        found.setdefault(r["g"], {})[(r["y_true"], r["y_pred"])] = r["n"]
    # b has four labels, more than are filled up
    assert found == {
        "a": {(0, 0): 1, (1, 0): 1, (0, 1): 0, (1, 1): 0}, "b": {(0, 5): 1, (1, 2): 1},
        None: {(3, 3): 1, (4, 3): 1, (3, 4): 0, (4, 4): 0},
    }
    given = metrics.confusion_matrix(df.filter("g = 'a'"), "y_true", "y_pred", labels=[0, 1, 2])
    assert given.count() == 9
    assert metrics.confusion_matrix(df.limit(0), "y_true", "y_pred", labels=[0, 1]).count() == 4
