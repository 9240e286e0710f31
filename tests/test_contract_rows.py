"""Rows that must not be scored, ranked or counted: refused in every form and at every size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfold.constants import COMPILED_WIDTH
from sparkfold.functions import losses, scalar
from sparkfold.operators import encode, metrics, order, splits
from sparkfold.operators import score as scoring
from sparkfold.operators.models import Model
from tests.helpers import rows_score, spark_error

NAN, INF = float("nan"), float("inf")


def logistic(width, features="features"):
    params = {"weights": np.full(width, 0.1), "bias": np.zeros(1)}
    return Model("logistic", features, width, params, [0, 1], {"threshold": 0.5})


@pytest.mark.parametrize("width", [2, COMPILED_WIDTH + 2, scoring.EXPRESSION_PARAMETERS + 2])
def test_bad_features_are_refused_in_every_form(spark, width):
    model = logistic(width)
    good = [0.5] * width
    rows = [good, None, [None, *good[1:]], [*good[1:], NAN], [INF, *good[1:]], good[1:]]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, features array<double>")
    for i in range(1, len(rows)):
        with spark_error("feature"):
            scoring.predict(df.where(f"id = {i}"), model).collect()
    kept = scoring.predict(df, model, proba="p", invalid="null").orderBy("id").collect()
    assert [r.prediction for r in kept] == [1, *[None] * 5] and kept[1].p is None
    assert kept[5].features == good[1:]


def test_bad_columns_are_refused(spark):
    df = spark.createDataFrame(
        [(0, 1.0, 1.0), (1, None, 1.0), (2, 1.0, NAN), (3, -INF, 0.0)], "id long, a double, b double"
    )
    model = logistic(2, ["a", "b"])
    for i in (1, 2, 3):
        with spark_error("feature"):
            scoring.predict(df.where(f"id = {i}"), model).collect()
    kept = scoring.score_batch(df, model, "v", invalid="null").orderBy("id").collect()
    assert [r.probability is None for r in kept] == [False, True, True, True]
    with pytest.raises(ValueError, match="invalid"):
        scoring.predict(df, model, invalid="skip")


def test_functions_keep_null_and_nan(spark):
    row = spark.range(1).select(
        scalar.sigmoid(F.lit(None).cast("double")).alias("a"),
        scalar.sigmoid(F.lit(NAN)).alias("b"),
        scalar.clip_probability(F.lit(None).cast("double")).alias("c"),
        scalar.activation("relu", F.lit(None).cast("double")).alias("d"),
        scalar.activation("relu", F.lit(NAN)).alias("e"),
    ).first()
    assert row.a is None and row.c is None and row.d is None
    assert np.isnan(row.b) and np.isnan(row.e)


def test_metrics_refuse_missing_values(spark):
    df = spark.createDataFrame([(1, 1), (1, None)], "y int, p int")
    for run in (metrics.accuracy, metrics.confusion_matrix, metrics.class_stats, metrics.f1):
        with spark_error("missing"):
            run(df, "y", "p").collect()
        with spark_error("missing"):
            run(df, "p", "y").collect()
    with spark_error("missing"):
        metrics.regression_report(df, "y", "p").collect()
    proba = spark.createDataFrame([(0, [0.9, 0.1]), (None, [0.5, 0.5])], "y int, p array<double>")
    with spark_error("missing"):
        metrics.log_loss(proba, "y", "p", [0, 1]).collect()
    with spark_error("column for each"):
        metrics.log_loss(proba.select("y", F.lit(None).cast("array<double>").alias("p")), "y", "p", [0, 1]).collect()
    single = spark.createDataFrame([(1, None), (1, 0.5)], "y int, p double")
    with spark_error("missing"):
        single.agg(losses.binary_cross_entropy("y", "p")).collect()
    with spark_error("class index"):
        proba.agg(losses.categorical_cross_entropy(F.lit(2), "p")).collect()


@pytest.mark.parametrize("bucket_rows", [100, 7])
def test_curves_refuse_the_same_rows_at_every_size(spark, bucket_rows):
    scores = [i / 40 for i in range(40)]
    clean = rows_score(spark, [i % 2 for i in range(40)], scores)
    curve = metrics.roc_curve(clean, "y_true", "score", "id", bucket_rows=bucket_rows)
    assert curve.count() == 41
    for bad in (None, NAN, INF):
        df = clean.withColumn("score", F.when(F.col("id") == 3, F.lit(bad).cast("double")).otherwise(F.col("score")))
        for run in (metrics.roc_curve, metrics.pr_curve, metrics.roc_auc, metrics.pr_auc):
            with spark_error("score is missing"):
                run(df, "y_true", "score", "id", bucket_rows=bucket_rows).collect()
    df = clean.withColumn("y_true", F.when(F.col("id") != 3, F.col("y_true")))
    with spark_error("missing"):
        metrics.roc_auc(df, "y_true", "score", "id", bucket_rows=bucket_rows).collect()
    twice = clean.union(clean.where("id = 5"))
    with spark_error("unique"):
        metrics.roc_auc(twice, "y_true", "score", "id", bucket_rows=bucket_rows).collect()


def test_folds_lose_no_row(spark):
    df = spark.range(200).select("id", F.when(F.col("id") != 9, F.col("id") % 3).alias("label"))
    for rows in (1000, 20):
        with spark_error("missing"):
            splits.stratified_k_fold(df, "id", "label", n_splits=4, bucket_rows=rows).collect()
    with spark_error("missing"):
        splits.stratified_k_fold(df, "id", "label", n_splits=4, shuffle=True).collect()
    ranked = order.add_rank(df, "id", "r", shuffle=False, group=["label"], bucket_rows=20)
    assert ranked.count() == 200


def test_repeated_ids_are_refused(spark):
    df = spark.range(40).select((F.col("id") % 10).alias("id"))
    with pytest.raises(ValueError, match="unique"):
        splits.train_test_split(df, "id", test_size=10).collect()


@pytest.mark.parametrize("tied", [50, 1000])
def test_ties_do_not_multiply_buckets(spark, tied):
    df = spark.range(20_000).select("id", (F.col("id") % tied).cast("double").alias("s"))
    cut, bound = order.value_buckets(df, F.col("s"), "id", 20_000, 100)
    found = cut.groupBy("_b1", "_b2").count()
    assert found.count() <= 3 * 200 and bound <= 3 * 200
    assert found.agg(F.max("count")).first()[0] <= 1000


def test_classes_beyond_a_hundred_thousand(spark):
    df = spark.range(150_000).select((F.col("id") * 3).alias("label"))
    indexed = encode.add_label_index(df, "label")
    assert indexed.where("label_index = label / 3").count() == 150_000
    assert encode.class_weight_table(df, "label", "balanced").where("class_weight = 1.0").count() == 150_000
    one = encode.add_one_hot(spark.range(3), "id").orderBy("id").first()
    assert one.one_hot == [1.0, 0.0, 0.0]
