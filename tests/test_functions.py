import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_cls, spark_error

from sparkfold.functions import losses, scalar


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first().asDict()


def arr(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_sigmoid_is_bounded(spark):
    values = one(spark, **{f"s{i}": scalar.sigmoid(F.lit(z)) for i, z in
                           enumerate([-1000.0, 0.0, 1000.0])})
    assert values["s0"] < 1e-200 and values["s1"] == 0.5 and values["s2"] > 1 - 1e-12


@pytest.mark.parametrize("logits", [(1, 2, 3), (1000, 1001, 1002), (5,)])
def test_softmax(spark, logits):
    e = np.exp(np.array(logits, float) - max(logits))
    got = one(spark, a=scalar.softmax(arr(*logits)),
              b=scalar.softmax_of([F.lit(float(v)) for v in logits]))
    assert np.allclose(got["a"], e / e.sum(), atol=1e-15)
    assert np.allclose(got["b"], e / e.sum(), atol=1e-15)


def test_log_sum_exp(spark):
    got = one(spark, a=scalar.log_sum_exp(arr(1, 2)), b=scalar.log_sum_exp(arr(3000, 3001)))
    assert got["a"] == pytest.approx(math.log(math.e + math.e**2))
    assert got["b"] == pytest.approx(3000 + math.log(1 + math.e))


def test_grouped_log_sum_exp_over_a_huge_range(spark):
    rows = [("a", v) for v in (-2000.0, 1499.0, 1501.0, 1500.5)] + [("b", -7.0)]
    df = spark.createDataFrame(rows, "g string, z double")
    got = {r["g"]: r["out"] for r in scalar.grouped_log_sum_exp(df, ["g"], "z", "out").collect()}
    assert got["a"] == pytest.approx(1501 + math.log(1 + math.exp(-2) + math.exp(-0.5)))
    assert got["b"] == pytest.approx(-7.0)


def test_one_hot(spark):
    df = rows_cls(spark, [[0]] * 3, [2, 0, 1])
    got = [r["h"] for r in df.orderBy("id").select(scalar.one_hot("label", 3).alias("h")).collect()]
    assert got == [[0, 0, 1], [1, 0, 0], [0, 1, 0]]
    with spark_error("must exceed the largest label"):
        df.select(scalar.one_hot("label", 2)).collect()
    with spark_error("non-negative"):
        df.select(scalar.one_hot(F.col("label") - 1, 3)).collect()


def test_clip_and_norms(spark):
    got = one(
        spark,
        p=F.array(*[scalar.clip_probability(F.lit(v), 1e-6) for v in (0.0, 0.5, 1.0)]),
        n=scalar.l2_norm(arr(3, 4)), q=scalar.squared_l2_norm(arr(3, 4)),
    )
    assert got == {"p": [1e-6, 0.5, 1 - 1e-6], "n": 5.0, "q": 25.0}
    with pytest.raises(ValueError):
        scalar.clip_probability(F.lit(0.5), 0.5)


def test_activations(spark):
    got = one(spark, **{n: scalar.activate(n, arr(-2, 0, 3))
                        for n in ("relu", "leaky_relu", "sigmoid", "tanh")})
    assert got["relu"] == [0.0, 0.0, 3.0]
    assert got["leaky_relu"] == [-0.02, 0.0, 3.0]
    assert np.allclose(got["tanh"], np.tanh([-2, 0, 3]))
    assert got["sigmoid"][1] == 0.5
    with pytest.raises(ValueError):
        scalar.activate("swish", arr(1))


def test_first_argmax_takes_the_first(spark):
    assert one(spark, i=scalar.first_argmax(arr(0.2, 0.4, 0.4)))["i"] == 1


def test_losses_with_and_without_weights(spark):
    df = spark.createDataFrame([(0, 0.25, 1.0), (1, 0.75, 3.0)], "y int, p double, w double")
    got = df.agg(
        losses.binary_cross_entropy("y", "p").alias("plain"),
        losses.binary_cross_entropy("y", "p", "w").alias("weighted"),
        losses.mse_loss("y", "p", "w").alias("mse"),
        losses.weighted_mean("p", "w").alias("mean"),
    ).first()
    assert got["plain"] == pytest.approx(got["weighted"]) == pytest.approx(-math.log(0.75))
    assert got["mse"] == pytest.approx(0.0625) and got["mean"] == pytest.approx(0.625)
    with spark_error("positive"):
        df.agg(losses.weighted_mean("p", F.col("w") * 0)).collect()


def test_categorical_cross_entropy_clips(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0]), (1, [0.0, 1.0])], "y int, p array<double>")
    got = df.agg(losses.categorical_cross_entropy("y", "p").alias("l")).first()["l"]
    assert got == pytest.approx((-math.log(1e-15) - math.log(1 - 1e-15)) / 2)


def test_penalties():
    assert losses.penalty_sum([3, -4], "l2", 2.0) == 25.0
    assert losses.penalty_sum([3, -4], "l1", 2.0) == 14.0
    assert losses.penalty_sum([3, -4], None, 2.0) == 0.0
    with pytest.raises(ValueError):
        losses.penalty_sum([1], "l3", 1.0)
