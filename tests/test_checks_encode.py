import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_cls, rows_reg

from sparkfold.operators import checks, encode, order


def wide(spark, *rows):
    return spark.createDataFrame([(list(r),) for r in rows], "features array<double>")


def test_features(spark):
    checks.require(wide(spark, (1.0, 2.0)), checks.feature_checks("features"))
    for bad, message in [
        (wide(spark, (1.0, float("nan"))), "finite"),
        (wide(spark, (float("-inf"), 0.0)), "finite"),
        (wide(spark, (1.0, None)), "finite"),
        (wide(spark, (1.0, 2.0)).limit(0), "at least one sample"),
        (wide(spark, ()), "at least one feature"),
        (wide(spark, (1.0, 2.0), (1.0,)), "same number"),
    ]:
        with pytest.raises(ValueError, match=message):
            checks.require(bad, checks.feature_checks("features"))
    with pytest.raises(ValueError, match="at least one feature"):
        checks.feature_checks([])


def test_targets_and_weights(spark):
    df = rows_reg(spark, [[1], [2]], [1.0, float("inf")], [1.0, -1.0])
    with pytest.raises(ValueError, match="target is missing, NaN or infinite"):
        checks.require(df, checks.target_checks("label"))
    with pytest.raises(ValueError, match="negative"):
        checks.require(df, checks.weight_checks("weight"))
    with pytest.raises(ValueError, match="finite"):
        checks.require(
            df.withColumn("weight", F.lit(float("inf"))), checks.weight_checks("weight")
        )
    with pytest.raises(ValueError, match="positive value"):
        checks.require(df.withColumn("weight", F.lit(0.0)), checks.weight_checks("weight"))


def test_class_targets(spark):
    df = rows_cls(spark, [[0]] * 3, [0, 1, 1])
    assert checks.require(df, checks.binary_checks("label"))["not_binary"] == 0
    two = rows_cls(spark, [[0]] * 2, [0, 2])
    with pytest.raises(ValueError, match="0 or 1"):
        checks.require(two, checks.binary_checks("label"))
    with pytest.raises(ValueError, match="two classes"):
        checks.require(df.filter("label = 1"), checks.class_checks("label"))
    with pytest.raises(ValueError, match="integer"):
        checks.require_class_type(df.withColumn("label", F.lit(0.5)), "label")


def test_probabilities(spark):
    df = spark.createDataFrame(
        [(0, [0.5, 0.5]), (1, [1.2, -0.2]), (5, [0.1, None])], "y int, p array<double>"
    )
    row = checks.check_counts(df, checks.probability_checks("p", "y", [0, 1])).first()
    assert row.asDict() == {
        "unknown_labels": 1, "bad_probabilities": 1, "outside_unit": 1, "too_few_columns": 0
    }
    with pytest.raises(ValueError):
        checks.require(df, checks.probability_checks("p", "y", [0, 1, 5]))


def test_missing_feature_columns(spark):
    df = spark.range(1).withColumn("x1", F.lit(1.0)).withColumn("s", F.lit("a"))
    checks.require_columns(df, ["x1"])
    with pytest.raises(ValueError, match="lacks"):
        checks.require_columns(df, ["x1", "x2"])
    with pytest.raises(ValueError, match="not numeric"):
        checks.require_columns(df, ["s"])


def test_label_index(spark):
    df = rows_cls(spark, [[0]] * 4, [7, -3, 7, 10])
    assert [tuple(r) for r in encode.label_table(df, "label").orderBy("label").collect()] == [
        (-3, 0), (7, 1), (10, 2)
    ]
    got = encode.add_label_index(df, "label").orderBy("id").collect()
    assert [r["label_index"] for r in got] == [1, 0, 1, 2]
    column = encode.class_index("label", [-3, 7])
    assert [r[0] for r in df.orderBy("id").select(column).collect()] == [1, 0, 1, None]


def test_class_weights(spark):
    counts = {0: 3, 1: 1}
    assert encode.resolve_class_weight(None, counts) == {0: 1.0, 1: 1.0}
    assert encode.resolve_class_weight("balanced", counts) == {0: pytest.approx(2 / 3), 1: 2.0}
    assert encode.resolve_class_weight({0: 1.5}, counts) == {0: 1.5, 1: 1.0}
    with pytest.raises(ValueError, match="do not occur"):
        encode.resolve_class_weight({4: 1.0}, counts)
    for bad in (0.0, -1.0, float("nan"), float("inf")):
        with pytest.raises(ValueError, match="positive"):
            encode.resolve_class_weight({0: bad}, counts)


def test_effective_weight(spark):
    df = rows_cls(spark, [[0]] * 4, [0, 0, 0, 1]).withColumn("w", F.lit(2.0))
    assert "effective_weight" not in encode.add_effective_weight(df, "label").columns
    got = encode.add_effective_weight(df, "label", weight="w", class_weight="balanced")
    assert sorted(r["effective_weight"] for r in got.collect()) == pytest.approx(
        [4 / 3, 4 / 3, 4 / 3, 4.0]
    )


def test_too_many_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(checks, "MAX_CLASSES", 3)
    with pytest.raises(ValueError, match="more than 3 labels"):
        checks.count_classes(rows_cls(spark, [[0]] * 5, range(5)), "label")


def test_label_columns_of_any_name_and_number(spark, monkeypatch):
    rows = [(i, [7, -3, 7, 10][i % 4], f"mine {i}", 0.5, 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, y int, _label string, _index double, _cw double")

    def indexed():
        found = encode.add_label_index(df, "y", "k")
        assert found.columns == [*df.columns, "k"]
        return sorted(tuple(r) for r in found.collect())

    def weighted():
        found = encode.add_effective_weight(df, "y", weight="_cw", class_weight="balanced", out="w")
        assert found.columns == [*df.columns, "w"]
        return sorted(tuple(r) for r in found.collect())

    wanted = [(*r, {-3: 0, 7: 1, 10: 2}[r[1]]) for r in rows]
    assert indexed() == wanted
    weights = weighted()
    assert weights[0][-1] == pytest.approx(2.0 * 40 / (3 * 20))
    monkeypatch.setattr(encode, "MAX_CLASSES", 2)
    monkeypatch.setattr(order, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(order, "HEAVY_PARTS", 3)
    assert indexed() == wanted and weighted() == weights
