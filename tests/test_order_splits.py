import hashlib
import math

import pytest
from pyspark.sql import functions as F
from tests.helpers import rows_cls

from sparkfold.operators import order, splits


def hashed(seed, ids):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def ids_of(df, column):
    return {r["id"] for r in df.filter(F.col(column)).collect()}


@pytest.mark.parametrize("leaf_rows", [10_000, 3])
@pytest.mark.parametrize("driver_rows", [0, 20_000])
def test_order_statistics_refine_to_the_row(spark, monkeypatch, leaf_rows, driver_rows):
    monkeypatch.setattr(order, "DRIVER_ROWS", driver_rows)
    monkeypatch.setattr(order, "LITERAL_PAIRS", min(driver_rows, 64))
    df = spark.range(0, 3000).repartition(5)
    ids = hashed(4, range(3000))
    got = order.order_statistics(
        df, order.shuffled_order(4, "id"), lambda c: {0: [0, 17, 1500, 2999]}, leaf_rows=leaf_rows
    )
    assert got[0] == {0: 3000}
    assert {r: key[1] for (_, r), key in got[1].items()} == {
        r: ids[r] for r in (0, 17, 1500, 2999)
    }


def test_order_statistics_per_group_by_id(spark):
    df = spark.range(0, 500).withColumn("id", F.col("id") * 1_000_003 - 77)
    group = F.pmod("id", F.lit(3)).cast("int")
    rows = sorted((r[0], r[1]) for r in df.select("id", group).collect())
    got = order.order_statistics(
        df, order.id_order(df, "id"), lambda c: {g: [c[g] - 1, 5] for g in c}, group, leaf_rows=2
    )
    for (g, rank), key in got[1].items():
        assert key[0] == [i for i, own in rows if own == g][rank]
    with pytest.raises(ValueError, match="outside"):
        order.order_statistics(df, order.id_order(df, "id"), lambda c: {0: [500]})


@pytest.mark.parametrize("bucket_rows", [10**6, 37])
@pytest.mark.parametrize("shuffle", [True, False])
def test_ranks(spark, bucket_rows, shuffle):
    df = spark.range(0, 400).withColumn("id", F.col("id") * 13 - 9).repartition(7)
    ids = [i * 13 - 9 for i in range(400)]
    expected = hashed(2, ids) if shuffle else ids
    ranked = order.add_rank(df, "id", "rank", shuffle=shuffle, seed=2, bucket_rows=bucket_rows)
    got = sorted((r["rank"], r["id"]) for r in ranked.collect())
    assert got == list(enumerate(expected))


def test_value_buckets_split_a_hot_value(spark):
    # two thirds of the rows share one score: no bucket may take them all
    df = spark.range(0, 6000).withColumn(
        "s", F.when(F.col("id") % 3 == 0, F.col("id") / 7000).otherwise(F.lit(0.25))
    )
    cut, bound = order.value_buckets(df, -F.col("s"), "id", 6000, bucket_rows=100)
    sizes = [r["count"] for r in cut.groupBy("_b1", "_b2").count().collect()]
    assert max(sizes) < 400 and len(sizes) <= bound
    ends = cut.groupBy("_b1", "_b2").agg(
        F.max(F.struct(-F.col("s"), F.col("id"))).alias("last"),
        F.min(F.struct(-F.col("s"), F.col("id"))).alias("first"),
    ).orderBy("_b1", "_b2").collect()
    assert all(a["last"] < b["first"] for a, b in zip(ends, ends[1:]))


def test_cuts_of_a_hot_value_are_not_counted_row_by_row(spark):
    # two scores of 4,000 rows each, other rows alone: a row must not carry or walk the cuts of its score
    df = spark.range(0, 9000).withColumn(
        "s", F.when(F.col("id") < 8000, (F.col("id") % 2).cast("double")).otherwise(F.col("id") / 7000)
    )
    cut, bound = order.value_buckets(df, F.col("s"), "id", 9000, bucket_rows=50)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "array<double>" not in plan and "Join" not in plan
    got = [tuple(r) for r in cut.orderBy("_b1", "_b2", "id").select("_b1", "_b2", "s", "id").collect()]
    assert [g[2:] for g in got] == sorted(g[2:] for g in got)
    parts = {b: {g[1] for g in got if g[0] == b} for b in {g[0] for g in got}}
    assert sum(len(p) for p in parts.values()) <= bound
    assert sorted(len(p) for p in parts.values())[-2] > 40


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_splits_do_not_depend_on_partitioning(spark, partitions):
    df = spark.range(0, 300).withColumn("label", F.col("id") % 3).repartition(partitions)
    split = splits.train_test_split(df, "id", test_size=0.3, seed=5)
    assert ids_of(split, "is_test") == set(hashed(5, range(300))[:90])
    folds = splits.k_fold(df, "id", n_splits=7, shuffle=True, seed=5)
    starts = splits.fold_starts(300, 7) + [300]
    ids = hashed(5, range(300))
    expected = {i: f for f in range(7) for i in ids[starts[f]:starts[f + 1]]}
    assert {r["id"]: r["fold"] for r in folds.collect()} == expected


def test_unshuffled_split_takes_the_front(spark):
    df = rows_cls(spark, [[2 * i, 2 * i + 1] for i in range(10)], [0] * 10)
    split = splits.train_test_split(df, "id", test_size=0.25, shuffle=False)
    assert ids_of(split, "is_test") == {0, 1, 2}
    again = splits.train_test_split(df, "id", test_size=4, seed=1)
    assert ids_of(again, "is_test") == ids_of(
        splits.train_test_split(df, "id", test_size=4, seed=1), "is_test"
    )


@pytest.mark.parametrize("size", [0.0, 1.0, 0, 10, -1])
def test_bad_test_sizes(spark, size):
    with pytest.raises(ValueError):
        splits.train_test_split(rows_cls(spark, [[0]] * 10, [0] * 10), "id", test_size=size)


def test_stratified_split_keeps_classes(spark):
    df = rows_cls(spark, [[0]] * 10, [0] * 5 + [1] * 5)
    split = splits.train_test_split(df, "id", test_size=0.4, stratify="label", seed=3)
    counts = {(r["is_test"], r["label"]): r["count"]
              for r in split.groupBy("is_test", "label").count().collect()}
    assert counts == {(True, 0): 2, (True, 1): 2, (False, 0): 3, (False, 1): 3}


def test_quotas():
    # half-way cases go to the even number, at least one, never the whole class
    assert splits.class_quotas({0: 10, 1: 10, 2: 5}, 5) == {0: 2, 1: 2, 2: 1}
    assert splits.class_quotas({0: 5, 1: 1}, 3) == {0: 2, 1: 0}
    assert splits.class_quotas({c: 4 for c in range(6)}, 4) == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0}


def test_stratified_split_fills_up(spark):
    df = rows_cls(spark, [[0]] * 6, [0] * 5 + [1])
    split = splits.train_test_split(df, "id", test_size=3, stratify="label", seed=3)
    assert len(ids_of(split, "is_test")) == 3


def test_folds(spark):
    df = rows_cls(spark, [[0]] * 10, [0] * 10)
    plain = splits.k_fold(df, "id", n_splits=4).orderBy("id").collect()
    assert [r["fold"] for r in plain] == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
    for bad in (1, 11):
        with pytest.raises(ValueError, match="n_splits"):
            splits.k_fold(df, "id", n_splits=bad)
        with pytest.raises(ValueError, match="n_splits"):
            splits.stratified_k_fold(df, "id", "label", n_splits=bad)


@pytest.mark.parametrize("shuffle", [True, False])
@pytest.mark.parametrize("literal_classes", [16, 0])
def test_stratified_folds(spark, shuffle, literal_classes, monkeypatch):
    monkeypatch.setattr(splits, "LITERAL_CLASSES", literal_classes)
    df = rows_cls(spark, [[0]] * 17, [0] * 6 + [1] * 6 + [2] * 5)
    folds = splits.stratified_k_fold(df, "id", "label", n_splits=3, shuffle=shuffle, seed=8)
    counts = {(r["label"], r["fold"]): r["count"]
              for r in folds.groupBy("label", "fold").count().collect()}
    assert counts == {
        **{(c, f): 2 for c in (0, 1) for f in range(3)}, (2, 0): 2, (2, 1): 2, (2, 2): 1
    }
    if not shuffle:
        assert [r["fold"] for r in folds.orderBy("id").collect()] == [
            0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1, 2, 0, 1
        ]


def test_class_smaller_than_the_number_of_folds(spark):
    df = rows_cls(spark, [[0]] * 9, [0] * 7 + [1] * 2)
    folds = splits.stratified_k_fold(df, "id", "label", n_splits=4, shuffle=True)
    assert sorted(r["fold"] for r in folds.filter("label = 1").collect()) == [0, 1]


def test_literal_and_joined_cutoffs_agree(spark, monkeypatch):
    df = spark.range(0, 200).withColumn("label", F.col("id") % 5)
    by_literal = ids_of(
        splits.train_test_split(df, "id", test_size=0.2, stratify="label", seed=1), "is_test"
    )
    monkeypatch.setattr(splits, "LITERAL_CLASSES", 0)
    by_join = ids_of(
        splits.train_test_split(df, "id", test_size=0.2, stratify="label", seed=1), "is_test"
    )
    assert by_literal == by_join and len(by_literal) == 40


def test_holdout(spark):
    df = spark.range(0, 21)
    assert len(ids_of(splits.holdout_split(df, "id", fraction=0.1), "is_validation")) == 3
    assert ids_of(splits.holdout_split(df, "id", fraction=0.0), "is_validation") == set()
    off = splits.holdout_split(df, "id", early_stopping=False)
    assert ids_of(off, "is_validation") == set()
    assert splits.holdout_rows(2, 0.99) == 1
    with pytest.raises(ValueError, match="two samples"):
        splits.holdout_split(df.limit(1), "id", fraction=0.5)
    with pytest.raises(ValueError, match="validation_fraction"):
        splits.holdout_split(df, "id", fraction=1.0)


def test_mini_batches(spark):
    df = spark.range(0, 70)
    batches = splits.mini_batches(df, "id", epoch=1, batch_size=20, seed=3)
    ids = hashed("3:1", range(70))
    assert batches.count == 4
    assert {r["id"]: r["batch"] for r in batches.df.collect()} == {
        i: r // 20 for r, i in enumerate(ids)
    }
    assert splits.mini_batches(df, "id", epoch=0).count == math.ceil(70 / 32)
    for bad in (0, 71):
        with pytest.raises(ValueError, match="batch_size"):
            splits.mini_batches(df, "id", epoch=0, batch_size=bad)


def by_tables(monkeypatch, leaf_rows, broadcast):
    """Stratified splits search their ranks by tables, with small intervals."""
    monkeypatch.setattr(order, "DRIVER_GROUPS", 0)
    if not broadcast:
        monkeypatch.setattr(order, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(order, "HEAVY_PARTS", 4)
    keys = order.group_keys
    monkeypatch.setattr(splits, "group_keys", lambda *a: keys(*a, leaf_rows=leaf_rows))


@pytest.mark.parametrize("leaf_rows, broadcast", [(10**6, True), (3, True), (2, False)])
def test_splits_by_tables_equal_those_by_the_driver(spark, monkeypatch, leaf_rows, broadcast):
    label = F.when(F.col("id") % 2 == 0, -4).otherwise(F.pmod(F.xxhash64("id"), F.lit(60)))
    df = spark.range(900).withColumn("label", label.cast("int")).withColumn("_cut", F.lit(1)).persist()

    def splitted():
        found = [
            splits.train_test_split(df, "id", test_size=n, stratify="label", seed=3) for n in (30, 200, 0.9)
        ]
        found.append(splits.stratified_k_fold(df, "id", "label", n_splits=4, shuffle=True, seed=3, out="is_test"))
        return [sorted((r["id"], r["label"], r["is_test"]) for r in f.collect()) for f in found]

    wanted = splitted()
    by_tables(monkeypatch, leaf_rows, broadcast)
    assert splitted() == wanted
    with pytest.raises(Exception, match="unique"):
        twice = df.union(df.filter("id < 300"))
        splits.train_test_split(twice, "id", test_size=0.5, stratify="label", seed=3).count()


def test_a_million_classes(spark, monkeypatch):
    n = 2_000_000
    label = F.when(F.col("id") < n // 2, F.col("id")).otherwise(-1)
    df = spark.range(0, n, 1, 8).withColumn("label", label)
    collected = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(collect(self)) or collected[-1])
    folded = splits.stratified_k_fold(df, "id", "label", n_splits=4, shuffle=True, seed=1)
    sizes = folded.groupBy(F.col("label") == -1, "fold").count()
    found = sorted(tuple(r) for r in sizes.collect())
    # a class of one row is in the first fold, the large one in all alike
    assert found == [(False, 0, n // 2)] + [(True, f, n // 8) for f in range(4)]
    split = splits.train_test_split(df, "id", test_size=0.25, stratify="label", seed=1)
    assert split.filter("is_test").count() == n // 4
    assert max(map(len, collected)) <= order.DRIVER_BINS + 1
