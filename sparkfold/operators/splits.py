"""Splits, folds and batches: exact sizes, seed-deterministic, independent of partitioning.

Shuffled splits and folds are comparisons of each row's shuffle key with a few cutoff keys that are
found first (``order_statistics``): the table itself is never shuffled or sorted, and the resulting
column is a plain projection that Catalyst can combine with whatever follows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import BUCKET_ROWS, MAX_CLASSES, SMALL_BATCH
from sparkfold.functions.scalar import as_class
from sparkfold.operators.encode import small_join
from sparkfold.operators.order import (
    ManyGroups,
    RowOrder,
    add_rank,
    group_counts,
    group_keys,
    heavy_join,
    order_statistics,
    precedes,
    row_order,
    running_sums,
    shuffled_order,
    value_buckets,
)

LITERAL_CLASSES = 16  # cutoffs are literals up to this many classes, a joined table beyond


def n_test_rows(n_rows: int, test_size: float | int) -> int:
    """Number of test rows for a fraction (rounded up) or an absolute size."""
    if isinstance(test_size, float):
        if not 0.0 < test_size < 1.0:
            raise ValueError("a fractional test_size must lie strictly between 0 and 1.")
        n_test = math.ceil(n_rows * test_size)
    else:
        n_test = int(test_size)
    if not 0 < n_test < n_rows:
        raise ValueError("test_size must leave rows on both sides of the split.")
    return n_test


def _total(counts: Mapping) -> int:
    total = sum(counts.values())
    if total == 0:
        raise ValueError("at least one sample is needed.")
    return total


def first_rows(df: DataFrame, order: RowOrder, how_many) -> Column:
    """True for the first ``how_many(n)`` rows of the order."""
    chosen: dict = {}

    def targets(counts):
        chosen["n"] = _total(counts)
        chosen["take"] = how_many(chosen["n"])
        return {0: [chosen["take"]]} if 0 < chosen["take"] < chosen["n"] else {}

    _, keys = order_statistics(df, order, targets)
    if not chosen:
        _total({})
    if chosen["take"] <= 0:
        return F.lit(False)
    if chosen["take"] >= chosen["n"]:
        return F.lit(True)
    return precedes(order.columns, keys[(0, chosen["take"])])


def train_test_split(
    df: DataFrame,
    id_col: str,
    *,
    test_size: float | int = 0.25,
    shuffle: bool = True,
    stratify: str | None = None,
    seed: int = 0,
    out: str = "is_test",
) -> DataFrame:
    """The rows with a boolean column that marks the test part."""
    if stratify is not None:
        return _stratified_split(df, id_col, test_size, stratify, seed, out)
    order = row_order(df, id_col, shuffle, seed)
    return df.withColumn(out, first_rows(df, order, lambda n: n_test_rows(n, test_size)))


def class_quotas(counts: Mapping[int, int], n_test: int) -> dict[int, int]:
    """Test rows per class: proportional, at least one, never a whole class.

    The half-way case of the proportion goes to the even number; a surplus is taken back from the
    highest classes first.
    """
    total = sum(counts.values())
    quotas = {
        label: min(max(1, round(n_test * n / total)), n - 1) for label, n in sorted(counts.items())
    }
    surplus = sum(quotas.values()) - n_test
    for label in sorted(quotas, reverse=True):
        taken = min(max(surplus, 0), quotas[label])
        quotas[label] -= taken
        surplus -= taken
    return quotas


def _stratified_split(df, id_col, test_size, stratify, seed, out) -> DataFrame:
    label = as_class(stratify)
    order = shuffled_order(seed, id_col)
    plan: dict = {}

    def targets(counts):
        plan["n_test"] = n_test_rows(_total(counts), test_size)
        plan["quotas"] = class_quotas(counts, plan["n_test"])
        return {c: [q] for c, q in plan["quotas"].items() if q > 0}

    try:
        _, keys = order_statistics(df, order, targets, label)
    except ManyGroups:
        return _split_by_tables(df, id_col, test_size, label, seed, out)
    if not plan:
        _total({})
    cutoffs = {c: keys[(c, q)] for c, q in plan["quotas"].items() if q > 0}
    marked, taken = _before_class_cutoff(df, label, order, cutoffs, id_col)
    short = plan["n_test"] - sum(plan["quotas"].values())
    if short > 0:
        # the rest is filled from the remaining rows in a second shuffled order
        second = shuffled_order(f"{seed}:fill", id_col)
        rest = marked.filter(~taken)
        taken = taken | first_rows(rest, second, lambda n: short)
    return marked.withColumn(out, taken).select(*df.columns, out)


def quota_table(counts: DataFrame, total: int, n_test: int) -> DataFrame:
    """(_g, _n, _q): class_quotas of a table (_g, _n) with any number of classes."""
    share = F.bround(F.lit(float(n_test)) * F.col("_n") / F.lit(float(total))).cast("long")
    wish = F.least(F.greatest(F.lit(1).cast("long"), share), F.col("_n") - 1)
    wishes = counts.select("_g", "_n", wish.alias("_q")).persist()
    try:
        n_classes, wished = wishes.agg(F.count(F.lit(1)), F.sum("_q")).first()
        surplus = max(wished - n_test, 0)
        if not surplus:
            return wishes.select("*")
        bucketed, n_buckets = value_buckets(wishes, None, "_g", n_classes)
        # what the classes up to one have asked for; the rest was asked for by higher ones
        summed = running_sums(
            bucketed, ["_b1"], n_buckets, [F.col("_g")], {"_so_far": F.col("_q")}, place=["_g"]
        )
        left = F.lit(surplus) - (F.lit(wished) - F.col("_so_far"))
        taken = F.least(F.greatest(left, F.lit(0).cast("long")), F.col("_q"))
        return summed.select("_g", "_n", (F.col("_q") - taken).alias("_q")).persist()
    finally:
        if n_classes and wished > n_test:
            wishes.unpersist()


def _split_by_tables(df, id_col, test_size, label, seed, out) -> DataFrame:
    """A stratified split whose class counts, quotas and cutoffs are tables throughout."""
    order = shuffled_order(seed, id_col)
    counts, total, n_classes = group_counts(df, label)
    n_test = n_test_rows(total, test_size)
    quotas = quota_table(counts, total, n_test)
    wanted = quotas.filter("_q > 0").select("_g", F.col("_q").alias("_rank"))
    keys = group_keys(df, order, label, wanted, total, n_classes)
    cutoffs = keys.select("_g", F.struct(*keys.columns[2:]).alias("_cut"))
    cutoffs = counts.join(cutoffs, "_g", "left").select(F.col("_g").alias("_c"), "_n", "_cut")
    joined = heavy_join(_whole_rows(df, order, label), cutoffs, ["_c"], "_n", total, n_classes)
    marked = _unpacked(df, joined, F.coalesce(F.col("_me") < F.col("_cut"), F.lit(False)), out)
    short = n_test - quotas.agg(F.sum("_q")).first()[0]
    if short > 0:
        second = shuffled_order(f"{seed}:fill", id_col)
        rest = marked.filter(~F.col(out))
        marked = marked.withColumn(out, F.col(out) | first_rows(rest, second, lambda n: short))
    return marked


def _whole_rows(df: DataFrame, order: RowOrder, label: Column) -> DataFrame:
    """(_row, _c, _me): the row as it is, whatever its columns are called, its class and its key."""
    key = F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(order.columns)])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(row.alias("_row"), label.alias("_c"), key.alias("_me"))


def _unpacked(df: DataFrame, rows: DataFrame, value: Column, out: str) -> DataFrame:
    """The columns of df again, with one more."""
    own = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != out]
    return rows.select(*own, value.alias(out))


def _folds_by_tables(df, id_col, label, n_splits, seed, out) -> DataFrame:
    """Shuffled stratified folds whose class counts and cutoffs are tables throughout."""
    order = shuffled_order(seed, id_col)
    counts, total, n_classes = group_counts(df, label)
    _check_splits(n_splits, total)
    start = F.expr(f"_f * (_n div {n_splits}) + least(_f, _n % {n_splits})")
    wanted = counts.select("_g", "_n", F.explode(F.sequence(F.lit(1), F.lit(n_splits - 1))).alias("_f"))
    wanted = wanted.select("_g", "_n", start.cast("long").alias("_rank")).filter("_rank < _n")
    keys = group_keys(df, order, label, wanted.select("_g", "_rank"), total, n_classes)
    cuts = keys.groupBy("_g").agg(F.collect_list(F.struct(*keys.columns[2:])).alias("_cuts"))
    cuts = counts.join(cuts, "_g", "left").select(F.col("_g").alias("_c"), "_n", "_cuts")
    joined = heavy_join(_whole_rows(df, order, label), cuts, ["_c"], "_n", total, n_classes)
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_me")))
    return _unpacked(df, joined, F.when(F.col("_cuts").isNull(), 0).otherwise(passed), out)


def _before_class_cutoff(df, label, order, cutoffs, id_col) -> tuple[DataFrame, Column]:
    """A condition that is true before the cutoff key of the row's own class."""
    if len(cutoffs) <= LITERAL_CLASSES:
        tests = [(label == c) & precedes(order.columns, key) for c, key in cutoffs.items()]
        return df, reduce(lambda a, b: a | b, tests, F.lit(False))
    id_type = df.schema[id_col].dataType.simpleString()
    table = df.sparkSession.createDataFrame(
        [(c, *key) for c, key in cutoffs.items()], f"_c long, _ck string, _ci {id_type}"
    )
    hint = F.broadcast(table) if len(cutoffs) <= MAX_CLASSES else table
    joined = df.withColumn("_c", label).join(hint, "_c", "left")
    key, row_id = order.columns
    before = (key < F.col("_ck")) | ((key == F.col("_ck")) & (row_id < F.col("_ci")))
    return joined, F.coalesce(before, F.lit(False))


def fold_starts(n_rows: int, n_splits: int) -> list[int]:
    """First rank of every fold: contiguous slices, the first ones longer by one row."""
    size, longer = divmod(n_rows, n_splits)
    return [f * size + min(f, longer) for f in range(n_splits)]


def _check_splits(n_splits: int, n_rows: int) -> None:
    if n_splits < 2:
        raise ValueError("n_splits below 2 makes no folds.")
    if n_splits > n_rows:
        raise ValueError("n_splits is larger than the table.")


def _passed(order: RowOrder, keys: Sequence[tuple]) -> Column:
    """Number of cutoff keys at or before the row."""
    passed = [(~precedes(order.columns, key)).cast("int") for key in keys]
    return reduce(lambda a, b: a + b, passed, F.lit(0))


def k_fold(
    df: DataFrame,
    id_col: str,
    *,
    n_splits: int = 5,
    shuffle: bool = False,
    seed: int = 0,
    out: str = "fold",
) -> DataFrame:
    """The rows with their test fold: contiguous slices of the (shuffled) order."""
    order = row_order(df, id_col, shuffle, seed)

    def targets(counts):
        _check_splits(n_splits, _total(counts))
        return {0: fold_starts(_total(counts), n_splits)[1:]}

    _, keys = order_statistics(df, order, targets)
    return df.withColumn(out, _passed(order, sorted(keys.values())))


def stratified_k_fold(
    df: DataFrame,
    id_col: str,
    label: str,
    *,
    n_splits: int = 5,
    shuffle: bool = False,
    seed: int = 0,
    out: str = "fold",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows with a test fold that keeps the class shares.

    Unshuffled, the rows of a class are dealt out in turn by id. Shuffled, the folds of a class are
    slices of its shuffled order: a random deal has the same fold sizes either way, and slices need
    no ranks, so the table is not shuffled.
    """
    if not shuffle:
        n_rows = df.count()
        _check_splits(n_splits, n_rows)
        with_class = df.withColumn("_c", as_class(label))
        ranked = add_rank(
            with_class, id_col, "_rank", shuffle=False, group=["_c"],
            n_rows=n_rows, bucket_rows=bucket_rows,
        )
        fold = F.pmod(F.col("_rank"), F.lit(n_splits)).cast("int")
        return ranked.withColumn(out, fold).select(*df.columns, out)

    order = shuffled_order(seed, id_col)

    def targets(counts):
        _check_splits(n_splits, _total(counts))
        # a class smaller than the number of folds fills the first folds only
        return {
            c: [s for s in fold_starts(n, n_splits)[1:] if s < n] for c, n in counts.items()
        }

    value = as_class(label)
    try:
        counts, keys = order_statistics(df, order, targets, value)
    except ManyGroups:
        return _folds_by_tables(df, id_col, value, n_splits, seed, out)
    per_class = {
        c: [keys[(c, s)] for s in fold_starts(n, n_splits)[1:] if s < n]
        for c, n in counts.items()
    }
    if len(counts) <= LITERAL_CLASSES:
        fold = F.lit(0)
        for c, cuts in per_class.items():
            fold = F.when(value == c, _passed(order, cuts)).otherwise(fold)
        return df.withColumn(out, fold)
    id_type = df.schema[id_col].dataType.simpleString()
    table = df.sparkSession.createDataFrame(
        [(c, cuts) for c, cuts in per_class.items()],
        f"_c long, _cuts array<struct<k:string,i:{id_type}>>",
    )
    joined = small_join(df.withColumn("_c", value), table, len(per_class), "_c")
    me = F.struct(order.columns[0].alias("k"), order.columns[1].alias("i"))
    fold = F.size(F.filter("_cuts", lambda cut: cut <= me))
    return joined.withColumn(out, fold).select(*df.columns, out)


def holdout_rows(n_rows: int, fraction: float) -> int:
    """Rows kept aside for early stopping."""
    return min(max(1, math.ceil(n_rows * fraction)), n_rows - 1)


def check_fraction(fraction: float) -> float:
    if not 0.0 <= fraction < 1.0:
        raise ValueError("validation_fraction must be at least 0 and below 1.")
    return fraction


def holdout_condition(
    df: DataFrame, id_col: str, *, fraction: float, seed: int | str
) -> Column:
    """True for the rows that an early-stopping fit must not train on."""
    if check_fraction(fraction) == 0.0:
        return F.lit(False)

    def how_many(n):
        if n < 2:
            raise ValueError("a validation holdout needs at least two samples.")
        return holdout_rows(n, fraction)

    return first_rows(df, shuffled_order(f"{seed}:holdout", id_col), how_many)


def holdout_split(
    df: DataFrame,
    id_col: str,
    *,
    early_stopping: bool = True,
    fraction: float = 0.1,
    seed: int = 0,
    out: str = "is_validation",
) -> DataFrame:
    check_fraction(fraction)
    if not early_stopping:
        return df.withColumn(out, F.lit(False))
    return df.withColumn(out, holdout_condition(df, id_col, fraction=fraction, seed=seed))


def batch_rows(batch_size: int | None, n_rows: int) -> int:
    if batch_size is None:
        return min(SMALL_BATCH, n_rows)
    if batch_size <= 0:
        raise ValueError("batch_size is below one row.")
    if batch_size > n_rows:
        raise ValueError("batch_size is larger than the table.")
    return batch_size


@dataclass(frozen=True)
class Batches:
    """A table with its batch column and the number of batches."""

    df: DataFrame
    count: int


def mini_batches(
    df: DataFrame,
    id_col: str,
    *,
    epoch: int,
    batch_size: int | None = None,
    shuffle: bool = True,
    seed: int = 0,
    out: str = "batch",
    n_rows: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> Batches:
    """Rows with their batch number in one epoch; the last batch may be short."""
    n = df.count() if n_rows is None else n_rows
    size = batch_rows(batch_size, n)
    ranked = add_rank(
        df, id_col, "_rank", shuffle=shuffle, seed=f"{seed}:{epoch}",
        n_rows=n, bucket_rows=bucket_rows,
    )
    batch = F.expr(f"_rank div {size}")
    return Batches(ranked.withColumn(out, batch).select(*df.columns, out), -(-n // size))
