"""Label tables and weights: the only lookups."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import MAX_CLASSES
from sparkfold.functions.scalar import as_class, one_hot
from sparkfold.operators.checks import count_classes
from sparkfold.operators.order import add_rank, heavy_join


def small_join(df: DataFrame, table: DataFrame, rows: int, on: Sequence[str] | str) -> DataFrame:
    """Join with a table of known length; broadcast only while it is class-sized."""
    return df.join(F.broadcast(table) if rows <= MAX_CLASSES else table, on)


def label_table(df: DataFrame, label: str) -> DataFrame:
    """(label, index): sorted distinct labels numbered from 0, whatever their number.

    Labels are ranked inside ordered buckets and the sizes of the earlier ones are added, so no
    task sees them all.
    """
    labels = df.select(as_class(label).alias("label")).distinct()
    ranked = add_rank(labels, "label", "_rank", shuffle=False)
    return ranked.select("label", F.col("_rank").cast("int").alias("index"))


def class_labels(df: DataFrame, label: str) -> list[int]:
    """Sorted distinct labels on the driver (class-sized, checked)."""
    return [row["label"] for row in count_classes(df, label)]


def class_index(label: Column | str, classes: Sequence[int]) -> Column:
    """Index of a label in a class list held by a model; NULL for an unknown label."""
    known = F.array(*[F.lit(int(c)).cast("long") for c in classes])
    value = F.col(label) if isinstance(label, str) else label
    return (F.nullif(F.array_position(known, value.cast("long")), F.lit(0)) - 1).cast("int")


def _labelled(df: DataFrame, label: str) -> DataFrame:
    """(_row, _label): the row as it is, whatever its columns are called, and its class."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(row.alias("_row"), as_class(label).alias("_label"))


def _with_value(df: DataFrame, joined: DataFrame, value: Column, out: str) -> DataFrame:
    """The columns of df again, with one more."""
    own = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != out]
    return joined.select(*own, value.alias(out))


def add_label_index(df: DataFrame, label: str, out: str = "label_index") -> DataFrame:
    """Every row with the index of its label; any number of labels, a missing one is an error.

    The labels are counted first. Up to MAX_CLASSES of them are a broadcast table; beyond, only the
    labels of a large part of the rows are, and no other is large enough to fill a task.
    """
    counts = df.groupBy(as_class(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    few = counts.select("_label").limit(MAX_CLASSES + 1).collect()
    left = _labelled(df, label)
    if len(few) <= MAX_CLASSES:
        rows = [(value, i) for i, value in enumerate(sorted(r[0] for r in few))]
        table = df.sparkSession.createDataFrame(rows, "_label long, _index int")
        return _with_value(df, left.join(F.broadcast(table), "_label"), F.col("_index"), out)
    total, n_labels = counts.agg(F.sum("_n"), F.count(F.lit(1))).first()
    ranked = add_rank(counts, "_label", "_index", shuffle=False, n_rows=n_labels)
    table = ranked.select("_label", "_n", F.col("_index").cast("int").alias("_index"))
    joined = heavy_join(left, table, ["_label"], "_n", total, n_labels)
    return _with_value(df, joined, F.col("_index"), out)


def add_one_hot(
    df: DataFrame, index: str, out: str = "one_hot", n_classes: int | None = None
) -> DataFrame:
    """Every row with the one-hot array of a class index; by default as wide as the largest
    index asks for."""
    if n_classes is None:
        largest = df.agg(F.max(index)).first()[0]
        if largest is None:
            return df.withColumn(out, F.array().cast("array<double>"))
        n_classes = int(largest) + 1
    return df.withColumn(out, one_hot(index, n_classes))


def resolve_class_weight(
    class_weight: Mapping[int, float] | str | None, counts: Mapping[int, int]
) -> dict[int, float]:
    """One weight per class from the counts of the training labels."""
    if class_weight is None:
        return dict.fromkeys(counts, 1.0)
    if class_weight == "balanced":
        total = sum(counts.values())
        return {label: total / (len(counts) * n) for label, n in counts.items()}
    unknown = sorted(set(class_weight) - set(counts))
    if unknown:
        raise ValueError(f"class_weight names labels that do not occur: {unknown}.")
    if not all(math.isfinite(w) and w > 0.0 for w in class_weight.values()):
        raise ValueError("class_weight values must be positive and finite.")
    return {label: float(class_weight.get(label, 1.0)) for label in counts}


def class_weight_table(
    df: DataFrame, label: str, class_weight: Mapping[int, float] | str | None = None
) -> DataFrame:
    """(label, n, class_weight), one row per class; any number of classes."""
    counts = df.groupBy(as_class(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if class_weight is None:
        return counts.withColumn("class_weight", F.lit(1.0))
    if class_weight == "balanced":
        total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
        return counts.withColumn(
            "class_weight", F.lit(float(total or 0)) / (F.lit(float(k)) * F.col("n"))
        )
    # only the classes that the mapping names reach the driver
    named = counts.where(F.col("label").isin([int(c) for c in class_weight])).collect()
    resolve_class_weight(class_weight, {row["label"]: row["n"] for row in named})
    weight = F.lit(1.0)
    for name, value in class_weight.items():
        weight = F.when(F.col("label") == int(name), float(value)).otherwise(weight)
    return counts.withColumn("class_weight", weight)


def add_effective_weight(
    df: DataFrame,
    label: str,
    *,
    weight: str | None = None,
    class_weight: Mapping[int, float] | str | None = None,
    out: str = "effective_weight",
) -> DataFrame:
    """Sample weight times class weight; the frame is returned unchanged when both are trivial."""
    own = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    table = class_weight_table(df, label, class_weight)
    if class_weight is None or table.where("class_weight <> 1.0").isEmpty():
        return df if weight is None else df.withColumn(out, own)
    n_classes, total = table.agg(F.count(F.lit(1)), F.sum("n")).first()
    table = table.select(F.col("label").alias("_label"), "n", F.col("class_weight").alias("_cw"))
    kept = _labelled(df.withColumn(out, own), label)
    joined = heavy_join(kept, table, ["_label"], "n", total, n_classes)
    columns = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != out]
    return joined.select(*columns, (F.col(f"_row.`{out}`") * F.col("_cw")).alias(out))
