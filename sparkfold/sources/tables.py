"""Learning tables: load, ingest, summarise."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sparkfold.operators import checks


def typed(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str | None = None,
    *,
    weight: str | None = None,
    classify: bool = True,
) -> DataFrame:
    """Only the columns of a learning table, with fixed types: double features, long class labels
    (double targets for regression)."""
    columns = [] if id_col is None else [F.col(id_col)]
    if isinstance(features, str):
        columns.append(F.col(features).cast("array<double>").alias(features))
    else:
        columns += [F.col(name).cast("double").alias(name) for name in features]
    columns.append(F.col(label).cast("long" if classify else "double").alias(label))
    if weight is not None:
        columns.append(F.col(weight).cast("double").alias(weight))
    return df.select(*columns)


def load_dataset(
    spark: SparkSession,
    path: str,
    features: Sequence[str] | str,
    label: str,
    id_col: str | None = None,
    *,
    weight: str | None = None,
    classify: bool = True,
    file_format: str = "parquet",
) -> DataFrame:
    """Read a learning table; the scan reads the named columns only."""
    raw = spark.read.format(file_format).load(path)
    return typed(raw, features, label, id_col, weight=weight, classify=classify)


def ingest(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    id_col: str,
    path: str,
    *,
    weight: str | None = None,
    classify: bool = True,
    file_format: str = "parquet",
    source: str | None = None,
) -> DataFrame:
    """Type, check and store a raw table unless this request has stored it; returns the stored table.

    The checks are counted while the rows are written, in one scan, and the table counts as stored
    only after they have passed: what an interrupted or refused write leaves is written anew. Beside
    the table, ``<path>.request`` tells what it was made from: the columns, types and format asked
    for, and ``source``, a name or version of the raw table that the caller may give. Another
    request on the same path is an error, and so are a path with a table that no ingest has stored
    and a stored table whose rows or schema are not those that were written.
    """
    spark = df.sparkSession
    table = typed(df, features, label, id_col, weight=weight, classify=classify)
    request = {
        "features": features if isinstance(features, str) else list(features), "label": label,
        "id_col": id_col, "weight": weight, "classify": classify, "file_format": file_format,
        "source": source, "columns": {f.name: f.dataType.simpleString() for f in table.schema},
    }
    notes = path.rstrip("/") + ".request"
    stored = _note(spark, f"{notes}/stored")
    if stored is not None:
        return _stored_table(spark, path, request, stored)
    begun = _note(spark, f"{notes}/begun")
    if begun is None and _present(lambda: spark.read.format(file_format).load(path)) is not None:
        raise ValueError(f"{path} holds a table that no ingest has stored.")
    _write_note(spark, f"{notes}/begun", request)
    wanted = checks.feature_checks(features) | checks.target_checks(label)
    if weight is not None:
        wanted |= checks.weight_checks(weight)
    if classify:
        wanted |= checks.class_checks(label)
    wanted |= {"n_stored": F.count(F.lit(1))}
    seen = Observation()
    watched = table.observe(seen, *[value.alias(name) for name, value in wanted.items()])
    watched.write.format(file_format).mode("overwrite").save(path)
    found = seen.get
    checks.judge({"n_rows": found["n_stored"], **found})
    _write_note(spark, f"{notes}/stored", request | {"n_stored": found["n_stored"]})
    return spark.read.format(file_format).load(path)


def _present(read):
    """What a read gives, or None if there is nothing at its path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _note(spark: SparkSession, path: str) -> dict | None:
    lines = _present(lambda: spark.read.text(path, wholetext=True))
    row = None if lines is None else lines.first()
    return None if row is None else json.loads(row[0])


def _write_note(spark: SparkSession, path: str, note: dict) -> None:
    text = spark.createDataFrame([(json.dumps(note),)], "note string")
    text.coalesce(1).write.mode("overwrite").text(path)


def _stored_table(spark: SparkSession, path: str, request: dict, stored: dict) -> DataFrame:
    """The table at the path, if it is what the same request has stored."""
    other = sorted(k for k in request if request[k] != stored.get(k))
    if other:
        raise ValueError(f"{path} was stored by another request; they differ in {other}.")
    table = _present(lambda: spark.read.format(request["file_format"]).load(path))
    columns = {} if table is None else {f.name: f.dataType.simpleString() for f in table.schema}
    if columns != request["columns"] or table.count() != stored["n_stored"]:
        raise ValueError(f"the table at {path} is not the one that was stored there.")
    return table


def dataset_summary(df: DataFrame, features: Sequence[str] | str, label: str) -> DataFrame:
    """One row per class: (label, n, n_samples, n_features)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    if not isinstance(features, str):
        return counts.select("label", "n", total.alias("n_samples"),
                             F.lit(len(features)).alias("n_features"))
    widths = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(features)).alias("_width")
    )
    return widths.select(
        "label", "n", total.alias("n_samples"),
        F.max("_width").over(Window.partitionBy()).alias("n_features"),
    )
