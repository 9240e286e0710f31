"""One Spark job that evaluates losses and gradients of a set of models over the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import (
    LOGIT_CLIP,
    PROBABILITY_EPS,
    SQL_PARAMETERS,
    SQL_UNITS,
    SQL_WIDTH,
)
from sparkfold.functions.scalar import sql_number
from sparkfold.operators.network import Net, batch_sums, unpack

ROWS_PER_TASK = 25_000  # a small table is spread over the cores down to this many rows per task
FEW_VALUES = 200_000  # values of all tasks that the driver adds up at most
SMALL_TABLE = 20_000_000  # a table beyond this many rows keeps the partitions of its scan


@dataclass(frozen=True)
class TrainingTable:
    """The narrow frame every pass reads: features, target, and what masks a row.

    Columns: ``_x0.._xN`` or one array ``_x``; ``_y``; optional ``_w`` (weight), ``_fold``,
    ``_vmask`` (holdout bits), ``_key`` (row hash), ``_batch``.
    """

    df: DataFrame
    width: int
    wide: bool
    n_rows: int
    head: DataFrame | None = None  # the same rows as they are scanned, before they are spread

    @property
    def x_columns(self) -> list[str]:
        return ["_x"] if self.wide else [f"_x{i}" for i in range(self.width)]

    def has(self, name: str) -> bool:
        return name in self.df.columns

    def cached(self) -> TrainingTable:
        """Kept in memory (spilling to disk) for the passes; lost blocks are recomputed."""
        spread = spread_rows(self.df, self.n_rows)
        return replace(self, df=spread.persist(StorageLevel.MEMORY_AND_DISK), head=self.df)

    def release(self) -> None:
        self.df.unpersist()


def spread_rows(df: DataFrame, n_rows: int, by: str | None = None) -> DataFrame:
    """A small table may sit in one file and thus one task; spread it over the cores."""
    tasks = spread_tasks(df, n_rows)
    if tasks is None:
        return df
    return df.repartition(tasks, by) if by else df.repartition(tasks)


def feature_columns(features: Sequence[str] | str, width: int) -> tuple[list[Column], bool]:
    """Feature columns of the training table, and whether they are one array."""
    if isinstance(features, str):
        if width <= SQL_WIDTH:
            return [
                F.get(features, F.lit(i)).cast("double").alias(f"_x{i}") for i in range(width)
            ], False
        return [F.col(features).cast("array<double>").alias("_x")], True
    columns = [F.col(name).cast("double") for name in features]
    if width <= SQL_WIDTH:
        return [c.alias(f"_x{i}") for i, c in enumerate(columns)], False
    return [F.array(*columns).alias("_x")], True


def matrix(batch: pa.RecordBatch, names: Sequence[str], width: int) -> np.ndarray:
    """Features of an Arrow batch as a matrix."""
    if names == ["_x"]:
        values = batch.column("_x").flatten().to_numpy(zero_copy_only=False)
        return values.reshape(-1, width)
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


BLOCK_COLUMNS = {"_y": "y", "_w": "w", "_fold": "fold", "_vmask": "vmask", "_key": "key"}


def block_of(batch: pa.RecordBatch, names: Sequence[str], width: int) -> dict:
    block = {"x": matrix(batch, names, width)}
    for column, name in BLOCK_COLUMNS.items():
        if column in batch.schema.names:
            block[name] = batch.column(column).to_numpy(zero_copy_only=False)
    block["y"] = block["y"].astype(float)
    return block


@dataclass(frozen=True)
class Sums:
    train_loss: float
    train_weight: float
    watch_loss: float
    watch_weight: float
    gradient: np.ndarray


def sum_arrays(df: DataFrame, task, length: int, tasks: int | None = None) -> np.ndarray:
    """Element-wise sum over tasks of a fixed-length vector.

    Each task sends its vector as (pos, value) rows; the sum is a shuffled aggregate, so the
    driver receives one vector whatever the number of tasks. Where ``tasks`` bounds their number and
    all of their values are few, the driver adds them up.
    """
    rows = df.mapInArrow(task, "pos int, value double")
    if tasks is None or tasks * length > FEW_VALUES:
        rows = rows.groupBy("pos").agg(F.sum("value").alias("value"))
    total = np.zeros(length)
    for pos, value in rows.collect():
        total[pos] += value
    return total


def spread_tasks(df: DataFrame, n_rows: int) -> int | None:
    """Number of tasks that a table is spread over; None for one that keeps those of its scan."""
    if n_rows > SMALL_TABLE:
        return None
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores, -(-n_rows // ROWS_PER_TASK)))


def few_tasks(df: DataFrame, n_rows: int) -> DataFrame:
    """Let a task take several partitions once there are far more of them than the session shuffles
    into: every task sends one vector, so fewer tasks mean fewer vectors to add up."""
    if n_rows <= SMALL_TABLE:
        return df
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(10 * shuffled, 4 * spark.sparkContext.defaultParallelism))


def vector_batch(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["pos", "value"]
    )


def gradient_task(nets, thetas, names, width, epoch):
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = batch_sums(nets, thetas, block_of(batch, names, width), epoch)
                total = part if total is None else total + part
        if total is not None:
            yield vector_batch(total)

    return run


def arrow_pass(
    table: TrainingTable, rows: DataFrame, nets: list[Net], thetas, epoch: int
) -> list[Sums]:
    """All models in one job, NumPy on Arrow batches."""
    names = table.x_columns
    keep = [c for c in BLOCK_COLUMNS if table.has(c) and (c != "_key" or _drops(nets))]
    length = sum(4 + net.size for net in nets)
    task = gradient_task(nets, thetas, names, table.width, epoch)
    source = few_tasks(rows.select(*names, *keep), table.n_rows)
    tasks = spread_tasks(table.df, table.n_rows) if rows is table.df else None
    total = sum_arrays(source, task, length, tasks)
    result, at = [], 0
    for net in nets:
        head, body = total[at : at + 4], total[at + 4 : at + 4 + net.size]
        at += 4 + net.size
        result.append(Sums(*head, gradient=body))
    return result


def _drops(nets) -> bool:
    return any(net.dropout > 0.0 for net in nets)


def fits_sql(table: TrainingTable, nets: list[Net]) -> bool:
    """A few small models without hidden layers over separate columns."""
    plain = all(
        len(net.shapes) == 1 and net.class_map is None and net.family != "softmax_net"
        for net in nets
    )
    if table.wide or not plain:
        return False
    units = sum(net.shapes[0][1] for net in nets)
    return units <= SQL_UNITS and sum(net.size for net in nets) <= SQL_PARAMETERS


def _case(column: str, values: Sequence[str], default: str) -> str:
    branches = " ".join(f"WHEN {k} THEN {value}" for k, value in enumerate(values))
    return f"CASE {column} {branches} ELSE {default} END"


def sql_pass(table: TrainingTable, rows: DataFrame, nets: list[Net], thetas) -> list[Sums]:
    """All models as plain aggregates: scan, score and sum in one compiled stage.

    The expressions are written as SQL text, which reaches the optimizer in a few calls; building
    them column by column would cost more than a pass over a small table.
    """
    stages: list[list[str]] = [[], [], [], [], []]
    sums: list[str] = []
    for m, (net, theta) in enumerate(zip(nets, thetas, strict=True)):
        for stage, texts in zip(stages, _model_text(table, net, theta, m), strict=True):
            stage += texts
        units = range(net.shapes[0][1])
        train, loss, watch = f"_train{m}", f"_loss{m}", f"_watch{m}"
        sums += [f"{loss} * {train}", train, f"{loss} * {watch}", watch]
        sums += [f"{name} * _r{m}_{k} * {train}" for name in table.x_columns for k in units]
        sums += [f"_r{m}_{k} * {train}" for k in units]
    scored = rows
    for stage in stages:
        if stage:
            scored = scored.selectExpr("*", *stage)
    row, = scored.selectExpr(*[f"sum({s}) AS s{i}" for i, s in enumerate(sums)]).collect()
    values = np.array([0.0 if v is None else v for v in row], dtype=float)
    result, at = [], 0
    for net in nets:
        result.append(Sums(*values[at : at + 4], gradient=values[at + 4 : at + 4 + net.size]))
        at += 4 + net.size
    return result


def _model_text(table: TrainingTable, net: Net, theta: np.ndarray, m: int) -> list[list[str]]:
    """Columns of model ``m``: logits, shift, exponentials, total, then loss, errors and weights."""
    (weights, bias), = unpack(theta, net.shapes)
    names, units = table.x_columns, range(len(bias))
    logits = [
        " + ".join([f"{n} * {sql_number(w)}" for n, w in zip(names, weights[:, k], strict=True)])
        + f" + {sql_number(bias[k])} AS _z{m}_{k}"
        for k in units
    ]
    low, high = sql_number(PROBABILITY_EPS), sql_number(1.0 - PROBABILITY_EPS)
    shift, exps, total = [], [], []
    if net.family == "softmax":
        top = ", ".join(f"_z{m}_{k}" for k in units)
        shift = [f"greatest({top}) AS _top{m}"]
        exps = [f"exp(_z{m}_{k} - _top{m}) AS _e{m}_{k}" for k in units]
        total = [" + ".join(f"_e{m}_{k}" for k in units) + f" AS _sum{m}"]
        own = _case("_y", [f"_e{m}_{k} / _sum{m}" for k in units], "0.0D")
        loss = f"-ln(greatest(least({own}, {high}), {low}))"
        errors = [f"_e{m}_{k} / _sum{m} - double(_y = {k})" for k in units]
    elif net.family == "logistic":
        clipped = f"greatest(least(_z{m}_0, {sql_number(LOGIT_CLIP)}), {sql_number(-LOGIT_CLIP)})"
        exps = [f"1.0D / (1.0D + exp(-{clipped})) AS _p{m}"]
        safe = f"greatest(least(_p{m}, {high}), {low})"
        loss = f"-ln(CASE WHEN _y = 1 THEN {safe} ELSE 1.0D - {safe} END)"
        errors = [f"_p{m} - _y"]
    else:
        half = 0.5 if net.family == "linear" else 1.0
        loss = f"(_z{m}_0 - _y) * (_z{m}_0 - _y) * {sql_number(half)}"
        errors = [f"(_z{m}_0 - _y) * {sql_number(2.0 * half)}"]
    weight = "_w" if table.has("_w") else "1.0D"
    if net.class_weight is not None:
        by_class = _case("_y", [sql_number(v) for v in net.class_weight], "0.0D")
        weight = f"{weight} * {by_class}"
    usable = "true" if net.fold < 0 else f"_fold <> {net.fold}"
    held = "false" if net.bit < 0 else f"shiftright(_vmask, {net.bit}) & 1 = 1"
    last = [
        f"{loss} AS _loss{m}",
        f"CASE WHEN {usable} AND NOT ({held}) THEN {weight} ELSE 0.0D END AS _train{m}",
        f"CASE WHEN {usable} AND ({held}) THEN {weight} ELSE 0.0D END AS _watch{m}",
        *[f"{error} AS _r{m}_{k}" for k, error in enumerate(errors)],
    ]
    return [logits, shift, exps, total, last]


def evaluate(
    table: TrainingTable, nets: list[Net], thetas, epoch: int, rows: DataFrame | None = None
) -> list[Sums]:
    """Losses and gradients of all models at their parameters, in one job."""
    source = table.df if rows is None else rows
    if fits_sql(table, nets):
        return sql_pass(table, source, nets, thetas)
    return arrow_pass(table, source, nets, thetas, epoch)
