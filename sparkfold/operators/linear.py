"""Linear regression from Gram sums: the closed form, and descent without touching rows again.

Loss and gradient of squared error are functions of a few sums (weight, means, centred second
moments), so one pass over the table serves every epoch, every fold and every candidate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import GRAM_SQL_WIDTH
from sparkfold.functions.scalar import sql_number
from sparkfold.operators.network import unpack
from sparkfold.operators.passes import SMALL_TABLE, Sums, TrainingTable, block_of, few_tasks
from sparkfold.operators.training import Run


@dataclass
class Gram:
    """Weighted sums of v = (x, y), shifted by a common centre, and the range of y."""

    n: float
    first: np.ndarray  # sum of v - centre
    second: np.ndarray  # sum of (v - centre)(v - centre)'
    low: float
    high: float

    def __add__(self, other: Gram) -> Gram:
        return Gram(
            self.n + other.n, self.first + other.first, self.second + other.second,
            min(self.low, other.low), max(self.high, other.high),
        )


def _group_columns(table: TrainingTable) -> list[str]:
    return [c for c in ("_fold", "_vmask") if table.has(c)]


CENTRE_ROWS = 256  # rows whose mean is the point that Gram sums are shifted by
GRAM_BLOCK = 256  # columns per block of a Gram matrix
BLOCK_GROUPS = 32  # groups of tasks whose blocks are summed before the groups are
GRAM_ROWS = "fold int, mask long, i int, j int, part int, low double, high double, data binary"


def gram_by_group(table: TrainingTable, centre: np.ndarray) -> dict[tuple, Gram]:
    """Gram sums per (fold, holdout mask): a handful of groups in one shuffle of sums."""
    keys = _group_columns(table)
    if not table.wide and table.width <= GRAM_SQL_WIDTH:
        return _gram_sql(table, centre, keys)
    return _gram_arrow(table, centre, keys)


def centre_of(table: TrainingTable) -> np.ndarray:
    """Column means of the first rows. Shifting by a point among the data keeps the later
    subtractions accurate; which point does not matter, so the table is not read for it."""
    columns = [F.col("_x") if table.wide else F.array(*table.x_columns)]
    scanned = table.df if table.head is None else table.head
    rows = scanned.select(*columns, F.col("_y").cast("double")).limit(CENTRE_ROWS).collect()
    return np.mean([[*x, y] for x, y in rows], axis=0, dtype=float)


def _gram_sql(table, centre, keys) -> dict[tuple, Gram]:
    size = table.width + 1
    names = [*table.x_columns, "_y"]
    moved = table.df.selectExpr(
        *keys,
        "double(_y) AS _y",
        *[f"{name} - {sql_number(centre[i])} AS _v{i}" for i, name in enumerate(names)],
        ("_w" if table.has("_w") else "1.0D") + " AS _g",
    )
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = [F.expr("sum(_g) AS n"), F.expr("min(_y) AS low"), F.expr("max(_y) AS high")]
    sums += [F.expr(f"sum(_g * _v{i}) AS f{i}") for i in range(size)]
    sums += [F.expr(f"sum(_g * _v{i} * _v{j}) AS s{i}_{j}") for i, j in pairs]
    result = {}
    for row in moved.groupBy(*keys).agg(*sums).collect():
        second = np.zeros((size, size))
        for i, j in pairs:
            second[i, j] = second[j, i] = row[f"s{i}_{j}"]
        first = np.array([row[f"f{i}"] for i in range(size)])
        result[tuple(row[k] for k in keys)] = Gram(
            row["n"], first, second, row["low"], row["high"]
        )
    return result


def column_blocks(size: int) -> list[tuple[int, int]]:
    """Bounds of the column blocks of a Gram matrix."""
    return [(a, min(a + GRAM_BLOCK, size)) for a in range(0, size, GRAM_BLOCK)]


def _gram_arrow(table, centre, keys) -> dict[tuple, Gram]:
    """Gram sums by matrix products on Arrow batches.

    Every task sends its upper block products, one row each; they are summed block by block, first
    in groups of tasks and then over the groups, so no reducer holds more than one block.
    """
    names, width, size = table.x_columns, table.width, table.width + 1
    keep = ["_y", *(c for c in ("_w",) if table.has(c)), *keys]
    bounds = column_blocks(size)

    def run(batches):
        totals: dict[tuple, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block = block_of(batch, names, width)
            v = np.column_stack([block["x"], block["y"]]) - centre
            w = block.get("w", np.ones(len(v)))
            fold = block.get("fold", np.zeros(len(v), int))
            mask = block.get("vmask", np.zeros(len(v), int))
            for key in set(zip(fold.tolist(), mask.tolist(), strict=True)):
                own = (fold == key[0]) & (mask == key[1])
                part, weight, y = v[own], w[own], block["y"][own]
                weighted = part * weight[:, None]
                sums = totals.setdefault(
                    key, [np.zeros(1 + size), np.zeros((size, size)), np.inf, -np.inf]
                )
                sums[0] += np.append(weight.sum(), weighted.sum(axis=0))
                for a, b in bounds:
                    sums[1][a:b, a:] += weighted[:, a:b].T @ part[:, a:]
                sums[2], sums[3] = min(sums[2], y.min()), max(sums[3], y.max())
        task = TaskContext.get().partitionId()
        for (fold, mask), (first, second, low, high) in totals.items():
            for i, j, data in _blocks(first, second, bounds):
                yield _block_batch(fold, mask, i, j, task, low, high, data)

    rows = few_tasks(table.df.select(*names, *keep), table.n_rows).mapInArrow(run, GRAM_ROWS)
    # a small table has a task per core at most: their single blocks are added here
    small = len(bounds) == 1 and table.n_rows <= SMALL_TABLE
    found: dict[tuple, list] = {}
    for r in (rows if small else sum_blocks(rows)).collect():
        parts = found.setdefault(
            (r["fold"], r["mask"]), [np.zeros(1 + size), np.zeros((size, size)), np.inf, -np.inf]
        )
        data = np.frombuffer(r["data"])
        if r["i"] < 0:
            parts[0] += data
        else:
            (a, b), (c, d) = bounds[r["i"]], bounds[r["j"]]
            parts[1][a:b, c:d] += data.reshape(b - a, d - c)
        parts[2], parts[3] = min(parts[2], r["low"]), max(parts[3], r["high"])
    result = {}
    for (fold, mask), (first, second, low, high) in found.items():
        second = np.triu(second) + np.triu(second, 1).T
        labelled = {"_fold": fold, "_vmask": mask}
        result[tuple(labelled[k] for k in keys)] = Gram(first[0], first[1:], second, low, high)
    return result


def _blocks(first, second, bounds):
    """(row block, column block, values) of the sums; the first moments are block (-1, -1)."""
    yield -1, -1, first
    for i, (a, b) in enumerate(bounds):
        for j in range(i, len(bounds)):
            c, d = bounds[j]
            yield i, j, second[a:b, c:d]


def _block_batch(fold, mask, i, j, part, low, high, data) -> pa.RecordBatch:
    row = {"fold": fold, "mask": mask, "i": i, "j": j, "part": part, "low": low, "high": high}
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
    columns = [pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)]
    values = pa.array([np.ascontiguousarray(data, dtype=float).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([*columns, values], names=[*row, "data"])


def sum_blocks(rows: DataFrame) -> DataFrame:
    """Sum of the blocks (fold, mask, i, j, part, ..., data) over their parts, in two rounds."""
    keys = ["fold", "mask", "i", "j", "part"]

    def run(batches):
        held, total, low, high = None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                key, data = tuple(row[k] for k in keys), np.frombuffer(row["data"])
                if key == held:
                    total = total + data
                    low, high = min(low, row["low"]), max(high, row["high"])
                else:
                    if held is not None:
                        yield _block_batch(*held, low, high, total)
                    held, total, low, high = key, data, row["low"], row["high"]
        if held is not None:
            yield _block_batch(*held, low, high, total)

    for groups in (BLOCK_GROUPS, 1):
        rows = rows.withColumn("part", F.col("part") % groups)
        dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
        rows = dealt.mapInArrow(run, GRAM_ROWS)
    return rows


def select_gram(
    table: TrainingTable, grams: dict[tuple, Gram], fold: int, bit: int, watched: bool
) -> Gram | None:
    """Sum of the groups one model trains on (or watches)."""
    keys = _group_columns(table)
    chosen = None
    for key, gram in grams.items():
        at = dict(zip(keys, key, strict=True))
        if fold >= 0 and at.get("_fold") == fold:
            continue
        held = bit >= 0 and (at.get("_vmask", 0) >> bit) & 1 == 1
        if held == watched:
            chosen = gram if chosen is None else chosen + gram
    return chosen


def closed_form(
    gram: Gram, centre: np.ndarray, l2: float, fit_intercept: bool
) -> tuple[np.ndarray, float]:
    """Least squares from the sums; the pseudo-inverse gives the minimum-norm answer when the
    features are dependent. The strength is not divided by the number of rows."""
    c, n = centre, gram.n
    first = gram.first + n * c
    second = (
        gram.second + np.outer(gram.first, c) + np.outer(c, gram.first) + n * np.outer(c, c)
    )
    d = len(c) - 1
    if not fit_intercept:
        solution = np.linalg.pinv(second[:d, :d] + l2 * np.eye(d)) @ second[:d, d]
        return solution, 0.0
    normal = np.empty((d + 1, d + 1))
    normal[0, 0] = n
    normal[0, 1:] = normal[1:, 0] = first[:d]
    normal[1:, 1:] = second[:d, :d] + l2 * np.eye(d)
    solution = np.linalg.pinv(normal) @ np.concatenate([[first[d]], second[:d, d]])
    return solution[1:], float(solution[0])


def squared_error_sums(gram: Gram, centre, weights, bias) -> tuple[float, np.ndarray, float]:
    """(sum of squared errors, gradient by weights, gradient by bias) of half squared error."""
    d = len(weights)
    direction = np.append(weights, -1.0)
    shift = float(direction @ centre + bias)
    along = gram.second @ direction
    total = float(direction @ along + 2.0 * shift * (direction @ gram.first) + shift**2 * gram.n)
    error_sum = float(direction @ gram.first + shift * gram.n)
    by_weight = along[:d] + shift * gram.first[:d] + centre[:d] * error_sum
    return max(total, 0.0), by_weight, error_sum


def gram_evaluation(
    table: TrainingTable, grams: dict[tuple, Gram], centre: np.ndarray
) -> Callable[[Sequence[Run], int], list[Sums]]:
    """Evaluation of linear models from the sums alone: no job per epoch."""

    def evaluation(active, epoch):
        results = []
        for run in active:
            net = run.net
            (weights, bias), = unpack(run.theta, net.shapes)
            w, b = weights[:, 0], float(bias[0])
            train = select_gram(table, grams, net.fold, net.bit, False)
            error, by_weight, by_bias = squared_error_sums(train, centre, w, b)
            watched = (0.0, 0.0)
            if net.bit >= 0:
                held = select_gram(table, grams, net.fold, net.bit, True)
                watched = (squared_error_sums(held, centre, w, b)[0] / 2.0, held.n)
            gradient = np.append(by_weight, by_bias)
            results.append(Sums(error / 2.0, train.n, *watched, gradient=gradient))
        return results

    return evaluation
