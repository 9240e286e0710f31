"""Training loops: Spark jobs give losses and gradients, the driver holds parameters only.

A model whose rule says stop is frozen; the job of the next epoch evaluates only the others, so a
whole search costs one job per epoch however many models are in it.
"""

from __future__ import annotations

from base64 import b64decode, b64encode
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.functions.losses import penalty_sum
from sparkfold.operators.network import Net, batch_sums, unpack, weight_positions
from sparkfold.operators.order import shuffle_key
from sparkfold.operators.passes import (
    BLOCK_COLUMNS,
    Sums,
    TrainingTable,
    block_of,
    evaluate,
    sum_arrays,
    vector_batch,
)
from sparkfold.operators.specs import Descent
from sparkfold.operators.splits import mini_batches
from sparkfold.operators.updates import History, StopRule, Update, scheduled_rate


BARRIER_ROWS = 2048  # rows of a batch per task of a barrier stage at least
SEGMENT_ROWS = 2_000_000  # rows of consecutive batches per task of a barrier stage at most, ...
SEGMENT_PARTS = 4  # ... kept in this many partitions per task
SHARDS = 8  # shards of row-by-row training at least, unless the estimator names a number, ...
SHARD_ROWS = 1_000_000  # ... and rows of one at most
WINDOW = 4096  # rows of a shard that are shuffled among themselves in an epoch


@dataclass
class Run:
    """One model in training."""

    spec: Descent
    net: Net
    theta: np.ndarray
    penalty: str | None
    strength: float
    fit_intercept: bool = True
    update: Update = field(init=False)
    stop: StopRule = field(init=False)
    history: History = field(default_factory=History)
    done: bool = False
    converged: bool = False

    def __post_init__(self) -> None:
        self.update = Update(self.spec.optimizer)
        self.stop = StopRule(self.spec.tol, self.spec.n_iter_no_change, self.spec.gradient_tol)
        self.is_weight = weight_positions(self.net.shapes)

    @property
    def weights(self) -> np.ndarray:
        return self.theta[self.is_weight]

    def rate(self) -> float:
        spec = self.spec
        epoch = len(self.history.rows)
        return scheduled_rate(
            spec.learning_rate_schedule, spec.learning_rate, epoch, spec.max_iter
        )

    def gradient(self, sums: Sums) -> np.ndarray:
        """Mean gradient with the penalty; biases are never penalised."""
        total = positive(sums.train_weight)
        slope = np.zeros_like(self.theta)
        if self.penalty == "l2":
            slope = np.where(self.is_weight, self.theta, 0.0)
        elif self.penalty == "l1":
            slope = np.where(self.is_weight, np.sign(self.theta), 0.0)
        gradient = (sums.gradient + self.strength * slope) / total
        return gradient if self.fit_intercept else np.where(self.is_weight, gradient, 0.0)

    def losses(self, sums: Sums) -> tuple[float, float | None]:
        extra = penalty_sum(self.weights, self.penalty, self.strength)
        train = (sums.train_loss + extra) / positive(sums.train_weight)
        if self.net.bit < 0:
            return train, None
        return train, (sums.watch_loss + extra) / positive(sums.watch_weight)

    def close_epoch(self, sums: Sums, grad_norm: float, rate: float) -> None:
        """Record the epoch and decide whether the model is finished."""
        train, watched = self.losses(sums)
        self.history.add(train, watched, grad_norm, np.linalg.norm(self.theta), rate)
        if self.stop.reached(train if watched is None else watched, grad_norm):
            self.done = self.converged = True
        elif len(self.history.rows) >= self.spec.max_iter:
            self.done = True


def positive(total: float) -> float:
    if not total > 0.0:
        raise ValueError("sample weights must add up to a positive value.")
    return total


Evaluation = Callable[[Sequence[Run], int], list[Sums]]


def descend(runs: Sequence[Run], evaluation: Evaluation) -> None:
    """Full-batch descent. The loss after a step and the gradient for the next one are taken at
    the same parameters, so one evaluation per epoch (and one at the start) gives both."""
    active = list(runs)
    sums = dict(zip(map(id, active), evaluation(active, 0), strict=True))
    epoch = 0
    while active:
        epoch += 1
        norms, rates = {}, {}
        for run in active:
            gradient = run.gradient(sums[id(run)])
            norms[id(run)], rates[id(run)] = float(np.linalg.norm(gradient)), run.rate()
            run.theta = run.update.move(run.theta, gradient, rates[id(run)])
        sums = dict(zip(map(id, active), evaluation(active, epoch), strict=True))
        for run in active:
            run.close_epoch(sums[id(run)], norms[id(run)], rates[id(run)])
        active = [run for run in active if not run.done]


def train_full_batch(runs: Sequence[Run], table: TrainingTable) -> None:
    def evaluation(active, epoch):
        return evaluate(table, [r.net for r in active], [r.theta for r in active], epoch)

    descend(runs, evaluation)


def usable_rows(table: TrainingTable, net: Net) -> DataFrame:
    """The rows that a model trains on."""
    usable = table.df
    if net.fold >= 0:
        usable = usable.filter(F.col("_fold") != net.fold)
    if net.bit >= 0:
        usable = usable.filter(F.shiftright("_vmask", net.bit).bitwiseAND(F.lit(1)) == 0)
    return usable


def train_mini_batches(run: Run, table: TrainingTable, id_col: str) -> None:
    """Mini-batch descent with one job per segment of an epoch (and one for the epoch's losses).

    Batches are cut from the shuffled order of the training rows. The rows of every batch are dealt
    over the tasks of a barrier stage, sorted by batch; the tasks exchange their parts of the
    gradient and all make the same step. A lost task restarts the segment from its parameters.
    """
    usable = usable_rows(table, run.net)
    n_rows = usable.count()
    step = _epoch_by_barrier if barriers_run(usable.sparkSession) else _epoch_by_jobs
    spec = run.spec
    while not run.done:
        epoch, rate = len(run.history.rows), run.rate()
        batches = mini_batches(
            usable, id_col, epoch=epoch, batch_size=spec.batch_size, shuffle=spec.shuffle,
            seed=spec.seed, out="_batch", n_rows=n_rows,
        )
        norm = step(run, table, batches, id_col, epoch, rate, -(-n_rows // batches.count))
        after, = evaluate(table, [run.net], [run.theta], epoch)
        run.close_epoch(after, norm, rate)


def barriers_run(spark) -> bool:
    """Whether barrier stages can run: they need a fixed number of slots."""
    return spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true"


def barrier_tasks(spark, batch_rows: int) -> int:
    """Tasks of a barrier stage: enough rows of a batch for each, and no more than there are slots."""
    return max(1, min(spark.sparkContext.defaultParallelism, batch_rows // BARRIER_ROWS))


def segment_batches(batch_rows: int, tasks: int) -> int:
    """Consecutive batches of a barrier stage: as many as leave SEGMENT_ROWS rows per task."""
    return max(1, SEGMENT_ROWS * tasks // batch_rows)


def _epoch_by_barrier(run, table, batches, id_col, epoch, rate, batch_rows) -> float:
    """An epoch in segments of consecutive batches, one barrier stage each, whose rows per task do
    not grow with the table. The parameters go from one to the next by the driver."""
    tasks = barrier_tasks(table.df.sparkSession, batch_rows)
    keep = [c for c in (*BLOCK_COLUMNS, "_batch") if c in batches.df.columns]
    rows = batches.df.select(*table.x_columns, *keep, id_col)
    size = segment_batches(batch_rows, tasks)
    segments = -(-batches.count // size)
    if segments == 1:
        return _walk_batches(run, table, rows, id_col, epoch, rate, tasks, range(batches.count))
    # a segment's rows are in partitions of their own, so that the others are passed over
    parts = tasks * SEGMENT_PARTS
    place = F.col("_segment") * parts + F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int")
    kept = (
        rows.withColumn("_segment", F.expr(f"_batch div {size}").cast("int"))
        .repartitionById(segments * parts, place)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        for segment in range(segments):
            own = kept.filter(F.col("_segment") == segment).drop("_segment")
            numbers = range(segment * size, min((segment + 1) * size, batches.count))
            norm = _walk_batches(run, table, own, id_col, epoch, rate, tasks, numbers)
    finally:
        kept.unpersist()
    return norm


def _walk_batches(run, table, rows, id_col, epoch, rate, tasks: int, numbers: range) -> float:
    """The steps of the numbered batches in one barrier stage; the norm of the last gradient."""
    dealt = rows.repartition(tasks, id_col).sortWithinPartitions("_batch", id_col).drop(id_col)
    work = barrier_task(run, table.x_columns, table.width, numbers, rate, epoch)
    size = len(run.theta)
    state = np.zeros(3 * size + 2)
    for pos, value in dealt.mapInArrow(work, "pos int, value double", barrier=True).collect():
        state[pos] = value
    run.theta, run.update.first, run.update.second = np.split(state[:-2], 3)
    run.update.steps = int(state[-2])
    return float(state[-1])


def batch_blocks(batches, names, width: int, count: int, first: int = 0):
    """Rows of batch first, first + 1, ... below count of Arrow batches sorted by batch; None for one
    without rows here."""
    held: list[dict] = []
    at = first

    def joined():
        if not held:
            return None
        return {k: np.concatenate([part[k] for part in held]) for k in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        block = block_of(batch, names, width)
        number = batch.column("_batch").to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(np.diff(number)) + 1), len(number)]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            while at < number[begin]:
                yield joined()
                held, at = [], at + 1
            held.append({k: v[begin:end] for k, v in block.items()})
    while at < count:
        yield joined()
        held, at = [], at + 1


def barrier_task(run: Run, names, width: int, numbers: range, rate: float, epoch: int):
    """The steps of the numbered batches; the first task answers with parameters, the rule's memory
    and the norm of the last gradient."""
    net, length = run.net, 4 + run.net.size

    def work(batches):
        context = BarrierTaskContext.get()
        alone = len(context.getTaskInfos()) == 1
        norm = 0.0
        for block in batch_blocks(batches, names, width, numbers.stop, numbers.start):
            part = np.zeros(length)
            if block is not None:
                part = batch_sums([net], [run.theta], block, epoch)
            total = part
            if not alone:
                # added in the order of the tasks: every task gets the same bits
                parts = context.allGather(b64encode(part.tobytes()).decode())
                total = sum(np.frombuffer(b64decode(p)) for p in parts)
            gradient = run.gradient(Sums(*total[:4], gradient=total[4:]))
            run.theta = run.update.move(run.theta, gradient, rate)
            norm = float(np.linalg.norm(gradient))
        if context.partitionId() == 0:
            memory = [run.update.first, run.update.second]
            memory = [np.broadcast_to(m, run.theta.shape) for m in memory]
            yield vector_batch(np.concatenate([run.theta, *memory, [run.update.steps, norm]]))

    return work


def _epoch_by_jobs(run, table, batches, id_col, epoch, rate, batch_rows) -> float:
    """The same with a job per batch, where barrier stages cannot run."""
    kept = batches.df.sortWithinPartitions("_batch").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for batch in range(batches.count):
            rows = kept.filter(F.col("_batch") == batch)
            sums, = evaluate(table, [run.net], [run.theta], epoch, rows)
            gradient = run.gradient(sums)
            run.theta = run.update.move(run.theta, gradient, rate)
    finally:
        kept.unpersist()
    return float(np.linalg.norm(gradient))


def shard_windows(batches, names, width: int):
    """(shard, block) of up to WINDOW rows of Arrow batches sorted by shard, ordered by their turn.

    The windows are cut from the fixed order of the shard's rows, the turn changes every epoch.
    """
    held: list[dict] = []
    shard, rows = None, 0

    def window():
        block = {k: np.concatenate([part[k] for part in held]) for k in held[0]}
        order = np.argsort(block.pop("turn"), kind="stable")
        return shard, {k: v[order] for k, v in block.items()}

    for batch in batches:
        block = block_of(batch, names, width)
        block["turn"] = batch.column("_turn").to_numpy(zero_copy_only=False)
        shards = batch.column("_shard").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(shards):
            if held and (shards[at] != shard or rows == WINDOW):
                yield window()
                held, rows = [], 0
            if shards[at] != shard:
                shard, rows = shards[at], 0
            end = min(int(np.searchsorted(shards, shard, side="right")), at + WINDOW - rows)
            held.append({k: v[at:end] for k, v in block.items()})
            rows, at = rows + end - at, end
    if held:
        yield window()


def local_task(run: Run, theta, rate: float, names, width: int, size: int, epoch: int):
    """Each shard walks through its own rows in order, ``size`` rows per step, from the shared
    parameters; a task answers with the sum of its shards' parameters times their rows, and the
    rows. The memory of the update rule starts anew in every shard and epoch.
    """
    net = run.net

    def work(batches):
        total = np.zeros(len(theta) + 1)
        shard, rule, seen, waiting, count = None, None, 0, [], 0

        def step(block):
            sums = batch_sums([net], [run.theta], block, epoch)
            if sums[1] > 0.0:
                gradient = run.gradient(Sums(*sums[:4], gradient=sums[4:]))
                run.theta = rule.move(run.theta, gradient, rate)

        def joined():
            return {k: np.concatenate([part[k] for part in waiting]) for k in waiting[0]}

        def finish():
            if count:
                step(joined())
            total[:-1] += run.theta * seen
            total[-1] += seen

        for own, block in shard_windows(batches, names, width):
            if own != shard:
                if shard is not None:
                    finish()
                shard, seen, waiting, count = own, 0, [], 0
                run.theta, rule = theta.copy(), Update(run.spec.optimizer)
            rows = len(block["y"])
            seen, count = seen + rows, count + rows
            waiting.append(block)
            if count >= size:
                block = joined()
                full = count - count % size
                for at in range(0, full, size):
                    step({k: v[at : at + size] for k, v in block.items()})
                waiting, count = [{k: v[full:] for k, v in block.items()}], count - full
        if shard is not None:
            finish()
            yield vector_batch(total)

    return work


def shard_number(seed: int, id_col: str, shards: int):
    """Shard of a row: the leading digits of an md5 of its id."""
    digits = F.substring(shuffle_key(f"{seed}:shard", id_col), 1, 13)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(shards)).cast("int")


def shard_count(spec: Descent, n_rows: int) -> int:
    """The named number of shards, else as many as keep them below SHARD_ROWS rows."""
    return spec.shards or max(SHARDS, -(-n_rows // SHARD_ROWS))


def shard_tasks(spark, shards: int) -> int:
    """Tasks that walk through the shards; they change no result."""
    return min(shards, 4 * spark.sparkContext.defaultParallelism)


def train_local(run: Run, table: TrainingTable, id_col: str) -> None:
    """Row-by-row descent inside shards, parameters averaged over the shards once per epoch
    (parallel stochastic descent; Zinkevich, Weimer, Smola and Li, 2010).

    A row's shard and its place there depend on the seed and its id only, so the outcome does not
    depend on partitions or tasks. Shards are averaged with their rows as weights, inside tasks
    first and then over the tasks. Rows are sorted once; an epoch takes them in that order, window by
    window, each window in an order of its own.
    """
    spec = run.spec
    names, size = table.x_columns, spec.batch_size or 1
    usable = usable_rows(table, run.net)
    shards = shard_count(spec, table.n_rows)
    tasks = shard_tasks(usable.sparkSession, shards)
    placed = (
        usable.withColumn("_shard", shard_number(spec.seed, id_col, shards))
        .repartitionById(tasks, F.col("_shard") % tasks)
        .withColumn("_walk", shuffle_key(f"{spec.seed}:walk", id_col))
        .sortWithinPartitions("_shard", "_walk", id_col).drop("_walk")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        while not run.done:
            epoch, rate = len(run.history.rows), run.rate()
            digits = F.substring(shuffle_key(f"{spec.seed}:{epoch}", id_col), 1, 13)
            turn = F.conv(digits, 16, 10).cast("long") if spec.shuffle else F.lit(0).cast("long")
            task = local_task(run, run.theta, rate, names, table.width, size, epoch)
            rows = placed.withColumn("_turn", turn).drop(id_col)
            total = sum_arrays(rows, task, len(run.theta) + 1, tasks)
            moved = total[:-1] / total[-1]
            change = np.linalg.norm(moved - run.theta) / rate
            run.theta = moved
            after, = evaluate(table, [run.net], [run.theta], epoch)
            run.close_epoch(after, float(change), rate)
    finally:
        placed.unpersist()


def named_parameters(run: Run, binary: bool, network: bool) -> dict[str, np.ndarray]:
    """Flat parameters as named arrays."""
    layers = unpack(run.theta, run.net.shapes)
    if network:
        named = {}
        for i, (weights, bias) in enumerate(layers):
            named[f"{i}.weights"], named[f"{i}.bias"] = weights, bias
        return named
    (weights, bias), = layers
    return {"weights": weights[:, 0] if binary else weights, "bias": bias}
