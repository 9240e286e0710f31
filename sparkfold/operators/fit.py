"""Fitting: one table of checked, encoded rows; any number of models trained on it together."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.constants import START_SCALE
from sparkfold.operators import checks
from sparkfold.operators.encode import class_index, resolve_class_weight
from sparkfold.operators.linear import (
    centre_of,
    closed_form,
    gram_by_group,
    gram_evaluation,
    select_gram,
    squared_error_sums,
)
from sparkfold.operators.models import Model, feature_names
from sparkfold.operators.network import Net, pack
from sparkfold.operators.passes import TrainingTable, feature_columns
from sparkfold.operators.specs import (
    LinearRegression,
    LogisticRegression,
    MajorityClass,
    MeanTarget,
    MLPClassifier,
    MLPRegressor,
    is_classifier,
)
from sparkfold.operators.splits import holdout_condition
from sparkfold.operators.training import (
    Run,
    descend,
    named_parameters,
    train_full_batch,
    train_local,
    train_mini_batches,
)
from sparkfold.operators.updates import History

MASK_BITS = 62


@dataclass(frozen=True)
class Job:
    """One model to train: its settings and the fold it must not see (-1 for none)."""

    spec: object
    fold: int = -1


def fit(
    spec,
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    *,
    id_col: str | None = None,
    weight: str | None = None,
) -> Model:
    """Fit one model. ``id_col`` is needed whenever rows are drawn or ordered: early stopping,
    mini-batches, shards and dropout."""
    return fit_all([Job(spec)], df, features, label, id_col=id_col, weight=weight)[0]


def fit_all(
    jobs: Sequence[Job],
    df: DataFrame,
    features: Sequence[str] | str,
    label: str,
    *,
    id_col: str | None = None,
    weight: str | None = None,
    fold_col: str | None = None,
) -> list[Model]:
    """Fit many models over the same rows in shared passes."""
    kinds = {is_classifier(job.spec) for job in jobs}
    if len(kinds) != 1:
        raise ValueError("classifiers and regressors cannot be fitted together.")
    return Fitting(df, features, label, id_col, weight, fold_col, kinds.pop()).run(jobs)


def needs_rows(spec) -> bool:
    """Whether training looks at single rows: batches, shards or dropout."""
    return getattr(spec, "batch_strategy", "batch") != "batch" or getattr(spec, "dropout_rate", 0.0) > 0.0


class Fitting:
    """Checked rows that models are trained on, in one go or, inside ``shared``, in several."""

    def __init__(self, df, features, label, id_col, weight, fold_col, classify) -> None:
        self.kept: TrainingTable | None = None  # the table of ``shared``, while it is open
        self.grams: tuple | None = None  # its sums, once a linear model has needed them
        self.known: dict[tuple, int] = {}  # its holdout bits
        self.features = feature_names(features)
        self.label, self.id_col, self.weight = label, id_col, weight
        self.fold_col, self.classify = fold_col, classify
        self.df = df
        checks.require_columns(df, features)
        wanted = checks.feature_checks(features) | checks.target_checks(label)
        if weight is not None:
            wanted |= checks.weight_checks(weight)
        if classify:
            checks.require_class_type(df, label)
        self.counts: dict[int, dict[int, int]] = {}
        if classify:
            by = [fold_col] if fold_col else []
            found, rows = checks.require_by_class(df, wanted, label, *by)
            for row in rows:
                fold = row[fold_col] if fold_col else -1
                self.counts.setdefault(fold, {})[row["label"]] = row["n"]
        else:
            found = checks.require(df, wanted)
        self.n_rows = found["n_rows"]
        self.width = found.get("min_width") or len(self.features)
        self.classes = sorted({c for counts in self.counts.values() for c in counts})

    def training_counts(self, fold: int) -> dict[int, int]:
        """Label counts outside a fold."""
        total: dict[int, int] = {}
        for key, counts in self.counts.items():
            if key != fold or fold < 0:
                for label, n in counts.items():
                    total[label] = total.get(label, 0) + n
        return dict(sorted(total.items()))

    # --- the training table ---------------------------------------------------------------

    def table(self, conditions, with_rows: bool = False) -> TrainingTable:
        """The narrow training table; ``with_rows`` adds the id and its hash."""
        columns, wide = feature_columns(self.features, self.width)
        if self.classify:
            target = class_index(self.label, self.classes)
        else:
            target = F.col(self.label).cast("double")
        columns = [*columns, target.alias("_y")]
        if self.weight is not None:
            columns.append(F.col(self.weight).cast("double").alias("_w"))
        if self.fold_col is not None:
            columns.append(F.col(self.fold_col).cast("int").alias("_fold"))
        if conditions:
            mask = F.lit(0).cast("long")
            for bit, condition in enumerate(conditions):
                mask = mask + F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
            columns.append(mask.alias("_vmask"))
        if with_rows and self.id_col is not None:
            columns += [F.col(self.id_col).alias("_id"), F.xxhash64(self.id_col).alias("_key")]
        return TrainingTable(self.df.select(*columns), self.width, wide, self.n_rows)

    def holdouts(self, jobs, known: dict[tuple, int] | None = None) -> tuple[list[int], list]:
        """Holdout bit of every job (-1 for none) and the condition of every bit not known yet."""
        bits, conditions = [], []
        known = {} if known is None else known
        for job in jobs:
            spec = job.spec
            if not getattr(spec, "early_stopping", False) or spec.validation_fraction == 0.0:
                bits.append(-1)
                continue
            key = (job.fold, spec.validation_fraction, spec.seed)
            if key not in known:
                rows = self.df
                if job.fold >= 0:
                    rows = rows.filter(F.col(self.fold_col) != job.fold)
                condition = holdout_condition(
                    rows, self._id("early stopping"), fraction=spec.validation_fraction,
                    seed=spec.seed,
                )
                known[key] = len(known)
                conditions.append(condition)
            bits.append(known[key])
        return bits, conditions

    def _id(self, purpose: str) -> str:
        if self.id_col is None:
            raise ValueError(f"{purpose} needs id_col.")
        return self.id_col

    # --- models ---------------------------------------------------------------------------

    def run(self, jobs: Sequence[Job]) -> list[Model]:
        models: dict[int, Model] = {}
        iterative = []
        for at, job in enumerate(jobs):
            if isinstance(job.spec, MajorityClass):
                models[at] = self.majority(job)
            elif isinstance(job.spec, MeanTarget):
                models[at] = self.mean(job)
            else:
                iterative.append(at)
        # holdout bits fit into one long; a larger search is trained in several stacks
        for start in range(0, len(iterative), MASK_BITS):
            part = iterative[start : start + MASK_BITS]
            for at, model in zip(part, self.train([jobs[i] for i in part]), strict=True):
                models[at] = model
        return [models[at] for at in range(len(jobs))]

    def majority(self, job: Job) -> Model:
        counts = self.training_counts(job.fold)
        if not counts:
            raise ValueError("the table has no target.")
        top = min(counts, key=lambda label: (-counts[label], label))
        return Model(
            "majority", self.features, self.width, {"label": np.array([top])}, sorted(counts)
        )

    def mean(self, job: Job) -> Model:
        rows, target = self.df, F.col(self.label).cast("double")
        if self.kept is not None:
            rows, target = self.kept.df, F.col("_y")
        if job.fold >= 0:
            rows = rows.filter(F.col(self.fold_col if self.kept is None else "_fold") != job.fold)
        value = rows.agg(F.avg(target)).first()[0]
        return Model("mean", self.features, self.width, {"mean": np.array([value])})

    @contextmanager
    def shared(self, jobs: Sequence[Job]) -> Iterator[TrainingTable]:
        """One kept table for all of these jobs, to be trained in any number of runs.

        With more holdouts than a mask has bits the table has none, and every run makes its own.
        """
        _, conditions = self.holdouts(jobs, self.known)
        fits = len(conditions) <= MASK_BITS
        rows = any(needs_rows(job.spec) for job in jobs)
        table = self.table(conditions if fits else [], rows).cached()
        if fits:
            self.kept = table
        try:
            yield table
        finally:
            table.release()
            self.kept, self.grams, self.known = None, None, {}

    def train(self, jobs: list[Job]) -> list[Model]:
        if self.kept is not None:
            bits, _ = self.holdouts(jobs, self.known)
            return self._train(jobs, bits, self.kept)
        bits, conditions = self.holdouts(jobs)
        table = self.table(conditions, any(needs_rows(job.spec) for job in jobs)).cached()
        try:
            return self._train(jobs, bits, table)
        finally:
            table.release()

    def _train(self, jobs, bits, table) -> list[Model]:
        runs = [self.new_run(job, bit) for job, bit in zip(jobs, bits, strict=True)]
        sums_only = [
            r for r in runs
            if isinstance(r.spec, LinearRegression)
            and (r.spec.solver == "normal_equation" or r.spec.batch_strategy == "batch")
        ]
        if sums_only:
            self.train_on_sums(sums_only, table)
        rest = [r for r in runs if r not in sums_only]
        together = [r for r in rest if r.spec.batch_strategy == "batch"]
        if together:
            train_full_batch(together, table)
        for run in rest:
            if run.spec.batch_strategy == "mini_batch":
                self._id("mini-batch training")
                train_mini_batches(run, table, "_id")
            elif run.spec.batch_strategy == "stochastic":
                self._id("stochastic training")
                train_local(run, table, "_id")
        return [self.model(job, run) for job, run in zip(jobs, runs, strict=True)]

    def sums(self, table: TrainingTable) -> tuple[np.ndarray, dict]:
        """Centre and Gram sums of the table; taken once of a shared one."""
        if self.grams is not None:
            return self.grams
        centre = centre_of(table)
        found = centre, gram_by_group(table, centre)
        if table is self.kept:
            self.grams = found
        return found

    def train_on_sums(self, runs, table) -> None:
        centre, grams = self.sums(table)
        exact = [r for r in runs if r.spec.solver == "normal_equation"]
        for run in exact:
            # the closed form has no epochs, so it keeps no rows aside
            gram = select_gram(table, grams, run.net.fold, -1, False)
            l2 = run.strength if run.penalty == "l2" else 0.0
            weights, bias = closed_form(gram, centre, l2, run.fit_intercept)
            run.theta = np.append(weights, bias)
            error = squared_error_sums(gram, centre, weights, bias)[0]
            sums_loss = 0.5 * error / gram.n
            if run.penalty == "l2":
                sums_loss += run.strength * float(weights @ weights) / (2.0 * gram.n)
            run.history = History()
            run.history.add(sums_loss, None, None, np.linalg.norm(weights), None)
            run.done = run.converged = True
        stepped = [r for r in runs if r.spec.solver == "gradient_descent"]
        if stepped:
            descend(stepped, gram_evaluation(table, grams, centre))

    def new_run(self, job: Job, bit: int) -> Run:
        spec, d = job.spec, self.width
        rng = np.random.default_rng(spec.seed)
        if isinstance(spec, LinearRegression):
            net = Net("linear", ((d, 1),), fold=job.fold, bit=bit)
            return Run(
                spec, net, np.zeros(d + 1), spec.penalty, spec.regularization_strength,
                spec.fit_intercept,
            )
        if isinstance(spec, MLPRegressor):
            return self.network_run(job, bit, "mse", 1, None, None, rng)
        local = list(self.training_counts(job.fold))
        if len(local) < 2:
            raise ValueError("classification needs at least two classes.")
        class_map = None
        if local != self.classes:
            class_map = np.array([local.index(c) if c in local else -1 for c in self.classes])
        if isinstance(spec, MLPClassifier):
            return self.network_run(job, bit, "softmax_net", len(local), class_map, None, rng)
        by_label = resolve_class_weight(spec.class_weight, self.training_counts(job.fold))
        class_weight = None
        if any(w != 1.0 for w in by_label.values()):
            class_weight = np.array([by_label.get(c, 0.0) for c in self.classes])
        binary = spec.multi_class == "auto" and len(local) == 2
        outputs = 1 if binary else len(local)
        net = Net(
            "logistic" if binary else "softmax", ((d, outputs),), fold=job.fold, bit=bit,
            class_weight=class_weight, class_map=class_map,
        )
        if spec.start == "zeros":
            weights = np.zeros((d, outputs))
        else:
            weights = rng.normal(0.0, START_SCALE, size=d if binary else (d, outputs))
        theta = np.concatenate([np.ravel(weights), np.zeros(outputs)])
        return Run(
            spec, net, theta, spec.penalty, spec.regularization_strength, spec.fit_intercept
        )

    def network_run(self, job, bit, family, outputs, class_map, class_weight, rng) -> Run:
        spec = job.spec
        if spec.dropout_rate > 0.0:
            self._id("dropout")
        sizes = [self.width, *spec.hidden_layer_sizes, outputs]
        shapes = tuple(zip(sizes[:-1], sizes[1:], strict=True))
        layers = [(start_weights(spec.initializer, s, rng), np.zeros(s[1])) for s in shapes]
        net = Net(
            family, shapes, spec.activation, spec.dropout_rate, spec.seed, job.fold, bit,
            class_weight, class_map,
        )
        penalty = "l2" if spec.alpha > 0.0 else None
        return Run(spec, net, pack(layers), penalty, spec.alpha)

    def model(self, job: Job, run: Run) -> Model:
        family = run.net.family
        kind = {"mse": "mlp_regressor", "softmax_net": "mlp_classifier"}.get(family, family)
        network = kind.startswith("mlp")
        params = named_parameters(run, family in ("linear", "logistic"), network)
        classes = list(self.training_counts(job.fold)) if self.classify else None
        return Model(
            kind, self.features, self.width, params, classes, job.spec.settings,
            run.history.rows, run.converged,
        )


def start_weights(initializer: str, shape: tuple[int, int], rng) -> np.ndarray:
    """Starting weights of one dense layer."""
    inputs, units = shape
    if initializer == "zeros":
        return np.zeros(shape)
    scale = {
        "normal": START_SCALE,
        "xavier": np.sqrt(2.0 / (inputs + units)),
        "he": np.sqrt(2.0 / inputs),
    }[initializer]
    return rng.normal(0.0, scale, size=shape)
