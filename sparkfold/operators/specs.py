"""What to train: hyperparameters of every estimator, checked when they are written down."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from sparkfold.functions.losses import PENALTIES
from sparkfold.operators.splits import check_fraction

STRATEGIES = ("batch", "mini_batch", "stochastic")
OPTIMIZERS = ("sgd", "momentum", "rmsprop", "adam")
SCHEDULES = ("constant", "step", "cosine")
ACTIVATIONS = ("relu", "leaky_relu", "sigmoid", "tanh")
INITIALIZERS = ("zeros", "normal", "xavier", "he")


def _one_of(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}.")


# The names of the settings and their defaults, here and in the classes below.
@dataclass(frozen=True)
class Descent:
    """Settings shared by everything that is trained in epochs."""

    learning_rate: float = 0.01
    max_iter: int = 1000
    optimizer: str = "sgd"
    learning_rate_schedule: str = "constant"
    batch_strategy: str = "batch"
    batch_size: int | None = None
    shuffle: bool = True
    early_stopping: bool = False
    validation_fraction: float = 0.1
    n_iter_no_change: int = 10
    tol: float = 1e-6
    gradient_tol: float | None = 1e-6
    shards: int | None = None
    seed: int = 0

    def __post_init__(self) -> None:
        for name in ("learning_rate", "max_iter", "n_iter_no_change"):
            if not getattr(self, name) > 0:
                raise ValueError(f"{name} must be positive.")
        for name in ("tol", "gradient_tol"):
            if getattr(self, name) is not None and getattr(self, name) < 0.0:
                raise ValueError(f"{name} must not be negative.")
        for name in ("batch_size", "shards"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive.")
        _one_of("batch_strategy", self.batch_strategy, STRATEGIES)
        _one_of("optimizer", self.optimizer, OPTIMIZERS)
        _one_of("learning_rate_schedule", self.learning_rate_schedule, SCHEDULES)
        check_fraction(self.validation_fraction)

    @property
    def settings(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class _Penalised(Descent):
    fit_intercept: bool = True
    penalty: str | None = None
    regularization_strength: float = 0.0

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of("penalty", self.penalty, PENALTIES)
        if self.regularization_strength < 0.0:
            raise ValueError("regularization_strength must not be negative.")


@dataclass(frozen=True)
class LinearRegression(_Penalised):
    solver: str = "normal_equation"

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of("solver", self.solver, ("normal_equation", "gradient_descent"))
        if self.solver == "normal_equation" and self.penalty == "l1":
            raise ValueError("penalty='l1' needs solver='gradient_descent'.")


@dataclass(frozen=True)
class LogisticRegression(_Penalised):
    penalty: str | None = "l2"
    threshold: float = 0.5
    multi_class: str = "auto"
    class_weight: Mapping[int, float] | str | None = None
    start: str = "normal"

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of("multi_class", self.multi_class, ("auto", "multinomial"))
        _one_of("start", self.start, ("normal", "zeros"))
        if not 0.0 < self.threshold < 1.0:
            raise ValueError("threshold must lie strictly between 0 and 1.")


@dataclass(frozen=True)
class _Network(Descent):
    learning_rate: float = 0.001
    max_iter: int = 200
    optimizer: str = "adam"
    gradient_tol: float | None = None
    hidden_layer_sizes: tuple[int, ...] = (100,)
    activation: str = "relu"
    dropout_rate: float = 0.0
    alpha: float = 0.0
    initializer: str = "xavier"

    def __post_init__(self) -> None:
        super().__post_init__()
        _one_of("activation", self.activation, ACTIVATIONS)
        _one_of("initializer", self.initializer, INITIALIZERS)
        if any(size <= 0 for size in self.hidden_layer_sizes):
            raise ValueError("hidden_layer_sizes must be positive.")
        if not 0.0 <= self.dropout_rate < 1.0:
            raise ValueError("dropout_rate must be at least 0 and below 1.")
        if self.alpha < 0.0:
            raise ValueError("alpha must not be negative.")


@dataclass(frozen=True)
class MLPClassifier(_Network):
    """Softmax output with categorical cross-entropy."""


@dataclass(frozen=True)
class MLPRegressor(_Network):
    """Identity output with mean squared error."""


@dataclass(frozen=True)
class MajorityClass:
    """Always the most frequent label; the smallest of equally frequent ones."""

    @property
    def settings(self) -> dict:
        return {}


@dataclass(frozen=True)
class MeanTarget:
    """Always the mean target."""

    @property
    def settings(self) -> dict:
        return {}


CLASSIFIERS = (LogisticRegression, MLPClassifier, MajorityClass)


def is_classifier(spec) -> bool:
    return isinstance(spec, CLASSIFIERS)
