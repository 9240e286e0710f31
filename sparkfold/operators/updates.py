"""Steps between Spark passes: update rules, learning-rate schedule, stopping rule, history."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from sparkfold.constants import (
    ADAM_BETA1,
    ADAM_BETA2,
    MOMENTUM,
    OPTIMIZER_EPS,
    RMSPROP_DECAY,
    STEP_EVERY,
    STEP_FACTOR,
)

HISTORY_SCHEMA = (
    "epoch int, train_loss double, val_loss double, grad_norm double, param_norm double, "
    "learning_rate double"
)


def scheduled_rate(
    kind: str,
    initial: float,
    epoch: int,
    max_iter: int,
    step_every: int = STEP_EVERY,
    factor: float = STEP_FACTOR,
) -> float:
    """Learning rate of a 0-based epoch."""
    if epoch < 0:
        raise ValueError("the epoch must not be negative.")
    if kind == "constant":
        return initial
    if kind == "step":
        return initial * factor ** (epoch // step_every)
    if kind == "cosine":
        share = min(epoch, max_iter) / max_iter
        return initial * (1.0 + math.cos(math.pi * share)) / 2.0
    raise ValueError(f"no learning-rate schedule is called {kind!r}.")


@dataclass
class Update:
    """One update rule with its memory; all rules are element-wise on the flat parameters."""

    kind: str = "sgd"
    momentum: float = MOMENTUM
    decay: float = RMSPROP_DECAY
    beta1: float = ADAM_BETA1
    beta2: float = ADAM_BETA2
    eps: float = OPTIMIZER_EPS
    steps: int = 0
    first: np.ndarray | float = 0.0
    second: np.ndarray | float = 0.0

    def move(self, theta: np.ndarray, gradient: np.ndarray, rate: float) -> np.ndarray:
        self.steps += 1
        if self.kind == "sgd":
            return theta - rate * gradient
        if self.kind == "momentum":
            self.first = self.momentum * self.first - rate * gradient
            return theta + self.first
        if self.kind == "rmsprop":
            self.second = self.decay * self.second + (1.0 - self.decay) * gradient**2
            return theta - rate * gradient / (np.sqrt(self.second) + self.eps)
        if self.kind == "adam":
            self.first = self.beta1 * self.first + (1.0 - self.beta1) * gradient
            self.second = self.beta2 * self.second + (1.0 - self.beta2) * gradient**2
            mean = self.first / (1.0 - self.beta1**self.steps)
            spread = self.second / (1.0 - self.beta2**self.steps)
            return theta - rate * mean / (np.sqrt(spread) + self.eps)
        raise ValueError(f"no update rule is called {self.kind!r}.")


@dataclass
class StopRule:
    """Stops on a small gradient, or when the watched loss has stalled for long enough.

    The stall rule also watches the training loss when there is no holdout.
    """

    tol: float
    patience: int
    gradient_tol: float | None
    best: float = math.inf
    stalled: int = 0

    def reached(self, watched_loss: float, grad_norm: float | None) -> bool:
        if self.gradient_tol is not None and grad_norm is not None:
            if grad_norm <= self.gradient_tol:
                return True
        if self.best - watched_loss > self.tol:
            self.best, self.stalled = watched_loss, 0
        else:
            self.stalled += 1
        return self.stalled >= self.patience


@dataclass
class History:
    """One row per epoch."""

    rows: list[tuple] = field(default_factory=list)

    def add(self, train_loss, val_loss, grad_norm, param_norm, rate) -> None:
        values = (train_loss, val_loss, grad_norm, param_norm, rate)
        plain = [None if v is None else float(v) for v in values]
        self.rows.append((len(self.rows) + 1, *plain))
