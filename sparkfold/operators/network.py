"""Losses and gradients of one Arrow batch for any number of models (NumPy inside tasks).

Every trained model is a chain of dense layers; linear, logistic and softmax regression are chains
of length one. The first layer of all models shares one matrix product per batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from sparkfold.constants import LEAKY_SLOPE, LOGIT_CLIP, PROBABILITY_EPS


@dataclass(frozen=True)
class Net:
    """What a task must know about one model.

    ``family`` names the output and its loss: linear (half squared error), mse (squared error),
    logistic (binary cross-entropy), softmax and softmax_net (categorical cross-entropy; the net
    form differentiates the clipped loss). Rows of ``fold`` and of holdout bit ``bit`` are not
    trained on; the latter are watched instead.
    """

    family: str
    shapes: tuple[tuple[int, int], ...]
    activation: str = "relu"
    dropout: float = 0.0
    seed: int = 0
    fold: int = -1
    bit: int = -1
    class_weight: np.ndarray | None = None
    class_map: np.ndarray | None = None

    @property
    def size(self) -> int:
        return sum(i * o + o for i, o in self.shapes)


def unpack(theta: np.ndarray, shapes) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for rows, units in shapes:
        weights = theta[at : at + rows * units].reshape(rows, units)
        at += rows * units
        layers.append((weights, theta[at : at + units]))
        at += units
    return layers


def pack(layers) -> np.ndarray:
    return np.concatenate([np.ravel(part) for layer in layers for part in layer])


def weight_positions(shapes) -> np.ndarray:
    """True where the flat parameters are weights, False where they are biases."""
    return np.concatenate([[True] * (i * o) + [False] * o for i, o in shapes])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -LOGIT_CLIP, LOGIT_CLIP)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def activate(name: str, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Activation and its derivative."""
    if name == "sigmoid":
        s = sigmoid(z)
        return s, s * (1.0 - s)
    if name == "tanh":
        t = np.tanh(z)
        return t, 1.0 - t * t
    slope = np.where(z > 0.0, 1.0, LEAKY_SLOPE if name == "leaky_relu" else 0.0)
    return z * slope, slope


def output(family: str, z: np.ndarray) -> np.ndarray:
    if family == "logistic":
        return sigmoid(z)
    if family in ("softmax", "softmax_net"):
        return softmax(z)
    return z


def predict(layers, activation: str, family: str, x: np.ndarray) -> np.ndarray:
    """Outputs of one model for a block of rows."""
    for weights, bias in layers[:-1]:
        x, _ = activate(activation, x @ weights + bias)
    weights, bias = layers[-1]
    return output(family, x @ weights + bias)


def row_losses(family: str, out: np.ndarray, y: np.ndarray) -> np.ndarray:
    if family in ("linear", "mse"):
        gap = out[:, 0] - y
        return gap * gap * (0.5 if family == "linear" else 1.0)
    p = np.clip(out, PROBABILITY_EPS, 1.0 - PROBABILITY_EPS)
    if family == "logistic":
        p = p[:, 0]
        return -(y * np.log(p) + (1.0 - y) * np.log(1.0 - p))
    return -np.log(p[np.arange(len(y)), y.astype(int)])


def output_errors(family: str, out: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Derivative of the row loss by the last layer's sums."""
    if family in ("linear", "mse", "logistic"):
        error = out - y[:, None]
        return 2.0 * error if family == "mse" else error
    own = (np.arange(len(y)), y.astype(int))
    error = out.copy()
    error[own] -= 1.0
    if family == "softmax_net":
        p = out[own]
        error *= (p / np.clip(p, PROBABILITY_EPS, 1.0 - PROBABILITY_EPS))[:, None]
    return error


def kept(keys: np.ndarray, units: int, rate: float, salt: tuple[int, ...]) -> np.ndarray:
    """Inverted dropout mask from a hash of (salt, row key, unit), the same wherever a row lies."""
    # The public SplitMix64 finaliser.
    step, mix1, mix2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

    def scramble(v):
        v = (v ^ (v >> np.uint64(30))) * np.uint64(mix1)
        v = (v ^ (v >> np.uint64(27))) * np.uint64(mix2)
        return v ^ (v >> np.uint64(31))

    with np.errstate(over="ignore"):
        state = keys.astype(np.int64).view(np.uint64)
        for part in salt:
            state = scramble(state + np.uint64((part * step + step) % 2**64))
        lanes = np.arange(1, units + 1, dtype=np.uint64) * np.uint64(step)
        bits = scramble(state[:, None] + lanes[None, :])
    uniform = (bits >> np.uint64(11)).astype(np.float64) * 2.0**-53
    return (uniform >= rate) / (1.0 - rate)


def _through(net: Net, layers, first: np.ndarray, masks) -> tuple[list, np.ndarray]:
    """(inputs and slopes of the later layers, output) from the first layer's sums."""
    trail, z = [], first
    for depth, (weights, bias) in enumerate(layers[1:]):
        a, slope = activate(net.activation, z)
        if masks is not None:
            a, slope = a * masks[depth], slope * masks[depth]
        trail.append((a, slope))
        z = a @ weights + bias
    return trail, output(net.family, z)


def batch_sums(nets, thetas, block: dict, epoch: int) -> np.ndarray:
    """Summed (train loss, train weight, holdout loss, holdout weight, gradient) of all models."""
    x, y = block["x"], block["y"]
    n = len(y)
    stacks = [unpack(theta, net.shapes) for net, theta in zip(nets, thetas, strict=True)]
    first = x @ np.hstack([layers[0][0] for layers in stacks])
    deltas, results, at = [], [], 0
    for net, layers in zip(nets, stacks, strict=True):
        units = layers[0][0].shape[1]
        z = first[:, at : at + units] + layers[0][1]
        at += units
        weight = block["w"] if block.get("w") is not None else np.ones(n)
        if net.class_weight is not None:
            weight = weight * net.class_weight[y.astype(int)]
        usable = np.ones(n, bool) if net.fold < 0 else block["fold"] != net.fold
        if net.bit >= 0:
            held = (block["vmask"] >> net.bit) & 1 == 1
            train, watch = weight * (usable & ~held), weight * (usable & held)
        else:
            train, watch = weight * usable, np.zeros(n)
        target = y
        if net.class_map is not None:
            target = np.maximum(net.class_map[y.astype(int)], 0).astype(float)
        trail, out = _through(net, layers, z, None)
        losses = row_losses(net.family, out, target)
        if net.dropout > 0.0:
            masks = [
                kept(block["key"], shape[1], net.dropout, (net.seed, epoch, depth))
                for depth, shape in enumerate(net.shapes[:-1])
            ]
            trail, out = _through(net, layers, z, masks)
        delta = output_errors(net.family, out, target) * train[:, None]
        later = []
        for (a, slope), (weights, _) in zip(reversed(trail), reversed(layers[1:]), strict=True):
            later.append((a.T @ delta, delta.sum(axis=0)))
            delta = (delta @ weights.T) * slope
        deltas.append(delta)
        sums = np.array([losses @ train, train.sum(), losses @ watch, watch.sum()])
        results.append((sums, delta.sum(axis=0), later[::-1]))
    weights = np.split(x.T @ np.hstack(deltas), np.cumsum([d.shape[1] for d in deltas])[:-1], 1)
    parts = []
    for first_weights, (sums, first_bias, later) in zip(weights, results, strict=True):
        parts += [sums, pack([(first_weights, first_bias), *later])]
    return np.concatenate(parts)
