"""Small numpy models that are fitted on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None,
                 ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights, the last one the constant, of a ridge logistic regression
    (Newton steps; the constant is not penalised)."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(float)
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6

    def loss(w):
        z = np.clip(x @ w, -40, 40)
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + (penalty * w * w).sum() / 2

    at = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (weight * (p - y)) + penalty * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-3 and loss(w - size * step) > at:
            size /= 2
        w = w - size * step
        at, before = loss(w), at
        if abs(before - at) < 1e-7 * (1 + abs(at)):
            break
    return w


def predict_logistic(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


class GramTable:
    """Place of each uint64 key in an array, by open addressing in numpy."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        todo, probe = np.arange(len(keys)), 0
        while len(todo):
            at = (self._hash(keys[todo]) + probe) & self.mask
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            todo = todo[self.slots[at] != todo]
            probe += 1

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it is missing."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        todo, at = np.arange(len(keys)), self._hash(keys)
        while len(todo):
            s = self.slots[at & self.mask]
            hit = (s >= 0) & (self.keys[s] == keys[todo])
            out[todo[hit]] = s[hit]
            on = (s >= 0) & ~hit
            todo, at = todo[on], at[on] + 1
        return out
