"""Logistic calibration of a few features, fitted on the driver over a bounded sample."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (intercept first) by Newton's method; without both classes the rate of the one, smoothed, is the score of all."""
    x = np.c_[np.ones(len(x)), x.reshape(len(y), -1)] if len(y) else np.ones((0, 1 + (x.shape[1] if x.ndim > 1 else 1)))
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 0.5) / (len(y) + 1)
        w[0] = np.log(p / (1 - p))
        return w
    penalty = np.diag([1e-9] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
