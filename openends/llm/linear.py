"""Logistic regression on a bounded sample, in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (bias last) by Newton steps; `ridge` keeps separable classes finite."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-8:
            break
    return w


def scores(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log-odds of class 1."""
    return x @ w[:-1] + w[-1]
