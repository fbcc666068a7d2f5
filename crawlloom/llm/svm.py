"""Linear support vector machines on small dense samples, and a logistic scale for scores."""

from __future__ import annotations

import numpy as np


def linear_svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-4, steps: int = 300, weight=None) -> tuple[np.ndarray, float]:
    """Weights and offset for labels -1 and 1: squared hinge loss, accelerated gradient descent.

    Classes weigh alike unless ``weight`` gives a weight a row. The number of steps bounds
    how far single rows are followed, as a regularisation of its own.
    """
    if weight is None:
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    weight = (weight / weight.sum()).astype(x.dtype)
    y = y.astype(x.dtype)
    xb = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    # the loss bends by at most twice the largest eigenvalue of the weighted second moments
    v = np.full(xb.shape[1], xb.shape[1] ** -0.5, dtype=x.dtype)
    for _ in range(20):
        v = xb.T @ (weight * (xb @ v))
        top = np.linalg.norm(v)
        v /= top
    rate = float(1.0 / (2.2 * top + reg))
    w = at = np.zeros(xb.shape[1], dtype=x.dtype)
    for k in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (xb @ at))
        grad = -2.0 * (xb.T @ (weight * y * slack))
        grad[:-1] += reg * at[:-1]
        new = at - rate * grad
        at = new + k / (k + 3.0) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def logistic_scale(score: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """a, b such that sigmoid(a * score + b) is the chance of y = 1, by Newton's method."""
    a, b = 1.0, 0.0
    # pulled a little towards the middle, so separable scores keep finite values
    n1, n0 = weight[y > 0].sum(), weight[y <= 0].sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(steps):
        p = sigmoid(a * score + b)
        d, h = weight * (p - goal), np.maximum(weight * p * (1 - p), 1e-9)
        g = np.array([(d * score).sum(), d.sum()])
        m = np.array([[(h * score * score).sum() + 1e-6, (h * score).sum()], [(h * score).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)
