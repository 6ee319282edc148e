"""Small linear models, fitted on bounded samples."""

from __future__ import annotations

import numpy as np


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int,
                            cost: np.ndarray, epochs: int = 12, seed: int = 1) -> np.ndarray:
    """Weights of a linear hinge-loss machine; the last weight is the bias.

    Minimises |w|^2 / 2 + sum(cost_i * max(0, 1 - y_i w.x_i)) over its dual, one variable at a
    time: alpha_i moves to the clipped optimum given the others, and w follows.
    """
    w = np.zeros(dims + 1)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            idx, val = rows[i]
            gradient = y[i] * (float(w[idx] @ val) + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                moved = max(moved, abs(step))
                w[idx] += step * val
                w[-1] += step
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def logistic_1d(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(slope, offset) of P(y = 1) = sigmoid(slope * margin + offset), lightly regularised."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        d, v = p - target, p * (1 - p) + 1e-9
        g = np.array([(d * margin).sum() + 1e-3 * a, d.sum()])
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()],
                      [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
