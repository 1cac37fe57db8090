"""A linear hinge-loss model fitted by dual coordinate descent, and its calibration."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def fit_hinge(
    rows: list[np.ndarray], values: Sequence[np.ndarray], signs: np.ndarray, costs: np.ndarray, width: int, passes: int
) -> np.ndarray:
    """Weights (the last is the bias) that minimise |w|^2 / 2 + sum cost * hinge.

    One dual variable at a time takes its optimal step; ``rows`` hold feature numbers and
    ``values`` their values, which may be made when asked for. Passes end early when no step moves the weights.
    """
    weights = np.zeros(width + 1)
    dual = np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            at, value, sign = rows[k], values[k], signs[k]
            slope = sign * (float(weights[at] @ value) + weights[-1]) - 1.0
            new = min(max(dual[k] - slope / norms[k], 0.0), costs[k])
            step = (new - dual[k]) * sign
            if step:
                weights[at] += step * value
                weights[-1] += step
                dual[k] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label).

    Newton steps, halved until the loss falls; a small ridge keeps the slope finite
    where the margins separate the labels.
    """
    positives, total = float(labels.sum()), len(labels)
    high, low = (positives + 1) / (positives + 2), 1 / (total - positives + 2)
    target = np.where(labels == 1, high, low)
    scale = max(float(np.std(margins)), 1e-9)
    design = np.stack([margins / scale, np.ones(total)], axis=1)
    ridge = np.array([0.1, 0.0])

    def loss(theta: np.ndarray) -> float:
        z = design @ theta
        return float(np.sum(np.logaddexp(0, z) - target * z) + 0.5 * ridge @ theta**2)

    theta = np.array([0.0, np.log((positives + 1) / (total - positives + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        gradient = design.T @ (p - target) + ridge * theta
        hessian = (design * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ design + np.diag(ridge + 1e-9)
        step, size, before = np.linalg.solve(hessian, gradient), 1.0, loss(theta)
        while size > 1e-6 and loss(theta - size * step) > before:
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return max(float(theta[0]) / scale, 1e-6), float(theta[1])


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-min(max(x, -60.0), 60.0))))
