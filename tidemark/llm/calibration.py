"""Logistic calibration of a few features on a bounded sample."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights) of a ridge logistic regression by Newton steps that never raise the loss."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    ridge = np.full(z.shape[1], 1e-4 * weight.sum())
    ridge[0] = 1e-9 * weight.sum()

    def loss(w: np.ndarray) -> float:
        return float((weight * (np.logaddexp(0, z @ w) - y * (z @ w))).sum() + (ridge * w * w).sum() / 2)

    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), slope)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        if size <= 1e-6 or np.abs(size * step).max() < 1e-8:
            break
        w = w + size * step
    return mean, scale, w


def logistic(model, x: np.ndarray) -> np.ndarray:
    mean, scale, w = model
    return 1 / (1 + np.exp(-np.clip(w[0] + ((x - mean) / scale) @ w[1:], -30, 30)))
