"""Small dense models that the driver fits on bounded samples."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0,
                 steps: int = 25) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last coefficient is the intercept (not penalised)."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.ones(len(x)) if weight is None else weight
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (p - y)) + penalty * beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-5))[:, None]).T @ x
        curve[np.diag_indices_from(curve)] += penalty
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return beta


def fit_logistic_bits(bits: np.ndarray, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float,
                      steps: int = 25, block: int = 2048) -> np.ndarray:
    """The same for 0/1 features (packed by row) times ``scale``, unpacked block by block."""
    n, d = len(bits), len(scale)
    scale = scale.astype(np.float32)
    beta = np.zeros(d + 1)
    penalty = np.full(d + 1, ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        slope, curve = penalty * beta, np.diag(penalty)
        for at in range(0, n, block):
            x = np.unpackbits(bits[at : at + block], axis=1)[:, :d].astype(np.float32) * scale
            x = np.hstack([x, np.ones((len(x), 1), np.float32)])
            w = weight[at : at + block]
            p = sigmoid((x @ beta.astype(np.float32)).astype(np.float64))
            slope += x.T @ (w * (p - y[at : at + block])).astype(np.float32)
            x *= np.sqrt(w * np.maximum(p * (1 - p), 1e-5)).astype(np.float32)[:, None]
            curve += x.T @ x
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-3:
            break
    return beta
