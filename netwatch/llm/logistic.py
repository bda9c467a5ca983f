"""A small logistic regression, fitted on a bounded sample on the driver."""

from __future__ import annotations

import numpy as np


class Logistic:
    """Standardised features, ridge penalty, Newton steps. With one class
    (or none) in the sample it gives the smoothed share of ones."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 30):
        x, y = np.asarray(features, float), np.asarray(labels, float)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        spread = x.std(axis=0) if len(x) else np.ones(x.shape[1])
        self.spread = np.where(spread > 1e-9, spread, 1.0)
        share = (y.sum() + 0.5) / (len(y) + 2.0)
        self.weights = np.zeros(x.shape[1] + 1)
        self.weights[0] = np.log(share / (1 - share))
        if not len(y) or y.min() == y.max():
            return
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.spread])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            gradient = z.T @ (y - p) - penalty * self.weights
            curvature = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curvature, gradient)
            self.weights += step
            if np.abs(step).max() < 1e-8:
                break

    def logit(self, features: np.ndarray) -> np.ndarray:
        x = (np.asarray(features, float).reshape(-1, len(self.mean)) - self.mean) / self.spread
        return np.clip(self.weights[0] + x @ self.weights[1:], -30, 30)

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(features)))
