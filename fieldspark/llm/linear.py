"""Small linear models, fitted on a bounded matrix by accelerated gradient descent."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(x: np.ndarray, grad, curve: float, l2: float, steps: int) -> np.ndarray:
    """Nesterov's method; grad(margins) is the loss's derivative, curve bounds its second derivative. Last weight: bias."""
    n, d = x.shape
    v = np.ones(d + 1, x.dtype) / np.sqrt(d + 1)
    both = lambda w: x @ w[:-1] + w[-1]
    back = lambda g: np.append(g.astype(x.dtype) @ x, g.sum()).astype(x.dtype)
    top = 1.0
    for _ in range(12):
        v = back(both(v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1 / (1.1 * curve * top / n + l2)
    w = y = np.zeros(d + 1, x.dtype)
    t = 1.0
    for _ in range(steps):
        g = back(grad(both(y))) / n
        g[:-1] += x.dtype.type(l2) * y[:-1]
        new = (y - rate * g).astype(x.dtype)
        t1 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = (new + (t - 1) / t1 * (new - w)).astype(x.dtype)
        w, t = new, t1
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 250) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge) for y in {-1, 1}; classes weigh the same."""
    c = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    return _descend(x, lambda m: -2 * c * y * np.maximum(0, 1 - y * m), 2 * float(c.max()), l2, steps)


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 500) -> np.ndarray:
    """Weights and bias of a logistic regression for y in {0, 1}."""
    return _descend(x, lambda m: sigmoid(m) - y, 0.25, l2, steps)
