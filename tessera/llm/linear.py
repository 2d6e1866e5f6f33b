"""Small linear models in numpy: logistic regression over dense or sparse rows, and its calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


class Sparse:
    """Rows of (feature, value) pairs, as triples."""

    def __init__(self, row: np.ndarray, col: np.ndarray, val: np.ndarray, n: int, width: int):
        self.row, self.col, self.val, self.n, self.width = row, col, val.astype(np.float64), n, width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], minlength=self.width)


class Dense:
    def __init__(self, x: np.ndarray):
        self.x, (self.n, self.width) = x, x.shape

    def dot(self, w):
        return self.x @ w

    def back(self, g):
        return self.x.T @ g


def minimise(f, w: np.ndarray, steps: int, least: float = 1e-6, memory: int = 12) -> np.ndarray:
    """Where a convex function is least: ``f`` gives value and gradient. Limited-memory BFGS with halved steps, until no
    part of the gradient exceeds ``least`` or ``steps`` are taken."""
    value, g = f(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(g).max(initial=0.0) <= least:
            break
        q, kept = g.copy(), []
        for s, y, r in reversed(past):
            a = r * (s @ q)
            kept.append(a)
            q -= a * y
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(g))
        for (s, y, r), a in zip(past, reversed(kept), strict=True):
            q += s * (a - r * (y @ q))
        slope, size = -(g @ q), 1.0
        while True:
            new = w - size * q
            v, h = f(new)
            if v <= value + 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        if size < 1e-10:
            break
        s, y = new - w, h - g
        if s @ y > 1e-12:
            past = [*past[-memory + 1 :], (s, y, 1 / (s @ y))]
        w, value, g = new, v, h
    return w


def minimise(f, w: np.ndarray, steps: int, least: float = 1e-6, memory: int = 12) -> np.ndarray:
    """Where a convex function is least: ``f`` gives value and gradient. Limited-memory BFGS with halved steps, until no
    part of the gradient exceeds ``least`` or ``steps`` are taken."""
    value, g = f(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        if np.abs(g).max(initial=0.0) <= least:
            break
        q, kept = g.copy(), []
        for s, y, r in reversed(past):
            a = r * (s @ q)
            kept.append(a)
            q -= a * y
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.linalg.norm(g))
        for (s, y, r), a in zip(past, reversed(kept), strict=True):
            q += s * (a - r * (y @ q))
        slope, size = -(g @ q), 1.0
        while True:
            new = w - size * q
            v, h = f(new)
            if v <= value + 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        if size < 1e-10:
            break
        s, y = new - w, h - g
        if s @ y > 1e-12:
            past = [*past[-memory + 1 :], (s, y, 1 / (s @ y))]
        w, value, g = new, v, h
    return w


def fit_logistic(x: Sparse | Dense, y: np.ndarray, l2: float = 1.0, steps: int = 300, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log loss plus ``l2 / 2n`` of the squared weights."""
    if not x.n:
        return np.zeros(x.width), 0.0
    u = np.ones(x.n) if weight is None else weight
    u = u / u.sum()

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = x.dot(w[:-1]) + w[-1]
        e = u * (sigmoid(z) - y)
        value = u @ (np.logaddexp(0, z) - y * z) + l2 / x.n / 2 * (w[:-1] @ w[:-1])
        return value, np.append(x.back(e) + l2 / x.n * w[:-1], e.sum())

    w = minimise(loss, np.zeros(x.width + 1), steps)
    return w[:-1], float(w[-1])


def fit_platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn held-out scores (log odds) into calibrated log odds."""
    if not len(scores) or y.min() == y.max():
        return 1.0, 0.0
    w, b = fit_logistic(Dense(scores[:, None]), y, l2=0.1)
    return float(max(w[0], 0.0)), b


def folds(n: int, k: int, seed: int = 0) -> np.ndarray:
    """A fold for each of n rows, of equal sizes, at random: rows in an order of their own are no trap."""
    return np.random.default_rng(seed).permutation(n) % k
