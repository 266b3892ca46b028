"""Hashed character n-grams of a text, and follow-the-regularised-leader for linear models on them."""

from __future__ import annotations

import numpy as np


def feature_ids(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """The hashed n-grams of a lower-cased text with a space at either end, one id for each place."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    out = []
    for n in orders:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, (n * 0x9E3779B1) & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            h ^= codes[i : len(codes) - n + 1 + i]
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        out.append(h >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Unique:
    """The different ids of many small lists, without sorting: the last place of each id wins."""

    def __init__(self, bits: int):
        self.place = np.zeros(1 << bits, np.int32)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = np.arange(len(ids), dtype=np.int32)
        self.place[ids] = at
        return ids[self.place[ids] == at]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Multinomial logistic regression by FTRL-proximal steps with an elastic net (McMahan et al. 2013).
    Weights exist as the sums ``z`` and ``n`` only; l1 keeps most at exactly zero."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.1, l2: float = 0.1):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, ids: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, ids: np.ndarray, values: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(ids)
        p = softmax(values @ w)
        p[label] -= 1.0
        g = weight * values[:, None] * p[None, :]
        n = self.n[ids]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[ids] += g - sigma * w
        self.n[ids] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes held-back labels likeliest."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    losses = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])
