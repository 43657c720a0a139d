"""Hashed byte n-grams and a small logistic fit, shared by the trained operators."""

from __future__ import annotations

import numpy as np

_SPACE = ord(" ")
_LETTERS = bytes(c if chr(c).islower() and c < 128 or c >= 128 else _SPACE for c in range(256))
_SHAPES = bytes(
    ord("a") if c >= 128 or chr(c).islower() else ord("A") if chr(c).isupper() else ord("0") if chr(c).isdigit() else c
    for c in range(256)
)


def letters(text: str) -> np.ndarray:
    """Lower-cased bytes; runs of ASCII characters that are no letters are one blank."""
    x = np.frombuffer(b" " + text.lower().encode().translate(_LETTERS) + b" ", np.uint8)
    blank = x == _SPACE
    return x[~(blank & np.append(False, blank[:-1]))]


def shapes(text: str) -> np.ndarray:
    """Bytes with letters and digits replaced by their kind; signs stay."""
    return np.frombuffer(text.encode().translate(_SHAPES), np.uint8)


def gram_counts(x: np.ndarray, dim: int, sizes: tuple[int, ...] = (1, 2, 3)) -> np.ndarray:
    """How often the n-grams of ``x`` fall into each of ``dim`` hash buckets."""
    out = np.zeros(dim, np.int64)
    for size in sizes:
        n = len(x) - size + 1
        if n < 1:
            continue
        key = np.full(n, size, np.uint64)
        for k in range(size):
            key = key * np.uint64(257) + x[k : n + k]
        key = (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        out += np.bincount((key % np.uint64(dim)).astype(np.int64), minlength=dim)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """``x`` over its length along the last axis; zero stays zero."""
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights, the last one the intercept, for targets from 0 to 1 (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, x.T @ (y - p) - penalty * w)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w
