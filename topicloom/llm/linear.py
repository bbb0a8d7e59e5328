"""Hashed n-gram features and linear models in numpy, for the classifiers of this subpackage."""

from __future__ import annotations

import zlib

import numpy as np

_MULTIPLIER = np.uint32(0x9E3779B1)
#: ASCII bytes that are not letters, as spaces.
LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def gram_counts(texts: list[bytes], sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """A row of counts of hashed byte n-grams for each text, over the whole text."""
    width = 1 << bits
    out = np.empty((len(texts), width), np.float32)
    for row, text in enumerate(texts):
        a = np.frombuffer(text, np.uint8).astype(np.uint32) + np.uint32(1)
        code, total = np.zeros(len(a), np.uint32), np.zeros(width, np.int64)
        for n in range(1, max(sizes) + 1):
            if len(a) < n:
                break
            code = code[: len(a) - n + 1] * np.uint32(257) + a[n - 1 :]
            if n in sizes:
                total += np.bincount((code * _MULTIPLIER + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * _MULTIPLIER >> np.uint32(32 - bits), minlength=width)
        out[row] = total
    return out


def word_counts(words: list[list[bytes]], bits: int) -> np.ndarray:
    """A row of counts of hashed words and pairs of neighbouring words for each text."""
    width = 1 << bits
    out = np.empty((len(words), width), np.float32)
    known: dict[bytes, int] = {}
    for row, own in enumerate(words):
        for w in set(own).difference(known):
            known[w] = zlib.crc32(w)
        code = np.fromiter(map(known.__getitem__, own), np.uint32, len(own))
        pairs = code[:-1] * np.uint32(0x85EBCA6B) + code[1:]
        both = np.concatenate([code, pairs]) * _MULTIPLIER >> np.uint32(32 - bits)
        out[row] = np.bincount(both, minlength=width)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Square roots of the counts, each row of length one (or zero)."""
    x = np.sqrt(counts)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def _descend(gradient, shape, rate: float, steps: int) -> np.ndarray:
    """Accelerated gradient descent from zero."""
    w = v = np.zeros(shape, np.float32)
    for k in range(steps):
        new = v - rate * gradient(v)
        v = new + k / (k + 3) * (new - w)
        w = new
    return w


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 120) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss; ``y`` is 1 or -1, both classes weigh the same."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)

    def gradient(w):
        short = np.maximum(0, 1 - y * (x @ w))
        return -2 * (x.T @ (share * y * short)) + 2 * l2 * w

    w = _descend(gradient, x.shape[1], 0.2, steps)
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 300, rate: float = 1.5) -> tuple[np.ndarray, float]:
    """Logistic regression; ``y`` is 1 or 0, both classes weigh the same."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)

    def gradient(w):
        return x.T @ (share * (sigmoid(x @ w) - y)) + l2 * w

    w = _descend(gradient, x.shape[1], rate, steps)
    return w[:-1], float(w[-1])


def fit_sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """``(a, b)`` such that sigmoid(a * margin + b) is the probability of class 1 (Platt's targets, Newton steps)."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1).astype(np.float64)
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p) - 1e-4 * w)
        w = w + np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
