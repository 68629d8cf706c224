"""Hashed character n-grams and a follow-the-regularised-leader solver."""

from __future__ import annotations

import math
import unicodedata
from functools import lru_cache

import numpy as np

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                         0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def letters(text: str) -> np.ndarray:
    """Lower-case code points; whatever is no letter becomes a space."""
    cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(_letters()[cps], cps, 32).astype(np.uint64)


def ngrams(cps: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashes of the n-grams of a padded text whose later places are letters
    (a space may lead, so a word's beginning tells); sizes ascend."""
    cps = np.concatenate([[np.uint64(32)], cps, [np.uint64(32)]])
    solid = cps != 32
    found = []
    # each size goes on from the sums of the one before
    total, ok, k = np.zeros(len(cps), np.uint64), np.ones(len(cps), bool), 0
    for n in sizes:
        m = len(cps) - n + 1
        if m <= 0:
            break
        while k < n:
            total = total[:len(cps) - k] + cps[k:] * _MULTIPLIERS[k]
            ok = ok[:len(cps) - k] & solid[k:] if k else ok
            k += 1
        found.append(total[ok & solid[:m] if n == 1 else ok] + np.array([n], np.uint64) * _MIX)
    if not found:
        return np.zeros(0, np.int64)
    # mixed in one go, whatever their sizes
    h = np.concatenate(found)
    h ^= h >> np.uint64(31)
    h *= _MIX
    h >>= np.uint64(64 - bits)
    return h.view(np.int64)


class Ftrl:
    """Multinomial logistic regression, FTRL-proximal with an elastic net:
    coordinates whose pull stays under ``l1`` are exactly zero."""

    def __init__(self, classes: int, size: int, alpha=0.3, beta=1.0, l1=0.5, l2=0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        pull = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -pull / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, idx: np.ndarray, x: np.ndarray, label: int, weight: float = 1.0) -> None:
        w = self.weights(idx)
        p = softmax(x @ w)
        p[label] -= 1.0
        g = x[:, None] * p[None, :] * weight
        old = self.n[idx]
        new = old + g * g
        self.z[idx] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
        self.n[idx] = new


class BinaryFtrl:
    """``Ftrl`` of two classes over sets of places (every input 1): the columns
    of the classes mirror each other, so that of class 1 stands for both."""

    def __init__(self, size: int, alpha=0.3, beta=1.0, l1=0.5, l2=0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(size)
        self.root = np.zeros(size)           # of the summed squares of gradients

    def _weights(self, z: np.ndarray, root: np.ndarray) -> np.ndarray:
        return (np.minimum(np.maximum(z, -self.l1), self.l1) - z) / ((self.beta + root) / self.alpha + self.l2)

    def weights(self) -> np.ndarray:
        """Of class 1 against class 0."""
        return 2 * self._weights(self.z, self.root)

    def update(self, idx: np.ndarray, label: int, weight: float = 1.0) -> None:
        idx = idx.astype(np.intp, copy=False)         # once, not at every look
        z, root = self.z.take(idx), self.root.take(idx)
        w = self._weights(z, root)
        pull = min(700.0, max(-700.0, 2 * float(w.sum())))
        g = (1 / (1 + math.exp(-pull)) - label) * weight
        new = root * root
        new += g * g
        np.sqrt(new, out=new)
        z += g
        z -= (new - root) / self.alpha * w
        self.z[idx] = z
        self.root[idx] = new


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)
