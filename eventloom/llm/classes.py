"""Unsupervised classes of texts, by a mixture of multinomials over hashed letter pairs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Hashed letter pairs.
BINS = 4096


def features(text: str | None) -> np.ndarray:
    """Counts of the pairs of neighbouring code points of the lower-cased whole text, by hash."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) < 2:
        return np.zeros(BINS)
    mixed = (codes[:-1] * np.uint32(0x9E3779B1)) ^ (codes[1:] * np.uint32(0x85EBCA77))
    mixed *= np.uint32(0xC2B2AE3D)
    mixed >>= np.uint32(20)
    return np.bincount(mixed, minlength=BINS).astype(float)


@dataclass(frozen=True)
class Classes:
    prior: np.ndarray  # [classes], logs
    weights: np.ndarray  # [BINS, classes], logs

    def of(self, text: str | None) -> int:
        return self.of_features(features(text))

    def of_features(self, x: np.ndarray) -> int:
        return int(np.argmax(self.prior + x @ self.weights))

    def add(self, texts: list[str | None], sums: np.ndarray) -> None:
        """Adds to sums [BINS + 1, classes] the features of each text's class and, in the last row, its number of texts."""
        weights = np.ascontiguousarray(self.weights.T)
        for at in range(0, len(texts), 32):
            x = np.stack([features(t) for t in texts[at : at + 32]])
            own = np.argmax(self.prior + x @ weights.T, axis=1)
            # counts are whole numbers, so their order has no effect
            chosen = (own[:, None] == np.arange(len(self.prior))).astype(float)
            sums[:-1] += x.T @ chosen
            sums[-1] += chosen.sum(axis=0)

    @staticmethod
    def counted(sums: np.ndarray) -> Classes:
        """The classes that such sums, of all texts, give."""
        prior = np.log((sums[-1] + 1e-3) / (sums[-1].sum() + 1e-3 * sums.shape[1]))
        weights = np.log((sums[:-1] + 0.05) / (sums[:-1] + 0.05).sum(axis=0))
        return Classes(prior, weights)


def fit(texts: list[str], classes: int = 6, rounds: int = 15) -> Classes:
    """Fits the mixture by expectation and maximization, from centres chosen far from each other; deterministic.

    Fewer texts than classes give as many classes as texts, one at least.
    """
    x = np.stack([features(t) for t in texts]) if texts else np.zeros((1, BINS))
    classes = max(1, min(classes, len(x)))
    shares = (x + 1e-3) / (x + 1e-3).sum(axis=1, keepdims=True)
    roots = np.sqrt(shares)  # likeness of two texts: the product of their roots
    centres = [int(np.argmax(x.sum(axis=1)))]
    near = roots @ roots[centres[0]]
    long = x.sum(axis=1) >= np.median(x.sum(axis=1))  # short texts are far from everything
    while len(centres) < classes:
        centres.append(int(np.argmin(np.where(long, near, 2))))
        near = np.maximum(near, roots @ roots[centres[-1]])
    weights = np.log(shares[centres] * 0.9 + 0.1 / BINS).T
    prior = np.full(classes, -np.log(classes))
    for _ in range(rounds):
        logs = prior + x @ weights
        part = np.exp(logs - logs.max(axis=1, keepdims=True))
        part /= part.sum(axis=1, keepdims=True)
        prior = np.log((part.sum(axis=0) + 1e-3) / (len(x) + 1e-3 * classes))
        sums = x.T @ part + 0.05
        weights = np.log(sums / sums.sum(axis=0))
    return Classes(prior, weights)
