"""Hashed n-gram indicators of texts and linear models over them."""

from __future__ import annotations

import numpy as np

from verdant.llm.arrays import Words, mix


MARK = np.zeros(256, bool)
MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
UPPER = np.zeros(256, bool)
UPPER[ord("A") : ord("Z") + 1] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True


def shapes(words: Words, data: np.ndarray) -> np.ndarray:
    """A hash of every word's looks: case of its first two bytes, its last mark, digits, and whether it repeats the word before."""
    first, last = data[words.start], data[words.end - 1]
    second = data[np.minimum(words.start + 1, words.end - 1)]
    again = np.append(False, words.hash[1:] == words.hash[:-1])
    again[words.first[:-1][words.count > 0]] = False
    looks = (np.where(MARK[last], last, 0).astype(np.uint64) | UPPER[first].astype(np.uint64) << np.uint64(8)
             | UPPER[second].astype(np.uint64) << np.uint64(9) | DIGIT[last].astype(np.uint64) << np.uint64(10)
             | MARK[first].astype(np.uint64) << np.uint64(11) | again.astype(np.uint64) << np.uint64(12))
    return mix(looks + np.uint64(0x1000000))


def _ngrams(units: np.ndarray, longest: int) -> list[np.ndarray]:
    levels, rolled = [], np.zeros(len(units), np.uint64)
    for n in range(1, longest + 1):
        keep = max(0, len(units) - n + 1)
        rolled[:keep] = mix(rolled[:keep] + units[n - 1 :])
        levels.append(rolled.copy())
    return levels


def text_ngrams(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, bits: int) -> list[np.ndarray]:
    """Distinct hashed features (below 2 ** bits) of every text: 1-2 words together, 1-3 words' shapes together."""
    words, shift = Words(data, offsets, is_word), np.uint64(64 - bits)
    levels = [(n, (h >> shift).astype(np.int32)) for kind in (_ngrams(words.hash, 2), _ngrams(shapes(words, data), 3)) for n, h in enumerate(kind)]
    stamp = np.zeros(1 << bits, np.int32)
    out = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        every = np.concatenate([h[a : max(a, b - n)] for n, h in levels])
        stamp[every] = np.arange(len(every), dtype=np.int32)
        out.append(every[stamp[every] == np.arange(len(every))])  # one place for each feature
    return out


def dual_coordinate_descent(rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, cost: np.ndarray, *,
                            epochs: int = 20, seed: int = 1) -> np.ndarray:
    """Weights of the features and, last, the bias of a linear model with hinge loss.

    rows: each row's distinct features; values: what a feature counts where it occurs, over the root of the row's size, so
    long texts do not outweigh short ones; labels: +1 or -1; cost: upper bound of each row's dual variable.
    """
    weights, alpha = np.zeros(len(values) + 1), np.zeros(len(rows))
    scale = [1 / np.sqrt(max(1, len(r))) for r in rows]
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    norm = [float(np.square(values[r]).sum()) * s * s + 1.0 for r, s in zip(rows, scale)]
    for _ in range(epochs):
        rng.shuffle(order)
        most = 0.0
        for i in order.tolist():
            r = rows[i]
            x = values[r] * scale[i]
            gradient = labels[i] * (float(weights[r] @ x) + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i])
            if (step := (new - alpha[i]) * labels[i]):
                most = max(most, abs(step) / cost[i])
                alpha[i] = new
                weights[r] += step * x
                weights[-1] += step
        if most < 1e-2:
            break
    return weights


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def platt(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))), by Newton steps on smoothed targets."""
    n1, n0 = int(good.sum()), int((~good).sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = logistic(x @ at)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        at -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])
