"""Hashed n-gram features of text batches, shared by the trained classifiers.

Features are numbered by hash into a table of 2**bits cells: character n-grams
(over UTF-8 bytes, lower-cased or not) and word n-grams. A text's features are
the mean over its n-grams of each kind, so that length doesn't matter.
"""

from __future__ import annotations

import numpy as np

from strandline.llm import textbuf


def char_cells(data: np.ndarray, offs: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, doc offsets) of all byte n-grams that lie in one text."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(0x01000193) + data[k : n + k]
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    counts = np.maximum(np.diff(offs) - width + 1, 0)
    # the n-grams that would cross a text's end are left out
    ok = np.ones(n, bool)
    for k in range(1, width):
        at = offs[1:-1] - k
        ok[at[(at >= 0) & (at < n)]] = False
    to = np.zeros(len(offs), np.int64)
    np.cumsum(counts, out=to[1:])
    return h[ok].astype(np.int32), to


def word_cells(hashes: np.ndarray, offs: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, doc offsets) of all runs of `width` words in one text; hashes: of its words."""
    h, doc = textbuf.window_hash(hashes, offs, width)
    return (h >> np.uint64(64 - bits)).astype(np.int32), np.searchsorted(doc, np.arange(len(offs)), "left")


def means(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Mean of the values (1-d or 2-d) of each text; 0 where there are none."""
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    n = np.diff(offs).reshape(-1, *[1] * (values.ndim - 1))
    return (sums[offs[1:]] - sums[offs[:-1]]) / np.maximum(n, 1)


def platt(scores: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """(a, b) for which sigmoid(a * score + b) is calibrated on held-out labels, by Newton steps with smoothed targets."""
    n1 = labels.sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (len(labels) - n1 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -35, 35)))
        g = np.array([((p - target) * scores).sum(), (p - target).sum()])
        w = p * (1 - p) + 1e-9
        hess = np.array([[(w * scores * scores).sum(), (w * scores).sum()], [(w * scores).sum(), w.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)
