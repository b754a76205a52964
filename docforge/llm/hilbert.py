"""Hilbert keys of points on an integer grid, by array operations (John Skilling's transpose method, 2004)."""

from __future__ import annotations

import numpy as np


def grid(points: np.ndarray, low: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """Points of the box [low, high] on a grid of 2**bits steps a dimension; outside ones go to its edge."""
    span = np.where(high > low, high - low, 1.0)
    steps = np.floor((points - low) / span * (1 << bits))
    return np.clip(steps, 0, (1 << bits) - 1).astype(np.int64)


def keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (row of coordinates below 2**bits) along the Hilbert curve; bits * dimensions <= 63."""
    axis = [cells[:, d].copy() for d in range(cells.shape[1])]
    n = len(axis)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for d in range(n):
            turned = (axis[d] & level) != 0
            swap = np.where(turned, 0, (axis[0] ^ axis[d]) & low)
            axis[0] ^= np.where(turned, low, swap)
            axis[d] ^= swap
        level >>= 1
    for d in range(1, n):
        axis[d] ^= axis[d - 1]
    flip = np.zeros(len(cells), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((axis[-1] & level) != 0, level - 1, 0)
        level >>= 1
    out = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            out = (out << 1) | (((axis[d] ^ flip) >> b) & 1)
    return out
