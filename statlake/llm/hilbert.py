"""Hilbert curve keys of points with many components: sorting by them keeps near points together."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cell numbers below 2^bits, as sortable bytes.

    Works through the bits from the highest down: each step exchanges or inverts the lower bits of the
    components as the curve turns there, and the turned bits are then interleaved and Gray decoded.
    """
    x = np.array(cells, dtype=np.uint32).T.copy()
    size = len(x)
    for bit in range(bits - 1, 0, -1):
        lower = np.uint32((1 << bit) - 1)
        for i in range(size):
            turned = (x[i] >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(turned, np.uint32(0), (x[0] ^ x[i]) & lower)
            x[0] = np.where(turned, x[0] ^ lower, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, size):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        on = (x[-1] >> np.uint32(bit)) & np.uint32(1) == 1
        turn ^= np.where(on, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).astype(np.uint8).T, axis=1)
    return np.ascontiguousarray(packed)


def cell_numbers(points: np.ndarray, low: np.ndarray | float, high: np.ndarray | float, bits: int) -> np.ndarray:
    """Points between two bounds as cells of a grid with 2^bits cells a side; others go to its edge."""
    points = np.asarray(points, dtype=np.float64)
    width = np.maximum(np.asarray(high, dtype=np.float64) - low, 1e-300)
    cells = np.floor((points - low) / width * (1 << bits))
    return np.clip(cells, 0, (1 << bits) - 1).astype(np.uint32)
