"""Improved consistent weighted sampling of many weighted sets at once.

For a set and a sample number, every element draws r and c from Gamma(2, 1) and b from [0, 1) by hashing
itself; t = floor(ln w / r + b), and the element with the least ln c - r (t - b) - r is drawn, with its t.
Two sets draw the same (element, t) with the probability of their weighted Jaccard similarity. r and c
come from tables of 65,536 quantiles.
"""

from __future__ import annotations

import functools

import numpy as np

from statlake.llm.text_arrays import mixed

QUANTILES = 1 << 16
BLOCK = 1 << 16


@functools.lru_cache(maxsize=1)
def gamma_quantiles() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, 1 / r and ln r at the middle of each of the quantiles of Gamma(2, 1)."""
    share = (np.arange(QUANTILES) + 0.5) / QUANTILES
    x = np.sqrt(2 * share)
    for _ in range(100):  # Newton on 1 - (1 + x) exp(-x), whose slope is x exp(-x)
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - share) / np.maximum(x * np.exp(-x), 1e-12), 1e-6)
    return x.astype(np.float32), (1 / x).astype(np.float32), np.log(x).astype(np.float32)


def samples(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """``count`` sample numbers of each set; set i has the elements from starts[i] to starts[i + 1].

    Sets are not empty, weights are above 0. Equal numbers stand for the same (element, t).
    """
    r, inverse, logs = gamma_quantiles()
    out = np.empty((len(starts), count), dtype=np.uint64)
    ends = np.r_[starts[1:], len(keys)]
    log_weights = np.log(weights).astype(np.float32)
    seeds = mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BLOCK, side="right")))
        a, b = starts[first], ends[last - 1]
        own, log_w, cuts = keys[a:b], log_weights[a:b], starts[first:last] - a
        place = np.arange(b - a, dtype=np.int64)
        for k in range(count):
            draw = mixed(own ^ seeds[k])
            at = (draw & np.uint64(0xFFFF)).astype(np.int64)
            beta = (draw >> np.uint64(32)).astype(np.float32) * np.float32(2.0**-32)
            rate = r[at]
            t = np.floor(log_w * inverse[at] + beta)
            least = logs[((draw >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)] - rate * (t - beta + 1)
            bits = least.astype(np.float32).view(np.int32).astype(np.int64)
            order = bits ^ ((bits >> 63) & 0x7FFFFFFF)
            drawn = np.minimum.reduceat((order << 32) | place, cuts) & 0xFFFFFFFF
            number = t[drawn].astype(np.int64).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
            out[first:last, k] = mixed(own[drawn] ^ number)
        first = last
    return out


def band_values(drawn: np.ndarray, rows: int) -> np.ndarray:
    """One number for each ``rows`` samples in turn; each band has numbers of its own."""
    bands = drawn.shape[1] // rows
    out = np.empty((len(drawn), bands), dtype=np.uint64)
    for band in range(bands):
        value = np.full(len(drawn), band + 1, dtype=np.uint64)
        for k in range(band * rows, band * rows + rows):
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + drawn[:, k])
        out[:, band] = value
    return out.view(np.int64)
