"""Words of many texts as flat arrays, and polynomial hashes of words and of windows of words.

Hashes are sums of value times base to the position, modulo 2^64 with an odd base, so that the hash of
any stretch comes from two running sums (Rabin-Karp). Values are random, which keeps the low bits sound.
"""

from __future__ import annotations

import functools

import numpy as np

# Odd bases that are 3 or 5 modulo 8: their powers leave 1 as slowly as can be.
LETTER_BASE = np.uint64(0x9E3779B97F4A7C13)
WINDOW_BASES = (np.uint64(0xC2B2AE3D27D4EB4D), np.uint64(0xA0761D6478BD642B))

# Bytes of ASCII white space: a word is a run of others.
NO_SPACE = np.ones(256, dtype=bool)
NO_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def letter_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.lru_cache(maxsize=8)
def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers_of(base: np.uint64, size: int, inverse: bool = False) -> np.ndarray:
    """The first ``size`` powers of a base, or of its inverse."""
    base = int(base) if not inverse else pow(int(base), -1, 1 << 64)
    room = 1 << 20
    if size <= room:
        return powers(base, room)[:size]
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """The hash of each stretch values[start:end]."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers_of(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers_of(base, len(values) + 1, inverse=True)[starts]


def join_texts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with a space behind each text, and where each text begins."""
    texts = [t or b"" for t in texts]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    return data, np.cumsum(sizes) - sizes


def word_spans(data: np.ndarray, inside: np.ndarray = NO_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which ``inside`` holds."""
    mask = np.zeros(len(data) + 2, dtype=bool)
    mask[1:-1] = inside[data]
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    return mixed(stretch_hashes(letter_values()[data], starts, ends, LETTER_BASE))


def words_per_text(starts: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """The index of the first word of each text, and the number of words at the end."""
    return np.append(np.searchsorted(starts, text_starts), len(starts))


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The word index at which each window of ``size`` words starts, and the text it is in."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    return first[:-1][text] + inside, text


def planes(values: np.ndarray, kept: int | None = None) -> bytes:
    """The bytes of numbers, all lowest bytes first: planes of zeros then compress to nothing."""
    raw = values.astype(values.dtype.newbyteorder("<")).view(np.uint8).reshape(len(values), values.itemsize)
    return raw[:, :kept].T.tobytes()


def from_planes(raw: bytes, count: int, at: int, kind: str, kept: int | None = None) -> tuple[np.ndarray, int]:
    """The numbers that ``planes`` wrote at a place, and the place behind them."""
    kind = np.dtype(kind)
    kept = kept or kind.itemsize
    out = np.zeros((count, kind.itemsize), dtype=np.uint8)
    out[:, :kept] = np.frombuffer(raw, np.uint8, count * kept, at).reshape(kept, count).T
    return out.reshape(-1).view(kind), at + count * kept
