"""Vectorised words of a byte block: places and 64-bit hashes without a Python object per word."""

from __future__ import annotations

import numpy as np

#: Word bytes: ASCII letters and digits, and every byte of a non-ASCII character. ASCII upper case hashes as lower case.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_VALUE = np.arange(1, 257, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> _SHIFT)) * _SPREAD
    return h ^ (h >> _SHIFT)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes of the block), row and hash of every word; no word crosses the rows' offsets."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    inside = _WORD[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(starts):
        return starts, ends, starts, np.zeros(0, np.uint64)
    length = ends - starts
    # Horner's rule over the bytes of all words of at least that length, longest words last to leave.
    order = np.argsort(-length, kind="stable")
    at, left = starts[order], length[order]
    h = np.zeros(len(at), np.uint64)
    alive = np.searchsorted(-left, -np.arange(1, left[0] + 1), side="right") if left[0] <= 64 else None
    if alive is not None:
        for k, n in enumerate(alive.tolist()):
            h[:n] = (h[:n] + _VALUE[raw[at[:n] + k]]) * _BASE
    else:
        n, k = len(at), 0
        while k < 64:
            n = int(np.searchsorted(-left, -(k + 1), side="right"))
            h[:n] = (h[:n] + _VALUE[raw[at[:n] + k]]) * _BASE
            k += 1
        for i in range(int(np.searchsorted(-left, -65, side="right"))):
            h[i] = _long(raw[at[i] : at[i] + left[i]])
    hashes = np.empty(len(h), np.uint64)
    hashes[order] = mixed(h)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows, hashes


def _long(raw: np.ndarray) -> np.uint64:
    """Hash of one word beyond 64 bytes."""
    values = _VALUE[raw]
    powers = np.cumprod(np.full(len(values), _BASE, np.uint64))[::-1]
    return (values * powers).sum(dtype=np.uint64)
