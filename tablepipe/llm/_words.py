"""Vectorised words of a batch of texts: bounds, owners and position-free hashes."""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


@functools.lru_cache(1)
def _byte_values():
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def mix(x):
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power_tables(n):
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data):
    """Prefix sums for ``span_hash``."""
    up, _ = _power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix, start, stop):
    """64-bit hashes of data[start:stop], the same wherever the bytes stand."""
    _, down = _power_tables(len(prefix))
    return mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64) * _M2)


def lower_ascii(data):
    """Bytes with A-Z in lower case."""
    return np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)


@functools.lru_cache(1)
def _space_table():
    t = np.zeros(256, bool)
    t[[0x20, *range(9, 14)]] = True
    return t


def words(data, offsets):
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: (start, stop, text) arrays; no word crosses texts."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_space_table()[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return start, stop, np.searchsorted(offsets, start, side="right") - 1


def group_sizes(keys):
    """For each key how often it occurs in the array."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse]
