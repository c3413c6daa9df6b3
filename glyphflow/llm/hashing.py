"""Vectorised hashing of the words and bytes of many texts at once, straight from Arrow's buffers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True
#: An odd multiplier and its inverse modulo 2**64, for polynomial hashes of prefixes.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SLICE = 1 << 20

_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n at least, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, INVERSE)):
            full = np.full(max(n, SLICE + 4096), b, dtype=np.uint64)
            full[0] = 1
            _powers[k] = np.cumprod(full, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits: all input bits reach all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[b] - P[a] = sum of (data[i] + 1) * BASE**i over a <= i < b."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[begin:end], alike wherever the bytes stand."""
    return (prefix[end] - prefix[begin]) * powers(len(prefix))[1][begin]


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """first row, last row + 1, their bytes, their offsets in these: rows of about most bytes together, a longer row alone."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


#: Multipliers and first values of the two word hashes, and those of the two shingle hashes.
_WORD = tuple(np.array(x, dtype=np.uint64) for x in ((0xD6E8FEB86659FD93, 0x2545F4914F6CDD1D), (0xC2B2AE3D27D4EB4F, 0x9E3779B185EBCA87)))
_STEP = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
#: Longer words are hashed one by one.
LONG_WORD = 512


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent hashes of each lower-cased (A-Z) word between ASCII white space, and for each text the place of its
    first word. A word goes through eight bytes at a time, each step a bijective finaliser; longer ones by BLAKE2."""
    data = LOWER[data]
    solid = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = solid
    begin = np.flatnonzero(solid & (~before[:-1] | edge[:-1]))
    after = np.zeros(len(data) + 1, dtype=bool)
    after[: len(data)] = solid
    end = np.flatnonzero(solid & (~after[1:] | edge[1:])) + 1
    size = end - begin
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    h = [mixed(size.astype(np.uint64) * k + first) for k, first in zip(*_WORD, strict=True)]
    live = np.flatnonzero(size <= LONG_WORD)
    j = 0
    while len(live):
        left = np.minimum(size[live] - j, 8)
        x = eight[begin[live] + j] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left.astype(np.uint64)))
        for k, out in zip(_WORD[0], h, strict=True):
            out[live] = mixed((out[live] ^ x) * k)
        j += 8
        live = live[size[live] > j]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[0][i], h[1][i] = np.frombuffer(hashlib.blake2b(data[begin[i] : end[i]].tobytes(), digest_size=16).digest(), dtype="<u8")
    return h[0], h[1], np.searchsorted(begin, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct k-word shingles, one text's after the other's, as two independent 64-bit hashes sorted by the
    first and then by the second, and where each text's begin. A shingle is known by both, 128 bits.

    A text of fewer words, but not none, has its whole word sequence as its one shingle.
    """
    *h, first = word_hashes(data, offsets)
    n = np.diff(first)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begins = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=begins[1:])
    at = np.repeat(first[:-1] - begins[:-1], size) + np.arange(begins[-1])
    width = np.repeat(np.minimum(n, k), size)
    acc = [mixed(width.astype(np.uint64) + step) for step in _STEP]
    for j in range(k if len(at) else 0):
        live = j < width
        for i, step in enumerate(_STEP):
            acc[i] = np.where(live, mixed(acc[i] * step + h[i][np.minimum(at + j, len(h[i]) - 1)]), acc[i])
    x, y = acc
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        order = a + np.argsort(x[a:b])
        x[a:b], y[a:b] = x[order], y[order]
    alike = np.zeros(len(x), dtype=bool)
    alike[1:] = x[1:] == x[:-1]
    alike[begins[:-1][size > 0]] = False
    clash = np.flatnonzero(alike[1:] & (y[1:] != y[:-1])) + 1
    for t in np.unique(np.searchsorted(begins, clash, "right") - 1).tolist():  # one hash for two shingles: next to never
        a, b = begins[t], begins[t + 1]
        order = a + np.lexsort((y[a:b], x[a:b]))
        x[a:b], y[a:b] = x[order], y[order]
    new = ~alike
    new[1:] |= y[1:] != y[:-1]
    kept = np.zeros(len(x) + 1, dtype=np.int64)
    np.cumsum(new, out=kept[1:])
    return x[new], y[new], kept[begins]
