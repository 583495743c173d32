"""Hashes of words and of byte and word windows of whole texts, computed with numpy.

Words are mixed eight bytes at a time, and windows of words by doubling: a window's hash mixes
those of its two halves. So no two short texts collide by their algebra, as they can under
a polynomial modulo 2**64. Byte windows, which only choose candidates or are compared afterwards, are such
polynomials, read off prefix sums at the same cost for any length.
"""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, U), _INVERSE: np.ones(1, U)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix64(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        steps = np.full(1 << (n - 1).bit_length(), base, U)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over 64-bit values, for `window_hash`."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * _power(_BASE, len(values)), out=out[1:])
    return out


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[data])


def window_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the elements from ``start`` up to ``end``; equal windows have equal hashes."""
    return mix64((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start])


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 bytes that end with a space."""
    space = _IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U)  # masks of the first n bytes
_LONG_WORD = 256  # bytes from which a word is hashed on its own
_STEP = U(0x9E3779B97F4A7C15)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words given by their bounds; another seed gives independent ones."""
    length = ends - starts
    out = mix64(length.astype(U) + U(int(_STEP) * (seed + 1) & (1 << 64) - 1))
    # Every place of the bytes as the start of a 64-bit number; the words are read from these.
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    own = np.flatnonzero(length < _LONG_WORD)
    at, left = starts[own], length[own]
    while len(own):
        part = eights[at] & _LOW_BYTES[np.minimum(left, 8)]
        out[own] = mix64((out[own] ^ part) * _STEP + U(seed))
        more = left > 8
        own, at, left = own[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length >= _LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], seed)
    return out


class Windows:
    """Hashes of all windows of some lengths over a row of element hashes, each made of two shorter ones."""

    def __init__(self, elements: np.ndarray):
        self._known = {1: elements}

    def __call__(self, length: int) -> np.ndarray:
        """One hash for each place at which a window of the length fits."""
        if length not in self._known:
            half = -(-length // 2)
            part = self(half)
            n = max(0, len(part) - (length - half))
            self._known[length] = mix64(part[:n] * _STEP + part[length - half : length - half + n])
        return self._known[length]


def runs_of(flags: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` flags in a row are set from each place on."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    out = np.zeros(len(flags), bool)
    if len(flags) >= length:
        out[: len(flags) - length + 1] = total[length:] - total[:-length] == length
    return out


def cover(starts: np.ndarray, length: int | np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in an interval that begins at ``starts``."""
    change = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(
        np.minimum(starts + length, size), minlength=size + 1
    )
    return np.cumsum(change)[:size] > 0
