"""The distinct words of a block of bytes, found with numpy."""

from __future__ import annotations

from typing import Tuple

import numpy as np

_U = np.uint64
_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [(1 << 64) - 1], _U)
_WIDE = 3                                  # words of up to 24 bytes are compared as three integers


def distinct_words(data: bytes, starts: np.ndarray, lens: np.ndarray) -> Tuple[np.ndarray, np.ndarray]:
    """(an index of one occurrence of each distinct word, the number of its
    distinct word for every occurrence).

    Words of up to 24 bytes are compared as a whole (a hash only sorts them,
    and its groups are checked); a longer word counts as its own."""
    if len(starts) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    padded = np.frombuffer(data + bytes(8 * _WIDE), np.uint8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    parts = []
    for k in range(_WIDE):
        here = np.clip(lens - 8 * k, 0, 8)
        parts.append(eight[np.minimum(starts + 8 * k, len(eight) - 1)] & _MASK[here])
    with np.errstate(over="ignore"):
        h = lens.astype(_U)
        for p in parts:
            h = (h ^ p) * _U(0x9E3779B97F4A7C15)
            h ^= h >> _U(29)
    long = lens > 8 * _WIDE
    if long.any():
        h[long] = np.flatnonzero(long).astype(_U) << _U(20)
    _, one, number = np.unique(h, return_index=True, return_inverse=True)
    same = lens == lens[one][number]
    for p in parts:
        same &= p == p[one][number]
    odd = np.flatnonzero(~same | long)     # hash collisions and long words: numbers of their own
    if len(odd):
        number = number.copy()
        number[odd] = len(one) + np.arange(len(odd))
        one = np.concatenate([one, odd])
    return one, number
