"""Word shingles of a batch of texts as 64-bit hashes, vectorised with numpy.

Words are maximal runs of non-white-space characters (white space: space and
``\\x09``-``\\x0D``) after lower-casing A-Z.  A word's hash in a shingle is the
64-bit XXH3 of its UTF-8 bytes, made once for each distinct word of a chunk; a
shingle's hash mixes the hashes of its words in order.  XXH3 has no known
families of colliding words; were its values random, two different shingles of
one pair of texts would collide with a chance of about ``n**2 / 2**64``, that
is 1e-11 for texts of 20,000 words.

:func:`_hashes_of` is a faster polynomial of the bytes modulo 2**64.  Words
that collide can be constructed for it, so it only serves where a collision
changes a weight, not a result (the hashed scorer).
"""

from __future__ import annotations

from typing import List, Optional, Sequence

import numpy as np
import xxhash

from .wordblocks import distinct_words

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)
_MIX = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _MIX
    x = (x ^ (x >> _U(29))) * _MIX
    return x ^ (x >> _U(32))


_BYTE = _mix((np.arange(1, 257, dtype=_U) * _MUL))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[_U(1)], np.cumprod(np.full(max(n - 1, 0), _MUL, _U))]).astype(_U)


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of one lower-cased UTF-8 text, in order."""
    return _hashes_of(np.frombuffer(data, np.uint8))[0]


def _hashes_of(b: np.ndarray):
    """(hash of each word, its start) in a byte array."""
    if len(b) == 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if len(starts) == 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    lens = ends - starts
    at = np.flatnonzero(inside)                       # the words' bytes, back to back
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    within = np.arange(len(at)) - np.repeat(first, lens)
    v = _BYTE[b[at]] * _powers(int(lens.max()))[within]
    return _mix(np.add.reduceat(v, first) + lens.astype(_U)), starts


def _sound_hashes(data: bytes):
    """(XXH3 of each word, its start) in a text."""
    b = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, lens = edge[0::2], edge[1::2] - edge[0::2]
    if len(starts) == 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    one, number = distinct_words(data, starts, lens)
    of = xxhash.xxh3_64_intdigest
    values = np.fromiter((of(data[s:s + n]) for s, n in zip(starts[one].tolist(), lens[one].tolist())), _U, len(one))
    return values[number], starts


def shingle_sets(texts: Sequence[Optional[str]], width: int, chunk_bytes: int = 1 << 20) -> List[np.ndarray]:
    """For each text its sorted distinct shingle hashes (uint64).

    A text with fewer than ``width`` words (but at least one) has its whole
    word sequence as one shingle; null, empty and blank texts have none.
    Texts are hashed together in chunks, so memory follows ``chunk_bytes`` and
    the longest text."""
    out: List[np.ndarray] = []
    pending: List[bytes] = []
    size = 0
    for t in texts:
        pending.append(b"" if t is None else t.encode("utf-8", "surrogatepass").lower())
        size += len(pending[-1]) + 1
        if size >= chunk_bytes:
            out += _sets(pending, width)
            pending, size = [], 0
    return out + (_sets(pending, width) if pending else [])


def _sets(datas: List[bytes], width: int) -> List[np.ndarray]:
    with np.errstate(over="ignore"):
        h, starts = _sound_hashes(b" ".join(datas))
        bounds = np.cumsum([0] + [len(d) + 1 for d in datas])
        cut = np.searchsorted(starts, bounds)
        rolled = None
        if len(h) >= width:
            rolled = h[:len(h) - width + 1].copy()
            for k in range(1, width):
                rolled = rolled * _MUL + h[k:len(h) - width + 1 + k]
                rolled ^= rolled >> _U(31)
            rolled = _mix(rolled)
        out = []
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if z - a >= width:
                out.append(np.unique(rolled[a:z - width + 1]))
            elif z > a:
                one = h[a].copy()
                for k in range(a + 1, z):
                    one = one * _MUL + h[k]
                    one ^= one >> _U(31)
                # the length takes part: no full shingle equals it
                out.append(_mix(np.array([one ^ (_U(z - a) << _U(56))], _U)))
            else:
                out.append(np.empty(0, _U))
        return out
