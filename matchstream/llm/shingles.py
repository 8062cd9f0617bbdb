"""Hashed word shingles of whole texts, vectorised over the bytes of a batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from matchstream.llm.common import mixed, pieces

#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A random value for each byte after lower-casing A-Z; white space counts nothing.
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]
_VALUE[_SPACE] = 0

_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(max(n, CHUNK_BYTES + (1 << 16)), base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _POWERS[:] = [(both[0], both[1])]
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def word_hashes(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and for each text where its words end."""
    data = np.frombuffer(b"\n".join([*rows, b""]), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(r) + 1 for r in rows])
    bounds = np.searchsorted(starts, ends)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    powers, inverse = _powers(len(data))
    sums = np.add.reduceat(_VALUE[data] * powers, starts)
    return mixed(sums * inverse[starts]), bounds


#: One odd factor for each place in a shingle.
_PLACES = mixed(np.arange(100, 164, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(rows: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer than ``width`` words has its whole word sequence as its
    only shingle; a text without words has none.
    """
    for a, b in pieces([len(r) for r in rows], CHUNK_BYTES):
        words, bounds = word_hashes(rows[a:b])
        count = max(0, len(words) - width + 1)
        hashes = np.zeros(count, np.uint64)
        for k in range(width):
            hashes += words[k : k + count] * _PLACES[k]
        hashes = mixed(hashes)
        start = 0
        for end in bounds.tolist():
            n = end - start
            if n >= width:
                yield np.unique(hashes[start : end - width + 1])
            elif n:
                yield mixed(np.sum(words[start:end] * _PLACES[:n], keepdims=True) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)
            start = end


def signature(hashes: np.ndarray) -> bytes:
    """A digest of a set of shingles."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
