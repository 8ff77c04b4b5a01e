"""Hashed word shingles of texts, vectorised over a text's bytes."""

from __future__ import annotations

import hashlib

import numpy as np

SIZE = 5  # words a shingle

_rng = np.random.default_rng(20160501)  # fixed: every worker draws the same numbers
_odd = lambda *shape: _rng.integers(0, 2**63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _odd(256)
_BYTE[[9, 10, 11, 12, 13, 32]] = 0  # white space separates words
_PLACE = _odd(4096)
_WORD = _odd(64)
_MINHASH = _odd(512)
_IS_WORD = _BYTE != 0
_COLUMNS = 2048  # shingles hashed at once, so that the block stays in the cache


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    inside = _IS_WORD[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data))
    place -= np.repeat(starts, np.diff(starts, append=len(data))) if starts[0] == 0 else np.concatenate(
        [np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(starts, append=len(data)))])
    place &= len(_PLACE) - 1
    return _mixed(np.add.reduceat(_BYTE[data] * _PLACE[place], starts))


def shingles(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.  A text of
    fewer words is one shingle; one without words has none."""
    if not text:
        return np.zeros(0, np.uint64)
    words = word_hashes(text)
    n = min(size, len(words))
    if n == 0:
        return words
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k:len(words) - n + 1 + k] * _WORD[k]
    return np.unique(_mixed(total + np.uint64(n)))


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def minhashes(hashes: np.ndarray, n: int, draw: int = 0) -> np.ndarray:
    """`n` minimum hashes (32 bits) of a set that is not empty; other ones for
    every `draw`."""
    factors = _MINHASH[:n, None]
    if draw:
        factors = np.random.default_rng(20160501 + draw).integers(0, 2**63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _COLUMNS):
        np.minimum(least, (factors * hashes[None, at:at + _COLUMNS]).min(axis=1), out=least)
    return (_mixed(least) >> np.uint64(32)).astype("<u4")
