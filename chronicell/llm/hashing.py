"""Vectorised hashes of words and word shingles over many texts at once (numpy, one pass over the bytes)."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORDS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


class _Powers:
    """Powers of the base and of its inverse, as far as any text so far needed them."""

    up, down = np.ones(1, _U), np.ones(1, _U)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            cls.up = np.cumprod(np.append(np.ones(1, _U), np.full(size - 1, _BASE, _U)))
            cls.down = np.cumprod(np.append(np.ones(1, _U), np.full(size - 1, _INVERSE, _U)))
        return cls.up[:n], cls.down[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text). Words: runs of ASCII letters and digits and of
    bytes over 127. Texts are to be lower-cased before."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    up, down = _Powers.upto(len(data))
    inside = _WORDS[data]
    edge = np.diff(inside.view(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.cumsum(_BYTE[data] * up)
    before = np.where(start > 0, sums[start - 1], _U(0))
    hashes = mix((sums[end - 1] - before) * down[start])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(start, ends), prepend=0)


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle in order, number of shingles of each text); a text of fewer words but at least one forms
    one shingle of all its words."""
    return shingles_of(*word_hashes(texts), width)


def shingles_of(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from the hashes of words and the number of words of each text."""
    if not len(words):
        return words, counts
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.append(words, np.zeros(width, _U))
    left = np.repeat(counts, counts) - place  # words from here to the end of the text
    h = np.zeros(len(words), _U)
    for k in range(width):
        h = h * _U(0x9DDFEA08EB382D69) + np.where(left > k, padded[k : k + len(words)], _U(0))
    keep = (left >= width) | ((place == 0) & (left < width))
    n = np.bincount(doc[keep], minlength=len(counts))
    return mix(h[keep]), n
