"""Hashes of the words of many texts at once, in numpy.

A word is a run of bytes other than ASCII white space, so UTF-8 texts need no decoding. Its hash is a polynomial over
random byte values modulo 2**64, finished by a bit mixer: equal words have equal hashes in every process; different words
share one with a chance of about n * n / 2**65 among n words.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
_draw = np.random.default_rng(20240229)
BYTE_VALUES = _draw.integers(1, 2**63, 256, dtype=np.uint64)
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2**64, for i below n."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a byte array."""
    solid = np.zeros(len(data) + 2, dtype=np.int8)
    solid[1:-1] = ~SPACES[data]
    step = np.diff(solid)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _block(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    joined = b"\n".join(texts)
    if lower:
        joined = joined.translate(LOWERED)
    data = np.frombuffer(joined, dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    begin, end = word_spans(data)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:-1], out=total[1:])
    hashes = mix((total[end] - total[begin]) * down[begin])
    return hashes, np.diff(np.searchsorted(begin, ends), prepend=0)


def word_hashes(texts: list[bytes], lower: bool = True, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, text after text, and the number of words of each text."""
    hashes, counts, held, size = [], [], [], 0
    for k, text in enumerate(texts):
        held.append(text)
        size += len(text)
        if size >= block or k == len(texts) - 1:
            h, n = _block(held, lower)
            hashes.append(h)
            counts.append(n)
            held, size = [], 0
    if not counts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def column_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
