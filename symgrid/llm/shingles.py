"""Hashes of word shingles, vectorised over a block of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = np.random.default_rng(2).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Bytes hashed at a time; a longer text is a block of its own.
BLOCK = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> _U(30))
    values = values * _U(0xBF58476D1CE4E5B9)
    values = values ^ (values >> _U(27))
    values = values * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        if block and size + len(text) + 1 > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text) + 1
    if block:
        yield block


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words; A-Z count as lower case."""
    for block in _blocks([(text or "").encode("utf-8", "replace").lower() for text in texts]):
        data = np.frombuffer(b"\n".join(block) + b"\n", np.uint8)
        inside = np.concatenate(([False], ~_BLANK[data]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[0::2], edges[1::2]
        inverse = _powers(_INVERSE, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        limits = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in block]))
        yield from np.split(hashes, limits[:-1])


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, sorted; of fewer words the whole sequence; of none an empty set."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total += words[k : k + count] * _PLACES[k]
    return np.unique(mix(total))


def shingle_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    for words in word_hashes(texts):
        yield shingle_set(words, size)
