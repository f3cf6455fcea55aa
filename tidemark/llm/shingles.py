"""Word and shingle hashes of whole Arrow batches, in numpy. One text at a time is never looped over."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A fixed random value for each byte.
_BYTES = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Texts are hashed in groups of about so many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, GROUP_BYTES)
        for k, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of texts; nulls are empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, last, data[offs[first] : offs[last]], offs[first : last + 1] - offs[first]
        first = last


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word."""
    solid = ~_SPACE[data]
    first = np.empty(len(data) + 1, bool)
    first[:-1] = solid
    first[1:-1] &= ~solid[:-1]
    first[-1] = False
    last = np.zeros(len(data) + 1, bool)
    last[1:] = solid
    last[1:-1] &= ~solid[1:]
    inner = offs[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] |= solid[inner]
    last[inner] |= solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))
    return start, end, doc


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start])


def word_counts(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n)


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each run of `size` words; a text with fewer words has one shingle of all of them."""
    counts = word_counts(doc, n)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    short = (counts > 0) & (counts < size)
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for j in range(size):
        total += words[j : j + len(total)] * np.uint64(2 * j + 0x2545F4914F6CDD1D)
        total = mix(total) if j < size - 1 else total
    inside = doc[: len(total)] == doc[size - 1 :] if len(total) else np.zeros(0, bool)
    hashes, docs = mix(total[inside]), doc[: len(total)][inside]
    if short.any():
        extra = []
        for d in np.flatnonzero(short):
            h = np.uint64(counts[d])
            for w in words[firsts[d] : firsts[d + 1]]:
                h = mix(np.array([h + w]))[0]
            extra.append(h)
        hashes, docs = np.concatenate((hashes, np.array(extra, np.uint64))), np.concatenate((docs, np.flatnonzero(short)))
        order = np.argsort(docs, kind="stable")
        hashes, docs = hashes[order], docs[order]
    return hashes, docs
