"""Hashes of words and word n-grams, computed for whole batches of texts at once.

Words are runs of characters other than the six ASCII white space characters. A word's hash is a
polynomial in its bytes, taken from prefix sums, and then mixed; an n-gram's hash combines those of
its words. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text that are hashed at a time (a longer word: by itself).
CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = np.array(h, np.uint64, ndmin=1)  # a copy, which is changed in place
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=2)
def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; kept for windows, computed anew for longer words."""
    if _tables and len(_tables[0][0]) >= n:
        return _tables[0]
    size = max(n, CHUNK_BYTES + 2)
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.ones(size, np.uint64)
        p[1:] = np.uint64(base)
        made.append(np.multiply.accumulate(p))
    if size <= CHUNK_BYTES + 2:
        _tables[:] = [tuple(made)]
    return tuple(made)


def _edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end; the data begins and ends with white space."""
    inside = ~_SPACE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[::2], edges[1::2]


def _windows(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of words that lie within a window of bytes, or of one word."""
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, side="right")), i + 1)
        yield i, j
        i = j


def word_hashes(texts: list[bytes], fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and where each text's words begin (one more at the end)."""
    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    starts, ends = _edges(data)
    h = np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for i, j in _windows(starts, ends):
            lo = starts[i]
            values = _byte_values(fold)[data[lo : ends[j - 1]]]
            power, inverse = _powers(len(values) + 1)
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values * power[: len(values)], out=sums[1:])
            h[i:j] = mix((sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * inverse[starts[i:j] - lo])
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return h, np.searchsorted(starts, begins)


def ngrams(h: np.ndarray, offsets: np.ndarray, n: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all n-grams of words by text, and where each text's begin. With ``short`` a
    text of fewer words, but one at least, has its whole sequence as its only n-gram."""
    words = np.diff(offsets)
    full = np.maximum(words - n + 1, 0)
    counts = full + ((words > 0) & (words < n)) if short else full
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(out_offsets[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(h) >= n:
            rolled = np.zeros(len(h) - n + 1, np.uint64)
            for j in range(n):
                rolled = rolled * np.uint64(_BASE) + h[j : len(h) - n + 1 + j]
            rolled = mix(rolled)
            at = np.repeat(offsets[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
            out[np.repeat(out_offsets[:-1], full) + np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)] = rolled[at]
        if short:
            for i in np.flatnonzero((words > 0) & (words < n)).tolist():
                v = words[i].astype(np.uint64)
                for x in h[offsets[i] : offsets[i + 1]]:
                    v = v * np.uint64(_BASE) + x
                out[out_offsets[i]] = mix(np.array([v ^ np.uint64(0x5851F42D4C957F2D)]))[0]
    return out, out_offsets


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` bytes together, or of one text."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) + 1 > limit - 1:
            yield begin, i
            begin, held = i, 0
        held += len(t) + 1
    if texts:
        yield begin, len(texts)


def _shape_classes() -> np.ndarray:
    """Bytes by what they look like: small letters and bytes of other scripts, capitals, digits,
    white space, and every sign by itself."""
    kind = np.arange(256, dtype=np.uint64)
    kind[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    return kind


_SHAPES = _shape_classes()


def shape_hashes(texts: list[bytes]) -> np.ndarray:
    """The hash of the shape of each word, in the order of ``word_hashes``: its bytes' looks with
    runs of one look put together."""
    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    starts, ends = _edges(data)
    h = np.empty(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for i, j in _windows(starts, ends):
            lo = starts[i]
            look = _SHAPES[data[lo : ends[j - 1]]]
            kept = np.ones(len(look), bool)
            kept[1:] = look[1:] != look[:-1]
            rank = np.cumsum(kept)
            power, inverse = _powers(len(look) + 2)
            sums = np.zeros(len(look) + 1, np.uint64)
            np.cumsum(np.where(kept, mix(look + np.uint64(7)) * power[rank], np.uint64(0)), out=sums[1:])
            h[i:j] = mix((sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * inverse[rank[starts[i:j] - lo]])
    return h
