"""Words and hashes of many texts at once, on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# White space is byte 0x20 and 0x09 to 0x0D; A-Z are lower-cased.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

CHUNK = 2 << 20  # bytes handled at once; one longer text is handled alone
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK + 1)
        _powers, _inverses = _table(_BASE, size), _table(pow(_BASE, -1, 1 << 64), size)
    return _powers[:n], _inverses[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes one after the other, and where each begins; null counts as empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    data, offsets = as_bytes(column)
    first, n = 0, len(column)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, n, first + 65536)
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]
        first = last


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with (H[b] - H[a]) * inverse power a: the polynomial of bytes a to b."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    power, _ = powers(len(data) + 1)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=out[1:])
    return out


def spans(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; the length is part of the hash."""
    _, inverse = powers(len(prefix))
    value = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def runs(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of non-separator bytes: starts, ends, and each text's first run (rows + 1)."""
    if len(data) == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    inside = ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    begin, end = offsets[:-1][full], offsets[1:][full] - 1
    first[begin] = inside[begin]
    last[end] = inside[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word (rows + 1)."""
    starts, ends, at = runs(data, offsets, SPACE)
    return spans(prefix_hashes(LOWER[data] if lower else data), starts, ends), at


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text; fewer words make one shingle of all."""
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_at = np.concatenate(([0], np.cumsum(count)))
    keys = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    first = np.repeat(at[:-1] - out_at[:-1], count) + np.arange(out_at[-1])
    size = np.repeat(np.minimum(n, k), count)
    value = size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for i in range(k):
        there = first + i
        value = value + np.where(i < size, words[np.minimum(there, max(len(words) - 1, 0))] if len(words) else 0, 0).astype(np.uint64) * keys[i]
    return mix(value), out_at
