"""Whole Arrow columns of text as numpy arrays of word and n-gram hashes.

All functions work on the bytes of a block of rows at once; no Python code runs
per character or per word. Hashes are 64 bit, so two different words or n-grams
are taken for equal with probability about 5e-20 a pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# byte classes: white space, and what the benchmark words leave out
_codes = np.arange(256)
WHITE_SPACE = (_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D))
NOT_ALNUM = (_codes <= 0x2F) | ((_codes >= 0x3A) & (_codes <= 0x40)) | ((_codes >= 0x5B) & (_codes <= 0x60)) | (
    (_codes >= 0x7B) & (_codes <= 0x7F))
_LOWER = _codes.copy()
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base, and of its inverse, modulo 2**64."""
    if kind not in _powers or len(_powers[kind][0]) <= n:
        base = _BASES[kind]
        size = 1 << max(16, int(n).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[kind] = (out[0], out[1])
    return _powers[kind]


def span_hasher(values: np.ndarray, kind: str) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function (starts, ends) -> hash of values[start:end], equal wherever a span stands."""
    up, down = _power(kind, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return lambda starts, ends: mix((total[ends] - total[starts]) * down[starts])


def byte_values(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """A random 64-bit number for each byte; with ``lower``, A-Z have those of a-z."""
    return (_BYTE_LOWER if lower else _BYTE)[data]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]: at[-1]], at - at[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole rows of about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE_SPACE,
                lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row the index of its first word (one more at the end)."""
    starts, ends, first = word_spans(data, offsets, separators)
    return span_hasher(byte_values(data, lower), "byte")(starts, ends), first


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; runs over row ends must be left out by the caller."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(words) - n + 1)
    return span_hasher(words, "word")(starts, starts + n) ^ np.uint64(n * 0x2545F4914F6CDD1D % (1 << 64))


def sequence_hash(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each row."""
    counts = np.diff(first).astype(np.uint64)
    return mix(span_hasher(words, "word")(first[:-1], first[1:]) + counts * np.uint64(0x9E3779B97F4A7C15))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values, by doubling."""
    if len(values) < width:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
