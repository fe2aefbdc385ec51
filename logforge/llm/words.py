"""Vectorised words, hashes and texts over Arrow batches, shared by the operators here."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at once; numpy needs about 60 times as much for a moment.
CHUNK_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIERS = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], _U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def _grow(n: int) -> None:
    """Powers of the base and of its inverse up to ``n``."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = max(n + 1, 2 * CHUNK_BYTES)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=_U)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` takes the hash of any span from them."""
    _grow(len(data))
    out = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _powers[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes from ``start`` to ``end``, equal for equal bytes anywhere."""
    return mix((prefix[end] - prefix[start]) * _inverses[start] + (end - start).astype(_U) * _MULTIPLIERS[0])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the row offsets of a text column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and offsets of runs of rows of about ``most`` bytes."""
    data, offsets = buffers(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1), at + 5000)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


@dataclass
class Words:
    """Words of a chunk in text order: row in the chunk, span and hash of each."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of each row: index of its first word; one more at the end


def tokenize(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Words between ``space`` bytes, with A-Z lower-cased; none crosses a row."""
    data = LOWER[data]
    n, rows = len(data), len(offsets) - 1
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = inside[1:] & (~inside[:-1] | edge)
    stop = inside[:-1] & (~inside[1:] | edge)
    start, end = np.flatnonzero(begin), np.flatnonzero(stop)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    return Words(row, start, end, span_hash(prefix_hash(data), start, end), first)


def shingles(words: Words, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and hash of each run of ``size`` words.

    With ``short`` a row of fewer words gives its whole sequence as one run.
    """
    n, h = len(words.hash), words.hash
    if size > len(_MULTIPLIERS):
        raise ValueError(f"at most {len(_MULTIPLIERS)} words")
    total = max(0, n - size + 1)
    run = np.zeros(total, _U)
    for k in range(size):
        run += h[k : k + total] * _MULTIPLIERS[k]
    at = np.flatnonzero(words.row[:total] == words.row[size - 1 : size - 1 + total]) if total else np.zeros(0, np.int64)
    row, out = words.row[at], mix(run[at])
    if short:
        count = np.diff(words.first)
        few = np.flatnonzero((count > 0) & (count < size))
        extra = np.zeros(len(few), _U)
        for k in range(size - 1):
            has = count[few] > k
            extra[has] += h[words.first[few[has]] + k] * _MULTIPLIERS[k]
        extra = mix(extra + count[few].astype(_U))
        row, at, out = np.concatenate([row, few]), np.concatenate([at, words.first[few]]), np.concatenate([out, extra])
    return row, at, out


def starts(values: np.ndarray) -> np.ndarray:
    """Where a sorted array's runs of equal values begin."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
