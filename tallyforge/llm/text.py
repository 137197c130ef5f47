"""Words, word hashes and windows of Arrow text columns, computed with numpy a few megabytes at a time.

A word is a run of bytes other than blank and ``\\t \\n \\v \\f \\r``; these bytes never occur inside a
multi-byte character, so that the UTF-8 bytes split as the characters do. Hashes have 64 bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer document forms a chunk of its own.
CHUNK_BYTES = 1 << 20
WORD = "[^\\x20\\x09-\\x0D]+"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_random = np.random.Generator(np.random.PCG64(20240))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_ODD = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


# Python workers are used again by later stages. Large arrays go back to the system when freed, if the C library can do so.
_libc = ctypes.CDLL(None)
if hasattr(_libc, "mallopt"):
    _libc.mallopt(-3, 1 << 20)


def trim() -> None:
    """Give memory back at the end of a task that held much of it: the tables of powers, what Arrow keeps, what is freed."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A function over the batches of a task, with ``trim`` at the task's end; the worker may be used again by a later stage."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the next chunk."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, CHUNK_BYTES + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
        _powers[:] = out
    return _powers[0], _powers[1]


@dataclass
class Chunk:
    """Some documents of a batch: rows ``first`` to ``last``, their bytes and where each of them starts."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a text column (NULL counts as empty) into chunks of whole documents."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, ends, values = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        start, end = offsets[first], offsets[last]
        yield Chunk(first, last, data[start:end], offsets[first : last + 1] - start)
        first = last


@dataclass
class Words:
    """Words of a chunk: byte spans, and ``bounds[i] : bounds[i + 1]`` as the words of document i."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def document(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def find_words(chunk: Chunk) -> Words:
    return _spans(~_SPACE[chunk.data], chunk.offsets)


def _spans(inside: np.ndarray, offsets: np.ndarray) -> Words:
    first, last = inside.copy(), inside.copy()
    if len(inside):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(inside))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of each byte span, in ascending order of the spans; ``lower`` maps A-Z to a-z first.

    Works through about CHUNK_BYTES of bytes at a time, so that the tables of powers and sums stay small.
    """
    table = _BYTE[_LOWER] if lower else _BYTE
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + CHUNK_BYTES, "right")))
        a, b = starts[first:last] - origin, ends[first:last] - origin
        powers, inverse = _power_table(int(b[-1]) + 1)
        sums = np.zeros(int(b[-1]) + 1, dtype=np.uint64)
        np.cumsum(table[data[origin : origin + b[-1]]] * powers[: b[-1]], out=sums[1:])
        out[first:last] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = last
    return out


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive items; entry i covers items i to i + width - 1."""
    count = max(0, len(hashes) - width + 1)
    total = np.full(count, (width * int(_ODD[63])) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : k + count] * _ODD[k]
    return mix(total)


def window_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """Whether a window that starts at each item stays inside its document."""
    inside = np.zeros(int(bounds[-1]) if len(bounds) else 0, dtype=bool)
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= width:
            inside[start : end - width + 1] = True
    return inside


def covered(flags: np.ndarray, width: int) -> np.ndarray:
    """Which items lie in a flagged window; ``flags`` has one entry per item that starts a window."""
    steps = np.zeros(len(flags) + width + 1, dtype=np.int32)
    at = np.flatnonzero(flags)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return np.cumsum(steps)[: len(flags)] > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
