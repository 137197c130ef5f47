"""Documents as chunk rows, and the compressed messages between chunks and hash buckets.

A chunk row holds some megabytes of documents. Operators that need facts about hashes from all over the table send each
distinct hash of a chunk once to the bucket of its leading bits and get the answer back per chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.text import CHUNK_BYTES, chunks, find_words, tidy

#: Bytes of text in one chunk row, and entries that one bucket should get.
CHUNK_TEXT, BUCKET_ENTRIES = 4 * CHUNK_BYTES, 1 << 21


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers, best sorted: differences by byte plane, compressed."""
    steps = np.diff(values.astype(np.uint64) if values.dtype != np.int64 else values.view(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _payload(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_of(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _pack_batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Gather rows into chunks of about ``limit`` bytes of text."""
    waiting, size = [], 0

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        words = sum(int(find_words(c).bounds[-1]) for c in chunks(rows.column(1)))
        return pa.RecordBatch.from_pydict(
            {"chunk": pa.array([uuid.uuid4().int >> 65], pa.int64()), "n_words": pa.array([words], pa.int64()), "payload": pa.array([_payload(rows)], pa.binary())}
        )

    for batch in batches:
        for chunk in chunks(batch.column(1), limit):
            waiting.append(batch.slice(chunk.first, len(chunk)))
            size += len(chunk.data)
            if size >= limit:
                yield packed()
                waiting, size = [], 0
    if waiting:
        yield packed()


def pack(rows: DataFrame, limit: int = CHUNK_TEXT) -> DataFrame:
    """Chunk rows of a table whose second column is the text."""
    return rows.mapInArrow(tidy(lambda batches: _pack_batches(batches, limit)), "chunk long, n_words long, payload binary")


def bucket_bits(chunk_rows: DataFrame) -> int:
    """Leading hash bits that name a bucket, from the number of words."""
    total = chunk_rows.agg(F.sum("n_words")).first()[0] or 0
    return max(0, (total // BUCKET_ENTRIES).bit_length())


def slices(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Runs of sorted hashes with the same leading bits."""
    buckets = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    edges = np.flatnonzero(np.diff(buckets, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(buckets))):
        yield int(buckets[a]), int(a), int(b)
