"""Removal of passages that an earlier document has: fixed-block anchors, rolling probes, extension.

A repeat of WINDOW words holds a whole block of BLOCK words that starts at a multiple of BLOCK in either of its
documents, as 2 * BLOCK - 1 <= WINDOW. So the blocks at these places are the index, and every rolling window of
BLOCK words is a probe. Around the probes that meet a block of another document, windows of WINDOW words are
compared as a whole; runs of equal ones are the maximal exact repeats.

Documents travel as chunks: one row holds some megabytes of them. A chunk sends each distinct hash once, packed per
hash bucket, so a passage that a third of all documents share costs one entry per chunk and no task sees its
copies; the answer for a hash goes back to the chunk, which finds the places itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.packing import bucket_bits, pack, packed, rows_of, slices, unpacked
from tallyforge.llm.storage import Scratch, extended, prepare
from tallyforge.llm.text import Chunk, chunks, covered, find_words, span_hashes, tidy, window_hashes, window_starts

WINDOW, BLOCK = 13, 7
_ENTRY_BITS = 30


class _Part:
    """Words, owners and hashes of a chunk; windows of documents without id count as absent."""

    def __init__(self, payload: bytes):
        self.table = rows_of(payload)
        ids = self.table.column(0).combine_chunks()
        whole = list(chunks(self.table.column(1), 1 << 62))
        self.chunk = whole[0] if whole else Chunk(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        self.words = find_words(self.chunk)
        self.hashes = span_hashes(self.chunk.data, self.words.starts, self.words.ends)
        self.owner = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[self.words.document()]
        self.named = pc.is_valid(ids).to_numpy(zero_copy_only=False)[self.words.document()]

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which windows of ``width`` start in documents that have room for WINDOW, and their hashes."""
        hashed = window_hashes(self.hashes, width)
        inside = window_starts(self.words.bounds, width) & self.named
        inside &= np.repeat(np.diff(self.words.bounds) >= WINDOW, np.diff(self.words.bounds))
        at = np.flatnonzero(inside)
        return at, hashed[at]

    def distinct(self, at: np.ndarray, hashed: np.ndarray):
        """Distinct hashes, for each place its index among them, and the least and largest owner of each."""
        values, which = np.unique(hashed, return_inverse=True)
        low = np.full(len(values), np.iinfo(np.int64).max)
        high = np.full(len(values), np.iinfo(np.int64).min)
        np.minimum.at(low, which, self.owner[at])
        np.maximum.at(high, which, self.owner[at])
        return values, which, low, high


def _entries(values: np.ndarray, bits: int) -> np.ndarray:
    """The bits of a hash after those that name its bucket, with room for two flags."""
    return ((values << np.uint64(bits)) >> np.uint64(64 - _ENTRY_BITS)).astype(np.uint32) << np.uint32(2)


_MESSAGE = "bucket long, chunk long, entries binary, owners binary"


def _message(bucket: list, chunk: int, entries: list, owners: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket, pa.int64()), "chunk": pa.array([chunk] * len(bucket), pa.int64()),
        "entries": pa.array(entries, pa.binary()), "owners": pa.array(owners, pa.binary()),
    })


def _probes(bits: int):
    """Per chunk and bucket the distinct block hashes: bit 0 tells an index block, bit 1 two owners in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _Part(payload.as_py())
                at, hashed = part.windows(BLOCK)
                values, which, low, high = part.distinct(at, hashed)
                starts = np.repeat(part.words.bounds[:-1], np.diff(part.words.bounds))
                index = np.zeros(len(values), dtype=np.uint32)
                index[which[(at - starts[at]) % BLOCK == 0]] = 1
                entries = _entries(values, bits) | index | np.where(low < high, np.uint32(2), np.uint32(0))
                runs = list(slices(values, bits))
                yield _message([r[0] for r in runs], chunk, [packed(entries[a:b]) for _, a, b in runs], [None] * len(runs))

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Of one bucket: which entries of each chunk are an index block of one document and a probe of another."""
    blobs = [unpacked(x.as_py()).astype(np.uint32) for x in table.column("entries")]
    every = np.concatenate(blobs)
    # Two hashes of one chunk may agree in these bits; they are then both looked at more closely.
    values, which, times = np.unique(every >> np.uint32(2), return_inverse=True, return_counts=True)
    index = np.bincount(which[(every & 1) > 0], minlength=len(values)) > 0
    several = (np.bincount(which[(every & 2) > 0], minlength=len(values)) > 0) | (times > 1)
    met, done, out = (index & several)[which], 0, []
    for blob in blobs:
        hits = blob[met[done : done + len(blob)]] & ~np.uint32(3)
        out.append(packed(hits) if len(hits) else b"")
        done += len(blob)
    return table.select(["bucket", "chunk"]).append_column("entries", pa.array(out, pa.binary())).append_column("owners", pa.nulls(len(out), pa.binary()))


def _candidates(bits: int):
    """Windows around met probes: per chunk and bucket their distinct hashes and least owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload, buckets, answers in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                part = _Part(payload.as_py())
                at, hashed = part.windows(BLOCK)
                found = [unpacked(x) | (np.uint64(b) << np.uint64(32)) for b, x in zip(buckets, answers)]
                mine = _entries(hashed, bits).astype(np.uint64)
                if bits:
                    mine |= (hashed >> np.uint64(64 - bits)) << np.uint64(32)
                hit = np.zeros(len(part.hashes) + BLOCK, dtype=np.int64)
                hit[at[np.isin(mine, np.concatenate(found))]] = 1
                sums = np.concatenate([[0], np.cumsum(hit)])
                at, hashed = part.windows(WINDOW)
                near = sums[at + WINDOW - BLOCK + 1] > sums[at]
                values, _, low, _ = part.distinct(at[near], hashed[near])
                runs = list(slices(values, bits))
                yield _message([r[0] for r in runs], chunk, [packed(values[a:b]) for _, a, b in runs], [packed(low[a:b]) for _, a, b in runs])

    return run


def _earlier(table: pa.Table) -> pa.Table:
    """Of one bucket: the windows of each chunk that a document with a smaller id in another chunk has."""
    blobs = [unpacked(x.as_py()) for x in table.column("entries")]
    owners = np.concatenate([unpacked(x.as_py()).view(np.int64) for x in table.column("owners")])
    values, which = np.unique(np.concatenate(blobs), return_inverse=True)
    low = np.full(len(values), np.iinfo(np.int64).max)
    np.minimum.at(low, which, owners)
    late, done, out = low[which] < owners, 0, []
    for blob in blobs:
        hits = blob[late[done : done + len(blob)]]
        out.append(packed(hits) if len(hits) else b"")
        done += len(blob)
    return table.select(["bucket", "chunk"]).append_column("entries", pa.array(out, pa.binary())).append_column("owners", pa.nulls(len(out), pa.binary()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each chunk with their counts and what is left of their words."""
    for batch in batches:
        for payload, answers in zip(batch.column(1), batch.column(2).to_pylist()):
            part = _Part(payload.as_py())
            at, hashed = part.windows(WINDOW)
            values, which, low, _ = part.distinct(at, hashed)
            late = part.owner[at] > low[which]
            if answers:
                late |= np.isin(values, np.concatenate([unpacked(x) for x in answers]))[which]
            flags = np.zeros(len(part.hashes), dtype=bool)
            flags[at[late]] = True
            gone, bounds = covered(flags, WINDOW), part.words.bounds
            raw, texts, removed = part.chunk.data.tobytes(), [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                left = a + np.flatnonzero(~gone[a:b])
                removed.append(b - a - len(left))
                texts.append(b" ".join([raw[s:e] for s, e in zip(part.words.starts[left].tolist(), part.words.ends[left].tolist())]).decode())
            rows = part.table.append_column("n_words", pa.array(np.diff(bounds), pa.int64()))
            rows = rows.append_column("n_removed", pa.array(removed, pa.int64())).append_column("kept_text", pa.array(texts, pa.string()))
            for piece in rows.to_batches(max_chunksize=512):
                yield piece


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (what is left of the words, joined by one blank).

    A word goes when a window of 13 words around it also starts in a document with a smaller id, judged on
    the input. NULL texts have no words; a row without id keeps all words and is no reference; rows with one
    id do not remove from each other. Other columns stay; those with the name of an output are replaced.
    Equality is that of 64-bit hashes of whole windows; the shorter keys of the probes only choose candidates.
    """
    prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    others = [c for c in docs.columns if c not in (id_column, text_column, "n_words", "n_removed", "kept_text")]
    rows = docs.select(F.col(id_column).cast("long").alias(id_column), text_column, *others)
    whole = scratch.save(pack(rows))
    bits = bucket_bits(whole)
    parts = whole.select("chunk", "payload")
    answered = (
        parts.mapInArrow(tidy(_probes(bits)), _MESSAGE).groupBy("bucket").applyInArrow(_meet, _MESSAGE).where("octet_length(entries) > 0")
        .groupBy("chunk").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("entries").alias("answers"))
    )
    late = (
        parts.join(answered, "chunk").select("chunk", "payload", "buckets", "answers").mapInArrow(tidy(_candidates(bits)), _MESSAGE)
        .groupBy("bucket").applyInArrow(_earlier, _MESSAGE).where("octet_length(entries) > 0")
        .groupBy("chunk").agg(F.collect_list("entries").alias("answers"))
    )
    schema = extended(rows.schema, n_words="long", n_removed="long", kept_text="string")
    return parts.join(late, "chunk", "left").select("chunk", "payload", "answers").mapInArrow(tidy(_cut), schema)
