"""Token ids in Parquet files: list columns, dictionary and delta encodings, controlled row groups, page indexes.

Texts are tokenised with the ``tokenizers`` library. Its BPE model sees each distinct run of letters of a chunk once; words
in which its normaliser or splitter could do more than lower-case and split at letters go through its full
pipeline, one word at a time, as it drops white space and nothing reaches across it.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.storage import prepare
from tallyforge.llm.text import _LOWER, _SPACE, Chunk, chunks, find_words, span_hashes

END_ID = 2
#: Ids in a row group and in a file, bytes of a data page, and distinct units that a worker remembers.
GROUP_IDS, FILE_IDS, PAGE_BYTES, CACHE = 2 << 20, 64 << 20, 256 << 10, 600_000
#: Ids that one task should read back.
READ_IDS = 2 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
# Bytes that send a word through the full pipeline: apostrophes (contractions), "<" (added tokens), control bytes, and
# lead bytes of characters outside U+00C0 to U+027F.
_SPECIAL = np.zeros(256, dtype=bool)
_SPECIAL[[0x27, 0x3C, 0x7F, *range(0, 9), *range(14, 32), *range(0xC0, 0xC3), *range(0xCA, 0x100)]] = True


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class WordTokenizer:
    """A tokenizer of the library with a bounded memory of what units of text become."""

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _ids(self, units: list[bytes], plain: list[bool]) -> list[tuple[int, ...]]:
        """Ids of each unit; a ``plain`` one is a run of letters that needs no more than lower-casing."""
        out: list = [None] * len(units)
        whole = []
        for i, unit in enumerate(units):
            if not plain[i]:
                whole.append(i)
                continue
            if not unit.isascii():
                unit = unicodedata.normalize("NFC", unit.decode()).lower().encode()
            out[i] = tuple([t.id for t in self.model.tokenize("".join([self.letters[b] for b in unit]))])
        for i, found in zip(whole, self.library.encode_batch([units[i].decode() for i in whole], add_special_tokens=False)):
            out[i] = tuple(found.ids)
        return out

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and the number of ids of each text."""
        words = find_words(chunk)
        data = _LOWER[chunk.data]
        special = _SPECIAL[data]
        # U+00D7 and U+00F7 are the two signs in that range, and U+0130 the letter that two characters replace.
        special[1:] |= ((data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))) | ((data[:-1] == 0xC4) & (data[1:] == 0xB0))
        counts = np.concatenate([[0], np.cumsum(special)])
        full = counts[words.ends] > counts[words.starts]
        kind = np.zeros(len(data), dtype=np.uint8)  # 1 letter, 2 other; a word of the full pipeline is all 2
        within = ~_SPACE[data]
        kind[within] = np.where(_LETTER[data[within]], 1, 2)
        if full.any():
            lengths = (words.ends - words.starts)[full]
            at = np.repeat(words.starts[full] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            kind[at], data[at] = 2, chunk.data[at]
        change = np.ones(len(data), dtype=bool)
        change[1:] = kind[1:] != kind[:-1]
        change[chunk.offsets[chunk.offsets < len(data)]] = True
        marks = np.flatnonzero(change)
        ends, used = np.append(marks[1:], len(data)), kind[marks] > 0
        starts, ends = marks[used], ends[used]
        _, sample, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        units = [raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist())]
        found = list(map(self.known.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(missing) > CACHE:
            self.known.clear()
        for i, ids in zip(missing, self._ids([units[i] for i in missing], (kind[starts[sample[missing]]] == 1).tolist())):
            found[i] = ids
            if len(units[i]) <= 64:
                self.known[units[i]] = ids
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(sizes.sum()))
        counts = sizes[which]
        totals = np.concatenate([[0], np.cumsum(counts)])
        shift = (np.cumsum(sizes) - sizes)[which] - totals[:-1]
        ids = flat[np.repeat(shift, counts) + np.arange(totals[-1])]
        return ids, np.diff(totals[np.searchsorted(starts, chunk.offsets)])


_loaded: dict[bytes, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    key = hashlib.md5(definition.encode()).digest()
    if key not in _loaded:
        _loaded[key] = WordTokenizer(definition)
    return _loaded[key]


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


_FILE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("token_ids", pa.list_(pa.field("element", pa.int32())))])
_MANIFEST = "file string, task int, number int, first_id long, last_id long, rows long, tokens long"


class _File:
    """One file that is being written, row group by row group."""

    def __init__(self, system: fs.FileSystem, root: str):
        self.name = f"{uuid.uuid4().hex}.parquet"
        self.stream = system.open_output_stream(f"{root}/{self.name}")
        self.writer = pq.ParquetWriter(
            self.stream, _FILE, compression="zstd", use_dictionary=["token_ids.list.element"], write_page_index=True, data_page_size=PAGE_BYTES,
            column_encoding={c: "DELTA_BINARY_PACKED" for c in ("doc_id", "start", "n_tokens")}, data_page_version="2.0",
        )
        self.rows = self.tokens = self.waiting = 0
        self.parts: list[tuple] = []
        self.first = self.last = None

    def add(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((names, ids, counts))
        self.first = names[0].as_py() if not self.rows else self.first
        self.last = names[-1].as_py()
        self.rows += len(counts)
        self.waiting += len(ids)
        if self.waiting >= GROUP_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.parts:
            return
        ids, counts = np.concatenate([p[1] for p in self.parts]), np.concatenate([p[2] for p in self.parts])
        edges = np.concatenate([[0], np.cumsum(counts)])
        lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids, pa.int32()))
        names = pa.concat_arrays([p[0] for p in self.parts])
        self.writer.write_table(pa.Table.from_arrays([names, pa.array(self.tokens + edges[:-1]), pa.array(counts), lists.cast(_FILE.field("token_ids").type)], schema=_FILE))
        self.tokens += int(edges[-1])
        self.parts, self.waiting = [], 0

    def close(self) -> None:
        self.flush()
        self.writer.close()
        self.stream.close()


def write_tokens(docs: DataFrame, definition_path: str, path: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID, partitions: int | None = None) -> None:
    """Tokenise every text (NULL counts as empty), append ``end_id`` to each and write the ids in ascending id order below ``path``.

    Rows are dealt by range of the id and sorted within it (NULL ids first, equal ids by text); each task writes its files in
    order and reports them. The reports form the manifest, so that a file of a failed or repeated attempt is never read.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(definition_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    files = f"{path}/files"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(shared.value)
        system, root = fs.FileSystem.from_uri(files)
        system.create_dir(root, recursive=True)
        done: list[_File] = []
        for batch in batches:
            for chunk in chunks(batch.column(1), 2 << 20):
                if not done or done[-1].tokens + done[-1].waiting >= FILE_IDS:
                    if done:
                        done[-1].close()
                    done.append(_File(system, root))
                done[-1].add(batch.column(0).slice(chunk.first, len(chunk)), *_with_end(*tokenizer.encode(chunk), end_id))
        if done:
            done[-1].close()
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pylist(
                [{"file": f.name, "task": task, "number": i, "first_id": f.first, "last_id": f.last, "rows": f.rows, "tokens": f.tokens} for i, f in enumerate(done)],
                schema=pa.schema([("file", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("rows", pa.int64()), ("tokens", pa.int64())]),
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ranged = rows.repartitionByRange("doc_id") if partitions is None else rows.repartitionByRange(partitions, "doc_id")
    ranged.sortWithinPartitions("doc_id", "text").mapInArrow(run, _MANIFEST).write.parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str, columns: Sequence[str] = ("token_ids",), first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """``doc_id, start, n_tokens`` and what ``columns`` asks for: ``token_ids`` and ``ids_crc32`` (of the ids as little-endian 32-bit numbers).

    Without columns the ids are not read. Bounds on the id choose files by the manifest, row groups by their statistics.
    ``start`` counts the ids of all documents before.
    """
    prepare(spark)
    files = f"{path}/files"
    # One row per file.
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = spark.read.parquet(f"{path}/manifest").withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    if first_id is not None:
        manifest = manifest.where(F.col("last_id") >= first_id)
    if last_id is not None:
        manifest = manifest.where(F.col("first_id") <= last_id)
    wanted = list(columns)
    kinds = {"token_ids": "array<int>", "ids_crc32": "long"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(files)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{root}/{name}") as stream:
                    yield from _file_rows(pq.ParquetFile(stream), base)

    def _file_rows(file: pq.ParquetFile, base: int) -> Iterator[pa.RecordBatch]:
        for group in range(file.num_row_groups):
            bounds = file.metadata.row_group(group).column(0).statistics
            if bounds is not None and bounds.has_min_max and ((first_id is not None and bounds.max < first_id) or (last_id is not None and bounds.min > last_id)):
                continue
            rows = file.read_row_group(group, columns=["doc_id", "start", "n_tokens", *(["token_ids"] if wanted else [])])
            if first_id is not None:
                rows = rows.filter(pc.greater_equal(rows["doc_id"], first_id))
            if last_id is not None:
                rows = rows.filter(pc.less_equal(rows["doc_id"], last_id))
            for piece in rows.combine_chunks().to_batches(max_chunksize=4096):
                out = [piece.column(0), pc.add(piece.column(1), base), piece.column(2)]
                for c in wanted:
                    out.append(piece.column(3) if c == "token_ids" else _crc(piece.column(3)))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", *wanted])

    schema = "doc_id long, start long, n_tokens long" + "".join(f", {c} {kinds[c]}" for c in wanted)
    # As many tasks as the ids ask for, one file each at most; a number that is given is not merged by adaptive execution.
    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).first()
    tasks = max(1, min(size["files"], -(-size["tokens"] // READ_IDS)))
    return manifest.select("file", "base").repartition(tasks).mapInArrow(run, schema)


def _crc(lists: pa.ListArray) -> pa.Array:
    values, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
    return pa.array([zlib.crc32(values[a:b].astype("<u4")) for a, b in zip(edges[:-1], edges[1:])], pa.int64())
