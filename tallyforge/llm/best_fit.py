"""Documents as token sequences of a fixed capacity: best fit within tasks, then over what they leave, up a tree.

Each task tokenises its documents and packs their pieces as it goes, the longest piece first, each into the open
sequence that it fits best. Sequences that are nearly full are final. The others become items of the size they have;
a round deals them out to an eighth of the tasks, which pack them by best fit again, and so on up to one task. So only
two numbers per sequence that is not yet full are moved between tasks.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from tallyforge.llm.storage import Scratch, prepare
from tallyforge.llm.text import Chunk, chunks, trim
from tallyforge.llm.token_files import _byte_letters

CAPACITY, END_ID = 1024, 2
#: Pieces and ids that a task packs together, items of a later task, tasks that meet in one, and the room (as a part of the capacity) that counts as full.
PORTION, PORTION_IDS, ITEMS, FAN, ROOM = 1 << 14, 6 << 20, 1 << 17, 8, 128
# Sequence numbers: round, task, number in the task.
_TASK, _ROUND = 36, 56

# Fixed value: how a byte-level pre-tokeniser of the tokenizers library splits texts.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteTokenizer:
    """Ids of texts as the tokenizers library gives them for a definition, without special tokens around them.

    A plain byte-level definition whose merges are in the order of their ids goes through tiktoken, which merges by the same
    ranks and splits by the same pattern; all code points were compared. Texts that hold an added token, and all texts of
    any other definition, go through the library.
    """

    def __init__(self, definition: str):
        import tiktoken

        self.definition, self.library, self.fast = definition, None, None
        about = json.loads(definition)
        vocab, split = about["model"].get("vocab"), about.get("pre_tokenizer") or {}
        self.added = [t["content"] for t in about.get("added_tokens") or []]
        plain = about["model"].get("type") == "BPE" and not about.get("normalizer") and not about.get("truncation") and not about.get("padding")
        plain = plain and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        plain = plain and not any(about["model"].get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if plain:
            pairs = (m if isinstance(m, list) else m.split(" ") for m in about["model"]["merges"])
            merged = [vocab["".join(m)] for m in pairs]
            if merged == sorted(merged):
                byte = {c: b for b, c in enumerate(_byte_letters())}
                ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in self.added}
                self.fast = tiktoken.Encoding("definition", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(a in text for a in self.added):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.definition)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int32)

    def encode(self, chunk: Chunk, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, each with ``end_id`` behind it, and their numbers."""
        raw, end = chunk.data.tobytes(), np.array([end_id], dtype=np.int32)
        parts = []
        for a, b in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist()):
            parts += [self.ids(raw[a:b].decode()), end]
        return np.concatenate(parts), np.array([len(p) + 1 for p in parts[::2]])


_loaded: dict[bytes, ByteTokenizer] = {}


def _tokenizer(definition: str) -> ByteTokenizer:
    key = hashlib.md5(definition.encode()).digest()
    if key not in _loaded:
        _loaded[key] = ByteTokenizer(definition)
    return _loaded[key]


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and what each bin holds: the largest item first, into the fullest bin that has room for it.

    Sizes lie between 0 and ``capacity``. Ties go to the earlier item and to the bin that came to its room last.
    """
    into, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has r left
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
        else:
            room, number = capacity, len(fill)
            fill.append(0)
        into[item], offset[item] = number, capacity - room
        fill[number] += size
        by_room[room - size].append(number)
        open_rooms |= 1 << (room - size)
    return into, offset, np.array(fill, dtype=np.int64)


def cut(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of the pieces of documents with so many ids: all but the first have the whole capacity."""
    pieces = np.maximum(1, -(-counts // capacity))
    document = np.repeat(np.arange(len(counts)), pieces)
    number = np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (counts - (pieces - 1) * capacity)[document]
    start = np.where(number > 0, first + (number - 1) * capacity, 0)
    return document, number, start, np.where(number > 0, capacity, first)


_PIECE = [("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"), ("token_ids", "array<int>"), ("sequence_id", "bigint"), ("offset", "bigint")]


class _Packer:
    """The pieces of one task: whole ones leave at once, the others in portions that are packed together."""

    def __init__(self, name: str, capacity: int):
        self.name, self.capacity = name, capacity
        self.next = TaskContext.get().partitionId() << _TASK
        self.waiting: list[tuple] = []
        self.pieces = self.ids = 0

    def add(self, names: pa.Array, ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        document, number, start, length = cut(counts, self.capacity)
        at = (np.cumsum(counts) - counts)[document] + start
        whole = length == self.capacity
        for part in (whole, ~whole):
            which = np.flatnonzero(part)
            if not len(which):
                continue
            edges = np.concatenate([[0], np.cumsum(length[which])])
            own = ids[np.repeat(at[which] - edges[:-1], length[which]) + np.arange(edges[-1])]
            rows = (names.take(pa.array(document[which])), number[which], start[which], length[which], own)
            if part is whole:
                yield self._rows(rows, self.next + np.arange(len(which)), np.zeros(len(which), np.int64), length[which])
                self.next += len(which)
            else:
                self.waiting.append(rows)
                self.pieces += len(which)
                self.ids += len(own)
        if self.pieces >= PORTION or self.ids >= PORTION_IDS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.waiting:
            return
        length = np.concatenate([w[3] for w in self.waiting])
        into, offset, fill = best_fit(length, self.capacity)
        done = 0
        for rows in self.waiting:
            k = slice(done, done + len(rows[3]))
            yield self._rows(rows, self.next + into[k], offset[k], fill[into[k]])
            done += len(rows[3])
        self.next += len(fill)
        self.waiting, self.pieces, self.ids = [], 0, 0

    def _rows(self, rows: tuple, sequence: np.ndarray, offset: np.ndarray, fill: np.ndarray) -> pa.RecordBatch:
        names, number, start, length, ids = rows
        edges = np.concatenate([[0], np.cumsum(length)])
        raw = memoryview(ids.astype("<u4").tobytes())
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))
        columns = [names, pa.array(number, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, sums)), lists, *(pa.array(c, pa.int64()) for c in (sequence, offset, fill))]
        return pa.RecordBatch.from_arrays(columns, [self.name, *(c for c, _ in _PIECE), "fill"])


def _merge(capacity: int, level: int):
    """Best fit over the items of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        into, offset, fill = best_fit(table.column("fill").to_numpy(), capacity)
        number = (level << _ROUND | TaskContext.get().partitionId() << _TASK) + into
        columns = [table.column("item").combine_chunks(), pa.array(number), pa.array(offset), pa.array(fill[into])]
        yield from pa.Table.from_arrays(columns, ["item", "sequence_id", "offset", "fill"]).to_batches(max_chunksize=4096)

    return run


def pack_documents(docs: DataFrame, definition_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``capacity`` ids.

    Columns: the id, ``piece`` (from 0), ``start`` (ids of the document before it), ``length``, ``ids_crc32`` (of the ids as
    little-endian 32-bit numbers), ``token_ids``, ``sequence_id`` and ``offset``; the pieces of a sequence follow each other
    without a gap from 0. A document is the ids of its text (NULL: empty) and ``end_id``. Only documents with more ids than
    the capacity are cut; all their pieces but the first fill a sequence. Every row is a document of its own, repeated rows
    and NULL ids too; other columns are not read. An empty table gives no rows.

    Sequence numbers depend on how the rows lie in partitions; the results of each round are written to the shared folder once.
    """
    spark = docs.sparkSession
    if capacity < 1:
        raise ValueError(f"The capacity has to be positive, not {capacity}.")
    prepare(spark)
    scratch = Scratch(spark, "best-fit")
    with open(definition_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(id_column, capacity)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield from packer.add(batch.column(0).slice(chunk.first, len(chunk)), *_tokenizer(shared.value).encode(chunk, end_id))
        yield from packer.flush()
        trim()

    schema = StructType([StructField(id_column, docs.schema[id_column].dataType), *(StructField(c, DataType.fromDDL(kind)) for c, kind in [*_PIECE, ("fill", "bigint")])])
    pieces = scratch.save(docs.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).mapInArrow(run, schema))
    under = F.col("fill") < capacity - capacity // ROOM
    places = _merge_up(pieces.where(under & (F.col("offset") == 0)).select(F.col("sequence_id").alias("item"), "fill"), capacity, under, scratch)
    columns = [id_column, *(c for c, _ in _PIECE)]
    final = pieces.where(~under).select(*columns)
    moved = pieces.where(under).join(places.select(F.col("item").alias("sequence_id"), F.col("sequence_id").alias("_into"), F.col("offset").alias("_after")), "sequence_id")
    return final.unionByName(moved.withColumns({"sequence_id": F.col("_into"), "offset": F.col("offset") + F.col("_after")}).select(*columns))


def _merge_up(items: DataFrame, capacity: int, under, scratch: Scratch) -> DataFrame:
    """``item``, ``sequence_id``, ``offset`` of every item after all rounds."""
    items = scratch.save(items)
    count, tasks = items.agg(F.count(F.lit(1)), F.countDistinct(F.shiftright("item", _TASK))).first()
    rounds: list[DataFrame] = []
    while True:
        tasks = max(1, -(-count // ITEMS), -(-tasks // FAN))
        placed = scratch.save(items.repartition(tasks).mapInArrow(_merge(capacity, len(rounds) + 1), "item bigint, sequence_id bigint, offset bigint, fill bigint"))
        rounds.append(placed)
        items = placed.where(under & (F.col("offset") == 0)).select(F.col("sequence_id").alias("item"), "fill")
        left = items.count()
        # Tasks that are full and have found nothing more to join would not do so in other company: sizes are whole numbers up to the capacity.
        if tasks == 1 or not left or (tasks == -(-count // ITEMS) and left > 0.98 * count):
            break
        count = left
    places = rounds.pop()
    while rounds:
        last = places.select(F.col("item").alias("sequence_id"), F.col("sequence_id").alias("_into"), F.col("offset").alias("_after"))
        places = rounds.pop().join(last, "sequence_id", "left").select(
            "item", F.coalesce("_into", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("_after", F.lit(0))).alias("offset")
        )
    return places


def sequences(packed: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per sequence: ``sequence_id``, ``token_ids``, and ``parts`` (``offset``, ``length``, id, ``piece``, ``start``) in order; a sequence never exceeds the capacity."""
    part = F.struct("offset", "length", F.col(id_column), "piece", "start", "token_ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.token_ids").alias("token_ids"), F.transform("parts", lambda p: p.dropFields("token_ids")).alias("parts"))
