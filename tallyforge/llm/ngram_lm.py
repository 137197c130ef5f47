"""Bigram scores from a log-frequency Bloom filter (Talbot and Osborne, 2007).

The count of each bigram is quantised to a level on a logarithmic scale and entered once per level up to its own; a
reader probes level after level until one is missing. The filter has one slice per hash bucket, with ``bits_per_entry`` at any
size of the corpus; the bigrams of training texts meet in their bucket and fill its slice. ``fit`` writes slices, exact word
counts and a few totals to a folder, and ``score`` reads any texts against them: a filter of at most ``broadcast_bytes`` is
broadcast and probed where the texts are, of a larger one each slice answers in its bucket, so that no process holds more than
one. ``score_texts`` scores the corpus that it learns from: the bigrams are in their buckets already, so each slice answers
there once it is full, at any size. All ways read the same bits. With 10 bits and 5 probes an entry, 0.94 % of absent
entries read as present. A count read is never taken for more than the exact counts of its two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import packing
from tallyforge.llm.packing import packed, rows_of, slices, unpacked
from tallyforge.llm.storage import Scratch, prepare
from tallyforge.llm.text import Chunk, chunks, find_words, mix, span_hashes

#: Base of the count levels, hash functions of an entry, and bits of the filter per entry.
BASE, PROBES, BITS_PER_ENTRY = 1.5, 5, 10
#: Largest filter that is broadcast.
BROADCAST_BYTES = 64 << 20
_LEVELS = 64
_END = np.uint64(0x5851F42D4C957F2D)
_FLOORS = np.array([BASE**q for q in range(_LEVELS)])
_MEANS = np.array([0.0] + [max(1.0, (np.ceil(a) + np.ceil(b) - 1) / 2) for a, b in zip(_FLOORS, BASE * _FLOORS)])


def level(counts: np.ndarray) -> np.ndarray:
    """Level of each count, from 1; 0 for a count of 0."""
    return np.searchsorted(_FLOORS, counts, "right")


class _Tokens:
    """Token hashes of a chunk: the words of each document, A-Z lower-cased, and an end."""

    def __init__(self, payload: bytes):
        self.table = rows_of(payload)
        whole = list(chunks(self.table.column(1), 1 << 62))
        chunk = whole[0] if whole else Chunk(0, 0, np.zeros(0, np.uint8), np.zeros(1, np.int64))
        words = find_words(chunk)
        self.hashes = np.insert(span_hashes(chunk.data, words.starts, words.ends, lower=True), words.bounds[1:], _END)
        self.sizes = np.diff(words.bounds) + 1
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        held_out = pc.fill_null(self.table.column(2), False).to_numpy().astype(bool)
        self.held_out = held_out
        self.training = ~held_out[self.owner]
        self.values, self.which = np.unique(self.hashes, return_inverse=True)

    def bigrams(self) -> np.ndarray:
        """Hash of each token with the one before; the first of a text follows an end."""
        before = np.concatenate([[_END], self.hashes[:-1]])
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + self.hashes)

    def contexts(self) -> np.ndarray:
        """For each token the index of the one before among ``values``."""
        end = int(np.searchsorted(self.values, _END))
        return np.concatenate([[end], self.which[:-1]])


_MESSAGE = "bucket long, chunk long, hashes binary, counts binary, kinds binary"
_COUNTED = "bucket long, chunk long, counts binary, tokens long, types long, level_tokens array<long>, words binary, word_counts binary"
_WORDS = "bucket long, words binary, word_counts binary"
_GRADED = "bucket long, chunk long, answers binary, size long, flags binary, level_types array<long>"
_SLICES = "bucket long, size long, flags binary"
_TOTALS = "tokens long, types long, bits int, backoff array<double>"
_ANSWERS = "bucket long, chunk long, answers binary"


def _word_messages(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _Tokens(payload.as_py())
                counts = np.bincount(part.which[part.training], minlength=len(part.values))
                yield _messages(part.values, counts, None, bits, chunk)

    return run


def _messages(values: np.ndarray, counts: np.ndarray | None, kinds: np.ndarray | None, bits: int, chunk: int) -> pa.RecordBatch:
    runs = list(slices(values, bits))
    return pa.RecordBatch.from_pydict({
        "bucket": pa.array([r[0] for r in runs], pa.int64()), "chunk": pa.array([chunk] * len(runs), pa.int64()),
        "hashes": pa.array([packed(values[a:b]) for _, a, b in runs], pa.binary()), "counts": pa.array([None if counts is None else packed(counts[a:b]) for _, a, b in runs], pa.binary()),
        "kinds": pa.array([None if kinds is None else kinds[a:b].astype(np.uint8).tobytes() for _, a, b in runs], pa.binary()),
    })


def _sum_words(table: pa.Table) -> pa.Table:
    """Of one bucket: total counts for the words of each chunk; the first row also carries the bucket's sums and words."""
    blobs = [unpacked(x.as_py()) for x in table.column("hashes")]
    counts = np.concatenate([unpacked(x.as_py()).astype(np.int64) for x in table.column("counts")])
    values, which = np.unique(np.concatenate(blobs), return_inverse=True)
    totals = np.bincount(which, weights=counts, minlength=len(values)).astype(np.int64)
    by_level = np.bincount(level(totals), weights=totals, minlength=_LEVELS + 1).astype(np.int64)
    found, done, out = totals[which], 0, []
    for blob in blobs:
        out.append(packed(found[done : done + len(blob)]))
        done += len(blob)
    seen = totals > 0
    once = {
        "tokens": (int(totals.sum()), pa.int64()), "types": (int(seen.sum()), pa.int64()), "level_tokens": (by_level.tolist(), pa.list_(pa.int64())),
        "words": (packed(values[seen]), pa.binary()), "word_counts": (packed(totals[seen]), pa.binary()),
    }
    result = table.select(["bucket", "chunk"]).append_column("counts", pa.array(out, pa.binary()))
    for name, (value, kind) in once.items():
        result = result.append_column(name, pa.array([value] + [None] * (len(out) - 1), kind))
    return result


def _word_counts(buckets: list[int], answers: list[bytes]) -> np.ndarray:
    """Counts of a chunk's distinct words, in the order of their hashes."""
    order = np.argsort(buckets)
    return np.concatenate([unpacked(answers[i]).astype(np.int64) for i in order])


def _bigram_messages(bits: int, grade: bool):
    """Distinct bigrams, of training texts alone if none are graded, with their counts in training texts and the level of their first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload, buckets, answers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                part = _Tokens(payload)
                sent = np.ones(len(part.hashes), bool) if grade else part.training
                levels = level(_word_counts(buckets, answers))[part.contexts()][sent]
                values, first, which = np.unique(part.bigrams()[sent], return_index=True, return_inverse=True)
                counts = np.bincount(which[part.training[sent]], minlength=len(values))
                yield _messages(values, counts, levels[first], bits, chunk)

    return run


def _questions(bits: int, of):
    """Distinct hashes of each chunk, by bucket; ``of`` takes them from its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _messages(of(_Tokens(payload.as_py())), None, None, bits, chunk)

    return run


def _positions(hashes: np.ndarray, q: int, size) -> np.ndarray:
    """Bit of each probe at level ``q``, row per hash; ``size`` is one number or one per hash."""
    seed = mix(hashes + np.uint64(q * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF))
    step = mix(seed ^ np.uint64(0x94D049BB133111EB)) | np.uint64(1)
    return ((seed[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.asarray(size, np.uint64).reshape(-1, 1)).astype(np.int64)


def filled(values: np.ndarray, levels: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> np.ndarray:
    """A slice of the filter: bits that hold each value at all levels from 1 to its own."""
    flags = np.zeros(max(64, int(levels.sum()) * bits_per_entry), dtype=bool)
    for q in range(1, int(levels.max(initial=0)) + 1):
        flags[_positions(values[levels >= q], q, len(flags)).ravel()] = True
    return flags


def _climb(values: np.ndarray, holds) -> np.ndarray:
    """Level that each value reaches while ``holds(places, level)`` says that all its probes hit."""
    out, left = np.zeros(len(values), dtype=np.int64), np.arange(len(values))
    for q in range(1, _LEVELS):
        left = left[holds(left, q)]
        if not len(left):
            break
        out[left] = q
    return out


def reached(flags: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Level that each value reaches in one slice by repeated probes."""
    return _climb(values, lambda left, q: flags[_positions(values[left], q, len(flags))].all(axis=1))


class Filter:
    """All slices in one array of bytes; a bucket without a slice is empty."""

    def __init__(self, bits: int, buckets: np.ndarray, sizes: np.ndarray, flags: list[bytes]):
        self.bits, self.size, self.start = bits, np.full(1 << bits, 64, np.int64), np.zeros(1 << bits, np.int64)
        self.size[buckets] = sizes
        self.start[buckets] = 8 * np.cumsum([8, *map(len, flags)])[:-1] if len(flags) else 0
        self.data = np.frombuffer(b"".join([bytes(8), *flags]), np.uint8)

    def reached(self, values: np.ndarray) -> np.ndarray:
        bucket = (values >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(values), np.int64)
        size, start = self.size[bucket], self.start[bucket]

        def holds(left: np.ndarray, q: int) -> np.ndarray:
            at = start[left][:, None] + _positions(values[left], q, size[left])
            return (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)

        return _climb(values, holds)


def _compressed(grades: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(grades.astype(np.uint8).tobytes())


def _fill_slice(bits_per_entry: int, keep: bool, grade: bool):
    """Of one bucket: levels read from its slice for the bigrams of each chunk; the first row carries the slice and how many distinct training bigrams follow words of each level."""

    def run(table: pa.Table) -> pa.Table:
        blobs = [unpacked(x.as_py()) for x in table.column("hashes")]
        counts = np.concatenate([unpacked(x.as_py()).astype(np.int64) for x in table.column("counts")])
        kinds = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("kinds")])
        values, first, which = np.unique(np.concatenate(blobs), return_index=True, return_inverse=True)
        totals = np.bincount(which, weights=counts, minlength=len(values)).astype(np.int64)
        seen = totals > 0
        flags = filled(values[seen], level(totals[seen]), bits_per_entry)
        out = [None]
        if grade:
            grades, edges = reached(flags, values)[which], np.cumsum([0, *map(len, blobs)])
            out = [_compressed(grades[a:b]) for a, b in zip(edges, edges[1:])]
        rest = [None] * (len(out) - 1)
        types = np.bincount(kinds[first[seen]], minlength=_LEVELS + 1).tolist()
        return pa.table({
            "bucket": table.column("bucket")[: len(out)], "chunk": table.column("chunk")[: len(out)], "answers": pa.array(out, pa.binary()),
            "size": pa.array([len(flags) if keep else None, *rest], pa.int64()), "flags": pa.array([np.packbits(flags).tobytes() if keep else None, *rest], pa.binary()),
            "level_types": pa.array([types, *rest], pa.list_(pa.int64())),
        })

    return run


def _answered(asked: pa.Table, answer, pack_answer) -> pa.Table:
    """Answers to the hashes of each chunk; all chunks of a bucket are asked at once."""
    blobs = [unpacked(x.as_py()) for x in asked.column("hashes")]
    values, which = np.unique(np.concatenate(blobs or [np.zeros(0, np.uint64)]), return_inverse=True)
    found, done, out = answer(values)[which], 0, []
    for blob in blobs:
        out.append(pack_answer(found[done : done + len(blob)]))
        done += len(blob)
    return asked.select(["bucket", "chunk"]).append_column("answers", pa.array(out, pa.binary()))


def _count_words(asked: pa.Table, known: pa.Table) -> pa.Table:
    words, counts = (unpacked(known.column(name)[0].as_py()) if len(known) else np.zeros(0, np.uint64) for name in ("words", "word_counts"))

    def answer(values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(words, values)
        inside = at < len(words)
        out = np.zeros(len(values), np.int64)
        out[inside] = np.where(words[at[inside]] == values[inside], counts[at[inside]].astype(np.int64), 0)
        return out

    return _answered(asked, answer, packed)


def _grade(asked: pa.Table, known: pa.Table) -> pa.Table:
    size = known.column("size")[0].as_py() if len(known) else 64
    flags = np.unpackbits(np.frombuffer(known.column("flags")[0].as_py(), np.uint8), count=size).astype(bool) if len(known) else np.zeros(size, bool)
    return _answered(asked, lambda values: reached(flags, values), _compressed)


def _grades(buckets: list[int], answers: list[bytes]) -> np.ndarray:
    """Levels of a chunk's distinct bigrams, in the order of their hashes."""
    order = np.argsort(buckets)
    return np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(answers[i]) for i in order), np.uint8)


def _ask(parts: DataFrame, of, table: DataFrame, answer, bits: int, n_words: int) -> DataFrame:
    """``chunk, buckets, answers``: what ``table``, a row per bucket, says of the hashes of each chunk.

    Texts of more words than the buckets are made for are asked in portions of chunks, each with its own copy of the row.
    """
    portions = max(1, -(-n_words // (2 * packing.BUCKET_ENTRIES << bits)))
    asked = parts.mapInArrow(_questions(bits, of), _MESSAGE).select("bucket", "chunk", "hashes", F.expr(f"pmod(chunk, {portions})").alias("portion"))
    known = table.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(portions - 1).cast("long"))))
    answers = asked.groupBy("bucket", "portion").cogroup(known.groupBy("bucket", "portion")).applyInArrow(answer, _ANSWERS)
    return answers.groupBy("chunk").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("answers").alias("answers"))


@dataclass
class Model:
    """Token and type totals, the weight of words alone by level of the context, word counts and filter slices by bucket."""

    tokens: int
    types: int
    backoff: np.ndarray
    bits: int
    words: DataFrame
    slices: DataFrame

    def broadcast(self, limit: int) -> Broadcast | None:
        """The filter on all workers, if it has at most ``limit`` bytes. The sizes are summed before a slice is read."""
        if (self.slices.agg(F.sum(F.expr("size + 7 >> 3"))).first()[0] or 0) > limit:
            return None
        rows = self.slices.select("bucket", "size", "flags").toArrow()
        whole = Filter(self.bits, rows.column("bucket").to_numpy(), rows.column("size").to_numpy(), rows.column("flags").to_pylist())
        return self.slices.sparkSession.sparkContext.broadcast(whole)


def _score_batches(tokens: int, types: int, backoff: np.ndarray, shared: Broadcast | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, payload, buckets, answers, *graded in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                part = _Tokens(payload)
                counts = _word_counts(buckets, answers)
                own, before = counts[part.which], counts[part.contexts()]
                alone = (own + 0.5) / (tokens + 0.5 * (types + 1))
                values, which = np.unique(part.bigrams(), return_inverse=True)
                grades = shared.value.reached(values) if shared else _grades(*graded)
                pairs = np.minimum(_MEANS[grades][which], np.minimum(own, before))
                weight = backoff[level(before)]
                joint = (1 - weight) * pairs / np.maximum(before, 1) + weight * alone
                sums = lambda x: np.bincount(part.owner, weights=x, minlength=len(part.sizes))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        part.table.column(0).combine_chunks(), pa.array(part.held_out), pa.array(part.sizes, pa.int64()), pa.array(sums(own > 0).astype(np.int64)),
                        pa.array(np.full(len(part.sizes), tokens), pa.int64()), pa.array(sums(np.log10(alone))), pa.array(sums(np.log10(joint))),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_told(told: DataFrame, answers: DataFrame, tokens: int, types: int, backoff: np.ndarray) -> DataFrame:
    """Scores of chunks that know the counts of their words, by ``chunk, places, grades`` of their bigrams."""
    both = told.join(answers.toDF("chunk", "places", "grades"), "chunk").select("chunk", "payload", "buckets", "answers", "places", "grades")
    return both.mapInArrow(_score_batches(tokens, types, backoff, None), _SCORES)


def _rows(docs: DataFrame, held_out: Column, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))


def _learn(scratch: Scratch, whole: DataFrame, folder: str | None, bits_per_entry: int, grade: bool) -> tuple:
    """Chunks with the counts of their words, levels of their bigrams if asked for, totals; the model goes to ``folder`` if there is one."""
    spark, bits = scratch.spark, packing.bucket_bits(whole)
    counted = scratch.save(whole.select("chunk", "payload").mapInArrow(_word_messages(bits), _MESSAGE).groupBy("bucket").applyInArrow(_sum_words, _COUNTED))
    totals = counted.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    by_level = {r["pos"]: r["n"] for r in counted.select(F.posexplode("level_tokens")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
    if folder is not None:
        counted.where("tokens is not null").select("bucket", "words", "word_counts").write.parquet(f"{folder}/words")
    answers = counted.groupBy("chunk").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("counts").alias("answers"))
    # Both passes below read the chunks with their counts; the tables that these come from can go.
    told = scratch.save(whole.select("chunk", "payload").join(answers, "chunk").select("chunk", "payload", "buckets", "answers"))
    scratch.drop(whole)
    scratch.drop(counted)
    messages = told.mapInArrow(_bigram_messages(bits, grade), _MESSAGE)
    graded = scratch.save(messages.groupBy("bucket").applyInArrow(_fill_slice(bits_per_entry, folder is not None, grade), _GRADED))
    types = {r["pos"]: r["n"] for r in graded.select(F.posexplode("level_types")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
    tokens, types = (np.array([x.get(q, 0) for q in range(_LEVELS + 1)], dtype=np.float64) for x in (by_level, types))
    backoff = np.where(tokens > 0, types / np.maximum(tokens + types, 1), 1.0)
    backoff[0] = 1.0
    backoff = np.clip(backoff, 1e-6, 1.0)
    if folder is not None:
        graded.where("size is not null").select("bucket", "size", "flags").write.parquet(f"{folder}/filter")
        spark.createDataFrame([(totals["tokens"] or 0, totals["types"] or 0, bits, backoff.tolist())], _TOTALS).coalesce(1).write.parquet(f"{folder}/totals")
    return told, graded, (totals["tokens"] or 0, totals["types"] or 0, backoff)


def fit(docs: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", bits_per_entry: int = BITS_PER_ENTRY) -> Model:
    """Learn from all rows and write the model to ``folder``, which must be new and shared by all executors.

    It holds ``words`` (exact counts by hash bucket), ``filter`` (a slice per bucket) and ``totals``. NULL texts count as empty;
    other columns are not read. An empty table gives a model without words.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "ngram-fit")
    whole = scratch.save(packing.pack(_rows(docs, F.lit(False), id_column, text_column), packing.CHUNK_TEXT // 2))
    told, graded, _ = _learn(scratch, whole, folder, bits_per_entry, grade=False)
    scratch.drop(told)
    scratch.drop(graded)
    return load(spark, folder)


def load(spark: SparkSession, folder: str) -> Model:
    """The model that ``fit`` wrote to ``folder``."""
    row = spark.read.schema(_TOTALS).parquet(f"{folder}/totals").first()
    words, filter_rows = (spark.read.schema(schema).parquet(f"{folder}/{name}") for name, schema in (("words", _WORDS), ("filter", _SLICES)))
    return Model(row["tokens"], row["types"], np.array(row["backoff"]), row["bits"], words, filter_rows)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Scores of texts that the model need not have seen, with the columns and rules of ``score_texts``; ``held_out`` is true."""
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "ngram-score")
    whole = scratch.save(packing.pack(_rows(docs, F.lit(True), id_column, text_column), packing.CHUNK_TEXT // 2))
    n_words = whole.agg(F.sum("n_words")).first()[0] or 0
    parts = whole.select("chunk", "payload")
    told = scratch.save(parts.join(_ask(parts, lambda part: part.values, model.words, _count_words, model.bits, n_words), "chunk"))
    scratch.drop(whole)
    shared = model.broadcast(broadcast_bytes)
    if shared is not None:
        return told.mapInArrow(_score_batches(model.tokens, model.types, model.backoff, shared), _SCORES)
    grades = _ask(told.select("chunk", "payload"), lambda part: np.unique(part.bigrams()), model.slices, _grade, model.bits, n_words)
    return _score_told(told, grades, model.tokens, model.types, model.backoff)


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", folder: str | None = None, bits_per_entry: int = BITS_PER_ENTRY
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row; learns from rows that are not held out.

    Tokens are the words with A-Z lower-cased and one end per text; NULL counts as empty. ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) with exact counts. ``score`` mixes the relative frequency of the bigram with that word
    probability; its weight by the level of the first word's count is d / (c + d) (Witten and Bell), from the exact numbers of
    tokens c and of distinct bigrams d after words of this level. Without training rows both scores use N = V = 0.
    A NULL ``held_out`` counts as false. Other columns are not read. The scores are those of ``fit`` on the training rows and
    ``score`` of all rows; with ``folder`` the model is also written there.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "ngram-lm")
    whole = scratch.save(packing.pack(_rows(docs, held_out, id_column, text_column), packing.CHUNK_TEXT // 2))
    told, graded, totals = _learn(scratch, whole, folder, bits_per_entry, grade=True)
    return _score_told(told, graded.groupBy("chunk").agg(F.collect_list("bucket"), F.collect_list("answers")), *totals)
