"""MinHash near-duplicate groups: fast similarity sketches, banding, exact check (Dahlgaard, Knudsen, Thorup, 2017).

A sketch has ``SIZE`` coordinates. In round i < SIZE every shingle is thrown into one hashed bin, in round
SIZE + j all go to bin j; a bin keeps the least value of the first round that reached it. So every coordinate
fills after 2 * SIZE rounds at the latest, in practice after one or two for texts longer than the sketch, and
the share of equal coordinates estimates the Jaccard similarity with the concentration of independent hashing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.components import FILE_LINKS, components
from tallyforge.llm.storage import Scratch, prepare
from tallyforge.llm.text import _ODD, chunks, find_words, mix, signed, span_hashes, tidy, window_hashes

SHINGLE = 5
#: Sketch coordinates, in bands of ROWS: a pair at similarity 0.75 shares no band with probability 2.5e-7.
#: Links that lie in blocks only are also missed by LEAST_EQUAL with probability 1.9e-7, 4.4e-7 in sum.
SIZE, ROWS = 160, 4
#: Equal coordinates that a pair of a block needs before its sets are compared; rows of one side of a block.
LEAST_EQUAL, BLOCK_ROWS = 91, 512
#: Classes (a third of a kilobyte), band keys and bytes of text that one file takes.
FILE_CLASSES, FILE_KEYS, FILE_TEXT = 1 << 16, 1 << 19, 1 << 25
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75

_random = np.random.Generator(np.random.PCG64(7))
_SEEDS = _random.integers(0, 2**64, 2 * SIZE, dtype=np.uint64, endpoint=False)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND_BITS = np.uint64(54)
_LOW = np.uint64((1 << 54) - 1)


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, lower-casing A-Z; a shorter text is one shingle."""
    for chunk in chunks(column):
        words = find_words(chunk)
        hashes = span_hashes(chunk.data, words.starts, words.ends, lower=True)
        windows = window_hashes(hashes, width)
        for start, end in zip(words.bounds[:-1], words.bounds[1:]):
            if end - start >= width:
                yield np.unique(windows[start : end - width + 1])
            elif end > start:
                yield window_hashes(hashes[start:end], int(end - start))
            else:
                yield hashes[:0]


def sketch(items: np.ndarray) -> np.ndarray:
    """The filled sketch of a non-empty set of hashes."""
    out = np.full(SIZE, _EMPTY, dtype=np.uint64)
    at_once = int(np.clip(4096 // len(items), 1, 2 * SIZE))
    for first in range(0, 2 * SIZE, at_once):
        rounds = np.arange(first, min(first + at_once, 2 * SIZE))
        hashed = mix(items[None, :] ^ _SEEDS[rounds][:, None])
        bins = ((hashed >> np.uint64(32)) * np.uint64(SIZE) >> np.uint64(32)).astype(np.int64)
        fixed = rounds >= SIZE
        bins[fixed] = (rounds[fixed] - SIZE)[:, None]
        value = (rounds.astype(np.uint64) << _ROUND_BITS)[:, None] | (mix(hashed) & _LOW)
        np.minimum.at(out, bins.ravel(), value.ravel())
        if not (out == _EMPTY).any():
            break
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One hash per band of a sketch, apart for each band."""
    rows = values.reshape(-1, ROWS)
    total = np.arange(len(rows), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    for k in range(ROWS):
        total += mix(rows[:, k]) * _ODD[k]
    return signed(mix(total))


_SKETCH = "doc_id long, n_bytes long, n_shingles long, set_key binary, bands array<long>"


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands = [], [], []
        for items in shingle_sets(batch.column(1)):
            sizes.append(len(items))
            keys.append(np.array([mix(items ^ _SEEDS[k]).sum() for k in (0, 1)]).tobytes() if len(items) else None)
            bands.append(band_keys(sketch(items)) if len(items) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_bytes", "n_shingles", "set_key", "bands"],
        )


def _check_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for a, b in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3))):
            common = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, linked`` by the full shingle sets."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(tidy(_check_batches), "a long, b long, linked boolean")


def _profile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketch cut to 16 bits a coordinate, full band keys and shingles cut to 32 bits, of each text."""
    for batch in batches:
        short, keys, sets = [], [], []
        for items in shingle_sets(batch.column(1)):
            values = sketch(items)
            short.append(values.astype(np.uint16).tobytes())
            keys.append(band_keys(values).tobytes())
            sets.append(np.unique(items.astype(np.uint32)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(short, pa.binary()), pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["node", "sketch", "keys", "items"])


def _block_pairs(table: pa.Table) -> pa.Table:
    """Pairs of one block of a bucket that lie in unlike components and look similar enough.

    Equal sketch coordinates, 5.3 standard deviations below what similarity 0.75 gives, go before the sets. A pair
    that meets in several buckets is looked at in that of its first common band only, by the full keys that name buckets.
    """
    nodes, parts, sides = (table.column(c).to_numpy() for c in ("rep", "component", "side"))
    band = table.column("band")[0].as_py()
    sketches = np.stack([np.frombuffer(x.as_py(), np.uint16) for x in table.column("sketch")])
    keys = np.stack([np.frombuffer(x.as_py(), np.int64) for x in table.column("keys")])
    sets = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("items")]
    left = np.flatnonzero(sides != 1)
    right = np.flatnonzero(sides != 0)
    found: list[tuple[int, int]] = []
    for first in range(0, len(left), 16):
        rows = left[first : first + 16]
        open_ = parts[rows][:, None] != parts[right][None, :]
        if sides[0] == 2:
            open_ &= rows[:, None] < right[None, :]
        equal = sketches[rows][:, None, :] == sketches[right][None, :, :]
        open_ &= equal.sum(axis=2) >= LEAST_EQUAL
        for i, j in zip(*np.nonzero(open_)):
            if int(np.argmax(keys[rows[i]] == keys[right[j]])) != band:
                continue
            x, y = sets[rows[i]], sets[right[j]]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= (PERCENT - 1) * (len(x) + len(y) - common):
                found.append((int(nodes[rows[i]]), int(nodes[right[j]])))
    return pa.table({"a": pa.array([min(f) for f in found], pa.int64()), "b": pa.array([max(f) for f in found], pa.int64())})


def _rest_pairs(members: DataFrame, n_members: int, labels: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Candidate links that the pivots left open: members of a bucket in unlike components, compared block by block."""
    named = members.join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "band", "rep", "pivot", F.coalesce("component", "rep").alias("component"))
    homes = named.where("rep = pivot").select("bucket", F.col("component").alias("home"))
    others = named.where("rep != pivot").join(homes, "bucket").withColumn("is_home", F.col("component") == F.col("home"))
    counts = others.groupBy("bucket").agg(
        F.count_if("is_home").alias("n_home"), F.count_if(~F.col("is_home")).alias("n_rest"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    open_ = counts.where("low < high").select("bucket", blocks("n_home").alias("homes"), blocks("n_rest").alias("rests"))
    live = others.join(open_, "bucket").select("bucket", "band", "rep", "component", "is_home", "homes", "rests")
    live = scratch.save(live, scratch.files(n_members, FILE_LINKS))
    profiled = texts.join(live.select("rep").distinct(), F.col("doc_id") == F.col("rep"), "left_semi").select("doc_id", "text")
    profiles = profiled.mapInArrow(tidy(_profile_batches), "node long, sketch binary, keys binary, items binary")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("is_home"), F.col("homes")).otherwise(F.col("rests"))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    cell = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    mine = F.col("own")
    within = lambda k: cell("rest", F.least(mine, k), F.greatest(mine, k), F.when(mine == k, 2).when(mine < k, 0).otherwise(1))
    of_home = F.transform(upto("rests"), lambda k: cell("home", mine, k, F.lit(0)))
    of_rest = F.concat(F.transform(upto("homes"), lambda k: cell("home", k, mine, F.lit(1))), F.transform(upto("rests"), within))
    placed = live.withColumn("own", own).withColumn("cell", F.explode(F.when(F.col("is_home"), of_home).otherwise(of_rest)))
    placed = placed.select("bucket", "band", "rep", "component", "cell.*").join(profiles, F.col("rep") == F.col("node"))
    return placed.groupBy("bucket", "kind", "i", "j").applyInArrow(_block_pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Two texts are linked when the Jaccard similarity of their 5-word shingle sets is 0.75 or more;
    ``component_id`` is the least id reachable over links. A text that is NULL or has no word has an
    empty set and is linked with nothing, as is a row without an id (its component is NULL, it is
    kept). Rows that repeat an id each give a row and share a component; if their texts differ, the least
    text stands for the id in checks. Other columns of ``docs`` are not read.

    Texts with equal sets form one class, and only the class's least id takes part in what follows. Ids
    are grouped by band; in each bucket the least id is compared with all members. A bucket whose members
    then lie in one component is done, since no further pair in it can change a component. In the others
    all members of unlike components are compared, in blocks of bounded size that give out links only.
    Nothing is capped, and every link is confirmed on the full shingle sets of both texts. Tables between
    steps whose rows have a known bound are written in as many files as that bound fills.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "near-dedup")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sketched = scratch.save(rows.mapInArrow(tidy(_sketch_batches), _SKETCH))
    n_rows, n_bytes = sketched.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    classes = sketched.where("doc_id is not null and n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = scratch.save(classes, scratch.files(n_rows, FILE_CLASSES))
    banded = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot")).where("n > 1").select("bucket", "pivot")
    members = scratch.save(banded.join(shared, "bucket"), scratch.files(classes.count() * SIZE // ROWS, FILE_KEYS))
    n_members = members.count()
    needed = members.select("rep").distinct()
    texts = rows.join(needed, rows.doc_id == needed.rep, "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = scratch.save(texts, scratch.files(n_bytes, FILE_TEXT))

    stars = members.where("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    labels = components(_verified(stars, texts).where("linked"), scratch, n_members)
    more = _verified(_rest_pairs(members, n_members, labels, texts, scratch), texts).where("linked").select("a", "b")
    # Labels are links to the least id of their component, so that only components which ``more`` joins take further rounds.
    labels = components(labels.toDF("a", "b").unionByName(more), scratch)
    named = classes.select("set_key", "rep").join(labels, F.col("rep") == F.col("node"), "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    return (
        sketched.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .coalesce(scratch.files(n_rows, FILE_LINKS))
    )
