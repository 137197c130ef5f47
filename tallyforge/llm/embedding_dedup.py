"""Near-duplicate vectors by randomised-rotation binary codes with correction factors (RaBitQ, Gao and Long, 2024).

A unit vector is rotated at random and stored as the signs of its coordinates, with its inner product f with that
code's own unit vector. For another unit vector q, <code, q> / f estimates <x, q> without bias, and the error stays below
EPSILON * sqrt((1 - f^2) / f^2 / (d - 1)) with probability 1 - 2 exp(-EPSILON^2 / 2) or so. Runs of bits of the codes are
also the buckets of the index: vectors at cosine 0.98 differ in one bit of sixteen, so two of them meet in some bucket.
In a bucket the estimates decide which pairs are computed exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.components import components
from tallyforge.llm.storage import Scratch, prepare
from tallyforge.llm.text import mix, signed

COSINE, EPSILON, SEED = 0.98, 4.0, 98
#: Bits of a bucket beyond the logarithm of the largest label's size, and chance that a pair at the threshold meets in no bucket.
MORE_BITS, MISS = 4, 1e-6
#: Rows of one side of a block within a bucket.
BLOCK_ROWS = 512


def rotation(width: int, number: int) -> np.ndarray:
    """Random orthogonal matrix, the same for every worker."""
    square = np.random.Generator(np.random.PCG64([SEED, width, number])).standard_normal((width, width))
    q, r = np.linalg.qr(square)
    return q * np.sign(np.diag(r))


def unit_rows(column: pa.Array) -> tuple[np.ndarray | None, np.ndarray]:
    """Unit vectors in double precision of the usable rows, and which rows these are.

    Not usable are NULL, zero and empty vectors and those with a NULL or non-finite component. All usable rows of a
    batch must have one length; rows of another length than the first are an error.
    """
    rows, usable = [], np.zeros(len(column), dtype=bool)
    for i, cell in enumerate(column):
        values = cell.values
        if values is None or not len(values) or values.null_count:
            continue
        row = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(row).all():
            row = row / np.abs(row).max() if np.abs(row).max() else row
            norm = np.sqrt(row @ row)
            if norm:
                rows.append(row / norm)
                usable[i] = True
    return (np.array(rows) if rows else None), usable


def table_count(bits: int, cosine: float = COSINE) -> int:
    """Buckets per vector so that a pair at ``cosine`` shares none with chance MISS at most."""
    agree = (1 - np.arccos(cosine) / np.pi) ** bits
    return int(np.ceil(np.log(MISS) / np.log(1 - agree)))


def _code_batches(bits: int, tables: int):
    """Codes of the classes: buckets, and per vector the code of the first rotation with its factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turned: list[np.ndarray] = []
        for batch in batches:
            units, _ = unit_rows(batch.column(2))
            labels = np.array([hash_label(x) for x in batch.column(1).to_pylist()], dtype=np.uint64)
            width = units.shape[1]
            while len(turned) * width < max(bits * tables, width):
                turned.append(rotation(width, len(turned)))
            signs = np.concatenate([units @ r.T for r in turned], axis=1) >= 0
            buckets = np.empty((len(units), tables), dtype=np.int64)
            weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
            for t in range(tables):
                value = signs[:, t * bits : (t + 1) * bits] @ weights
                buckets[:, t] = signed(mix(mix(value + np.uint64(t << 40)) ^ labels))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(buckets), pa.list_(pa.int64()))], ["node", "buckets"])

    return run


def hash_label(label) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(str(label).encode(), digest_size=8).digest(), "little")


def estimates(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all rows with all rows, and the bound on the error of each."""
    width = units.shape[1]
    turned = units @ rotation(width, 0).T
    codes = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(width)
    factor = np.maximum((codes * turned).sum(axis=1), 1e-9)
    bound = EPSILON * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2 / max(1, width - 1))
    return (codes @ turned.T) / factor[:, None], bound


def _block_links(cosine: float):
    """What the links of one block of a bucket join. A pair that meets in several buckets is looked at in the first one only."""

    def run(table: pa.Table) -> pa.Table:
        nodes, sides = table.column("node").to_numpy(), table.column("side").to_numpy()
        number = table.column("number")[0].as_py()
        units, _ = unit_rows(table.column("vector").combine_chunks())
        buckets = np.array(table.column("buckets").to_pylist(), dtype=np.int64)
        left, right = np.flatnonzero(sides != 1), np.flatnonzero(sides != 0)
        guess, bound = estimates(units)
        close = guess[np.ix_(left, right)] + bound[left][:, None] >= cosine
        if sides[0] == 2:
            close &= left[:, None] < right[None, :]
        i, j = np.nonzero(close)
        i, j = left[i], right[j]
        first = np.argmax(buckets[i] == buckets[j], axis=1) == number
        i, j = i[first], j[first]
        exact = np.einsum("ij,ij->i", units[i], units[j])
        i, j = i[exact >= cosine], j[exact >= cosine]
        # Each linked node once, with the copies that it is linked to here and the least node it is joined with here.
        copies = table.column("copies").to_numpy()
        others = np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
        low = nodes.copy()
        while True:
            before = low.copy()
            np.minimum.at(low, i, before[j])
            np.minimum.at(low, j, before[i])
            if (low == before).all():
                break
        linked = np.flatnonzero(others)
        return pa.table({"node": nodes[linked], "low": low[linked], "others": others[linked].astype(np.int64)})

    return run


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Vectors of one label are linked at a cosine of ``cosine`` or more, computed in double precision; rows without label,
    without id or with an unusable vector (see ``unit_rows``) link with nothing. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the least id reachable. Rows that repeat an id count one by one. Other columns are not read.

    Rows with equal label and vector form one class of counted copies. Classes that share a bucket are compared in
    blocks of bounded size; a block gives out a row per linked class, never pairs. Buckets have as many bits as the largest label needs for
    a bounded number of unlike vectors in each, and their number follows from MISS.
    """
    spark = vectors.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "embedding-dedup")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    number = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.exists("vector", lambda x: x != 0) & ~F.exists("vector", number), F.lit(False))
    keyed = scratch.save(rows.withColumn("key", F.when(usable, F.sha2(F.to_json(F.struct("label", "vector")), 256))))
    classes = scratch.save(
        keyed.where("key is not null").groupBy("key").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = int(np.ceil(np.log2(largest + 1))) + MORE_BITS
    tables = table_count(bits, cosine)
    codes = scratch.save(classes.select("node", "label", "vector").mapInArrow(_code_batches(bits, tables), "node long, buckets array<long>"))
    placed = codes.select("node", F.posexplode("buckets").alias("number", "bucket"))
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    shared = placed.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cell = lambda k: F.struct(
        F.least(F.col("own"), k).alias("i"), F.greatest(F.col("own"), k).alias("j"), F.when(F.col("own") == k, 2).when(F.col("own") < k, 0).otherwise(1).alias("side")
    )
    blocks = shared.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), cell))).select("bucket", "number", "node", "cell.*")
    full = blocks.join(classes.select("node", "copies", "vector"), "node").join(codes, "node")
    joined = scratch.save(full.groupBy("bucket", "i", "j").applyInArrow(_block_links(cosine), "node long, low long, others long"))
    labels = components(joined.select(F.col("node").alias("a"), F.col("low").alias("b")), scratch)
    direct = joined.groupBy(F.col("node").alias("a")).agg(F.sum("others").alias("others"))
    named = (
        classes.select("key", F.col("node").alias("rep"), "copies").join(labels, F.col("rep") == F.col("node"), "left").join(direct, F.col("rep") == F.col("a"), "left")
        .select("key", F.coalesce("component", "rep").alias("component"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    out = keyed.select("id", "key").join(named, "key", "left").select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
