"""Language identification: nearest of several centroids per language, by cosine of hashed TF-IDF n-gram vectors.

Vectors count byte n-grams (2 and 3 bytes) of the text with A-Z lower-cased and every run of ASCII bytes that are no
letters made one blank. The centroids come from spherical k-means within each language. A text whose cosine to the nearest
centroid falls short of what texts of its length need is rejected. That bound is fitted: the labelled sample's texts and their
prefixes give, by length, the cosines of a text to its nearest centroid and to the nearest of another language, and the bound
lies halfway between the low ones of the first and the high ones of the second, or at MOST times the former. A language
that was not learned is about as far as another language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import Scratch, extended, prepare
from tallyforge.llm.text import _LOWER, Chunk, chunks, tidy

#: Hashed dimensions, centroids per language, and the bound on the labelled rows per language that they are fitted on.
DIMENSIONS, CENTROIDS, SAMPLE = 4096, 4, 1200
#: Cosine distance to the nearest centroid beyond which a text of any length is rejected. Even one-word texts of a learned language stay below it.
MAX_DISTANCE = 0.95
#: Bands of length (powers of two of n-grams), quantiles of the nearest cosines and of those to other languages, part of the
#: first that the bound may be at most, and texts that a band needs.
BANDS, NEAR_SHARE, OTHER_SHARE, MOST, BAND_TEXTS = 40, 0.01, 0.95, 0.8, 30
UNKNOWN = "und"
_TEXTS_AT_ONCE = 128

_FOLD = _LOWER.copy()
_FOLD[[b for b in range(128) if not (97 <= b <= 122 or 65 <= b <= 90)]] = 0x20
_GRAM = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def gram_counts(chunk: Chunk) -> np.ndarray:
    """Row per text: how often each hashed n-gram occurs in it. N-grams do not cross texts."""
    data, offsets = _FOLD[chunk.data], chunk.offsets
    blank = data == 0x20
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    first = offsets[:-1][offsets[:-1] < len(data)]
    keep[first] = True
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    data = data[keep].astype(np.uint32)
    owner = np.repeat(np.arange(len(chunk)), np.diff(offsets))
    total = np.zeros(len(chunk) * DIMENSIONS, dtype=np.int64)
    for width in (2, 3):
        count = max(0, len(data) - width + 1)
        code = np.full(count, width * 0x2545F491 & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(width):
            code = (code ^ data[k : k + count]) * _GRAM[k]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x27D4EB2F)
        cell = owner[:count] * DIMENSIONS + (code >> np.uint32(20)).astype(np.int64)
        total += np.bincount(cell[owner[:count] == owner[width - 1 :]], minlength=len(total))
    return total.reshape(len(chunk), DIMENSIONS)


def weighed(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of logarithmic counts times ``idf``; a row without n-grams stays zero."""
    out = np.log1p(counts).astype(np.float32) * idf
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def _portions(column: pa.Array) -> Iterator[Chunk]:
    """Chunks of few enough texts for dense rows."""
    for chunk in chunks(column):
        for a in range(0, len(chunk), _TEXTS_AT_ONCE):
            b = min(a + _TEXTS_AT_ONCE, len(chunk))
            lo, hi = chunk.offsets[a], chunk.offsets[b]
            yield Chunk(chunk.first + a, chunk.first + b, chunk.data[lo:hi], chunk.offsets[a : b + 1] - lo)


@dataclass
class Model:
    """``centroids[i]`` belongs to ``languages[i]``; a text of band ``b`` needs a cosine of ``floors[b]``."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray


def bands(counts: np.ndarray) -> np.ndarray:
    """Band of length of each row of n-gram counts."""
    return np.minimum(np.log2(1 + counts.sum(axis=1)).astype(np.int64), BANDS - 1)


def _prefixes(chunk: Chunk) -> Iterator[tuple[np.ndarray, Chunk]]:
    """Which texts, and these cut to 4, 8, 16, ... bytes where they are longer; in the end all in full."""
    sizes, size = np.diff(chunk.offsets), 4
    while (some := np.flatnonzero(sizes > size)).size:
        at = (chunk.offsets[some, None] + np.arange(size)).ravel()
        yield some, Chunk(0, len(some), chunk.data[at], np.arange(len(some) + 1) * size)
        size *= 2
    yield np.arange(len(chunk)), chunk


def _sample_cosines(model: Model):
    """Of the sample's texts and their prefixes: band, and cosine to the nearest centroid of all and of another language than theirs (NULL if there is none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = np.array(model.languages, dtype=object)
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            for chunk in _portions(batch.column(2)):
                for some, part in _prefixes(chunk):
                    counts = gram_counts(part)
                    cosines = weighed(counts, model.idf) @ model.centroids.T
                    lang = labels[chunk.first + some]
                    near, other = cosines.max(axis=1), np.where(lang[:, None] != languages, cosines, -1.0).max(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lang, pa.string()), pa.array(bands(counts)), pa.array(near, pa.float64()), pa.array(other, pa.float64(), mask=other < 0)], ["lang", "band", "near", "other"]
                    )

    return run


def floors(found: list) -> np.ndarray:
    """Least cosine by band from rows ``band, near, other, n`` per language: the low nearest cosine and the high one to other languages.

    A band of too few texts takes the bound of the next shorter one. Where languages overlap or labels are wrong, MOST keeps the
    bound below the cosines of the sample, so that learned texts stay.
    """
    out, last = np.full(BANDS, 1 - MAX_DISTANCE), 1 - MAX_DISTANCE
    for band in range(BANDS):
        rows = [r for r in found if r["band"] == band and r["n"] >= BAND_TEXTS]
        if rows:
            near, other = min(r["near"] for r in rows), max(r["other"] or 0.0 for r in rows)
            last = max(1 - MAX_DISTANCE, min((near + other) / 2, MOST * near))
        out[band] = last
    return out


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _sample_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells, values = [], []
        for chunk in _portions(batch.column(2)):
            for row in gram_counts(chunk):
                at = np.flatnonzero(row)
                cells.append(at.astype(np.int32))
                values.append(row[at].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int32()))], ["lang", "place", "cells", "counts"])


def _clusters(idf: np.ndarray, centroids: int):
    """Spherical k-means over the bounded sample of one language."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        counts = np.zeros((len(rows), DIMENSIONS), dtype=np.int32)
        for i, (cells, values) in enumerate(zip(rows["cells"], rows["counts"])):
            counts[i, cells] = values
        vectors = weighed(counts, idf)
        means = vectors[np.linspace(0, len(vectors) - 1, min(centroids, len(vectors))).astype(int)]
        for _ in range(12):
            nearest = np.argmax(vectors @ means.T, axis=1)
            sums = np.stack([vectors[nearest == k].sum(axis=0) if (nearest == k).any() else means[k] for k in range(len(means))])
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            means = sums / np.where(norms > 0, norms, 1)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "k": range(len(means)), "centroid": list(means)})

    return run


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """Centroids from about ``sample`` rows per language, chosen by a hash of the id; rows without text, letter or language are left out.

    The sample bounds what one task and the driver hold: per language its vectors, overall a few centroids
    per language and one weight per dimension.
    """
    spark = labelled.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "language-id")
    text, lang = F.col(text_column), F.col(lang_column)
    usable = labelled.where(lang.isNotNull() & has_letter(text)).select(lang.alias("lang"), F.xxhash64(F.col(id_column), text).alias("place"), text.alias("text"))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod("place", F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row per language, so the texts stay where they are.
    chosen = usable.join(F.broadcast(sizes), "lang").where(share * F.col("n") < sample).select("lang", "place", "text")
    vectors = scratch.save(chosen.mapInArrow(_sample_vectors, "lang string, place long, cells array<int>, counts array<int>"))
    spread = vectors.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("df")).toPandas()
    total = vectors.count()
    idf = np.full(DIMENSIONS, np.log(1 + total) + 1, dtype=np.float32)
    idf[spread["cell"]] = (np.log((1 + total) / (1 + spread["df"])) + 1).astype(np.float32)
    found = vectors.groupBy("lang").applyInPandas(_clusters(idf, centroids), "lang string, k int, centroid array<float>").toPandas()
    found = found.sort_values(["lang", "k"])
    matrix = np.array([np.asarray(c, dtype=np.float32) for c in found["centroid"]], dtype=np.float32).reshape(-1, DIMENSIONS)
    model = Model(found["lang"].tolist(), matrix, idf, floors([]))
    cosines = chosen.mapInArrow(_sample_cosines(model), "lang string, band long, near double, other double")
    quantile = lambda c, share: F.percentile(c, F.lit(share)).alias(c)
    rows = cosines.groupBy("lang", "band").agg(quantile("near", NEAR_SHARE), quantile("other", OTHER_SHARE), F.count(F.lit(1)).alias("n"))
    model.floors = floors(rows.collect())  # a row per language and band
    return model


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (cosine to the nearest centroid, 0 to 1) and ``rejected``.

    Only the text decides. A text that is NULL or has no letter is ``und`` with score 0 and rejected, as is
    every text when no language was learned. Columns of ``docs`` with these names are replaced.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score", "rejected").withColumn("lang_pred", has_letter(F.col(text_column)))
    names = docs.columns
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = np.array(model.languages, dtype=object)
        for batch in batches:
            labels = np.full(batch.num_rows, UNKNOWN, dtype=object)
            scores, rejected = np.zeros(batch.num_rows), np.ones(batch.num_rows, dtype=bool)
            if len(languages):
                for chunk in _portions(batch.column(at)):
                    counts = gram_counts(chunk)
                    cosines = weighed(counts, model.idf) @ model.centroids.T
                    nearest = np.argmax(cosines, axis=1)
                    best = cosines[np.arange(len(chunk)), nearest]
                    labels[chunk.first : chunk.last] = languages[nearest]
                    scores[chunk.first : chunk.last] = np.clip(best, 0, 1)
                    rejected[chunk.first : chunk.last] = best < model.floors[bands(counts)]
            dumb = ~batch.column(len(names) - 1).to_numpy(zero_copy_only=False).astype(bool)
            labels[dumb], scores[dumb], rejected[dumb] = UNKNOWN, 0.0, True
            more = [pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], [*names, "score", "rejected"])

    schema = extended(docs.drop("lang_pred").schema, lang_pred="string", score="double", rejected="boolean")
    return docs.mapInArrow(tidy(run), schema)
