"""The corpus pipeline: documents in a known language, without near copies and repeated passages, mixed by source, tokenised.

Every stage takes and returns rows of ``documents`` (the last one returns tokens) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, lang_id, mixing
from tallyforge.llm.near_dedup import near_duplicates
from tallyforge.llm.queries import RANKS, vocabulary
from tallyforge.llm.storage import Scratch
from tallyforge.llm.substring_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is one of those learned stay; a missing ``lang`` is filled in.

    The model learns from labelled rows whose ``crc32(doc_id)`` modulo 4 is not 2. Texts that are NULL, have no
    letter or are far from every language go.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = lang_id.identify(docs.select(*COLUMNS), lang_id.fit(docs.where(~held_out)))
    return found.where("not rejected").withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the least ``doc_id``; of rows that share id and text, one.

    Rows that share an id but not the text are different documents: all of them go or stay by the verdict on their id. Of equal rows the one whose
    other columns come first stays.
    """
    copies = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    left = docs.join(copies, "doc_id", "left_anti").withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("text"), F.col("text"))})
    key = ["doc_id", "h1", "h2"]
    # Only rows that repeat are gathered by their text; the others are not moved for it.
    again = Scratch(spark, "repeated-rows").save(left.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select(*key))
    others = F.min(F.struct("lang", "source", "n_chars")).alias("first")
    once = left.join(again, key, "left_semi").groupBy("doc_id", "text").agg(others).select("doc_id", "text", "first.*")
    return left.join(again, key, "left_anti").select(*COLUMNS).unionByName(once.select(*COLUMNS))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go, and documents of which nothing is left; the others keep their text as it is."""
    cut = remove_repeats(docs.select(*COLUMNS)).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_removed") > 0, F.char_length("kept_text")).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": chars.cast("long")}).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes; every text stays whole."""
    return mixing.materialise(mixing.mix(docs.select(*COLUMNS), F.array("source"))).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with the digest of what they decode to."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary(RANKS), ends=None, digest="decoded_sha256")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_sha256")


STAGES = [("language ID", language), ("MinHash near-dedup", near_copies), ("substring dedup", passages), ("mixing", mix), ("byte-level BPE", tokens)]
#: The first stage is a trained classifier, which SQL cannot state; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each result is written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
