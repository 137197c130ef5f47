"""One query per operator over its whole table, with SQL where SQL can say what it returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.llm import bpe, lang_id, line_crf, sql, token_files, warc
from tallyforge.llm.best_fit import pack_documents
from tallyforge.llm.embedding_dedup import near_vectors
from tallyforge.llm.mixing import mix
from tallyforge.llm.near_dedup import near_duplicates
from tallyforge.llm.ngram_lm import score_texts
from tallyforge.llm.periodic_runs import find_runs
from tallyforge.llm.registry import ORACLES, QUERIES, query, table
from tallyforge.llm.storage import Scratch
from tallyforge.llm.substring_dedup import remove_repeats
from tallyforge.llm.turn_repair import digest_turns, joined, repair_turns



def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORDS, RANKS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"

__all__ = ["ORACLES", "QUERIES"]


@query(sql.NEAR_DUPLICATES)
def op1_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary(RANKS))


@query(sql.SUBSTRING_DEDUP)
def op8_substring_dedup(spark, sf_dir):
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query()
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query(sql.MIX)
def op3_mix_sources(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), F.array("source")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op10_quality_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = line_crf.fit(docs, table(spark, sf_dir, "labels"), F.col("quality") == 1)
    return line_crf.judge(docs, field).drop("text")


@query(sql.NEAR_VECTORS)
def op9_embedding_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(sql.WARC)
def op2_warc(spark, sf_dir):
    folder = Scratch(spark, "warc").folder()
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), folder)
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    responses = warc.read_warc(spark, folder).where("warc_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    )
    digest = warc.base32_hex(F.substring_index("payload_digest", ":", -1))
    revisits = warc.read_warc(spark, folder, payload=False).where("warc_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"),
        F.lit("revisit").alias("record_type"), page("refers_to").alias("refers_to"),
    )
    return responses.unionByName(revisits)


@query()
def op5_token_files(spark, sf_dir):
    folder = Scratch(spark, "tokens").folder()
    token_files.write_tokens(table(spark, sf_dir, "documents"), vocabulary(WORDS), folder)
    return token_files.read_tokens(spark, folder, ["ids_crc32"])


@query()
def op6_ngram_scores(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)


@query(sql.PERIODIC_RUNS)
def op12_periodic_runs(spark, sf_dir):
    h = F.crc32(F.col("doc_id").cast("string"))
    # In every tenth document the words from number a on repeat with period p; the array of words is bound to a name by transform.
    repeated = F.expr(
        "transform(array(regexp_extract_all(text, '([^ \\\\x09-\\\\x0D]+)', 1)), ws -> transform(array(cast(g % nullif(size(ws), 0) as int)), a -> "
        "transform(array(1 + (size(ws) - a) div (3 + g % 8)), p -> concat(slice(ws, 1, a), "
        "slice(flatten(array_repeat(slice(ws, a + 1, cast(p as int)), cast((size(ws) - a) div p + 1 as int))), 1, size(ws) - a)))[0])[0])[0]"
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"), F.expr("crc32(cast(doc_id as string)) div 10").alias("g"))
    text = F.when(F.col("h") % 10 == 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    found = find_runs(docs.select("doc_id", text.alias("text")))
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query()
def op11_best_fit_packing(spark, sf_dir):
    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary(BYTES))
    return packed.drop("token_ids")


@query(sql.TURN_REPAIR)
def op13_turn_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(own("conv_id"), F.lit(":"), own("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(own("text"), "[.!?]", "")).otherwise(own("text"))
    role = F.when(fault == 4, "user").otherwise(own("role"))
    damaged = rows.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    repair = repair_turns(damaged)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = joined(joined(rows.select("conv_id").distinct(), repair.summary, ["conv_id"], "left"), digest_turns(repair.turns), ["conv_id"], "left")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
