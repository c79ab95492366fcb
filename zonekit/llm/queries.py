"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm import bpe_codec, chat_format, chat_repair, jaccard_join, language_id, lsh_forest, mixing, packing, quality, ranked_search, repeats, secret_scan, token_files
from zonekit.llm.common import scratch, stored, table
from zonekit.llm.oracle import oracle_sql  # noqa: F401

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD_VOCABULARY = 49408
END_ID = 2
PACKED_END_ID = 1
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, WORD_TOKENIZER, END_ID)
    read = token_files.read_token_files(spark, out, WORD_VOCABULARY)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secret_scan.listed(F.col("base_spans")), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("all_spans")).alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.checksum_fold("doc_id") == 0
    profiles = stored(language_id.learn(docs.where(~held_out)), "language-profiles")
    predicted = language_id.predict(docs.select("doc_id", "text"), profiles, carry=["doc_id"])
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = mixing.sizes(table(spark, sf_dir, "documents"))
    sources = stored(mixing.targets(sized), "mix-sources")
    return mixing.taken(sized, sources).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "first_time")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat_format.format_conversations(turns)
    read = chat_format.read_turns(F.col("formatted"))
    digests = formatted.select("conv_id", F.size(read).cast("long").alias("n_turns"), F.length("formatted").cast("long").alias("formatted_chars"),
                               F.sha2(F.array_join(F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"))
    reply = chat_format.unescape(F.col("target"))
    losses = chat_format.expand_examples(formatted).groupBy("conv_id").agg(
        F.sum(F.length(reply)).alias("loss_chars"), F.array_sort(F.collect_list(F.struct("example", reply.alias("reply")))).alias("replies"))
    joined = digests.join(losses.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left")
    replies = F.coalesce(F.array_join(F.col("replies.reply"), ""), F.lit(""))
    return joined.select("conv_id", "n_turns", "turns_sha256", F.coalesce("loss_chars", F.lit(0)).cast("long").alias("loss_chars"),
                         F.sha2(replies, 256).alias("loss_sha256"), "formatted_chars")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"), span=200)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.quality(docs, labels, carry=["doc_id"])
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip_digests(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, PACKED_END_ID, length=2048)
    return packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


def damaged(turns: DataFrame) -> DataFrame:
    """The fixed damage to conversations, by checksum of ``conv_id:turn``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))
    return (turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
            .drop("copy"))


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repaired = chat_repair.repair(damaged(turns)).withColumnRenamed("conv_id", "c")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256")]
    every = turns.select("conv_id").distinct()
    return every.join(repaired, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", *counts, *texts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (op1_token_files, op2_secret_scan, op3_language_id, op4_source_mix, op5_ngram_jaccard, op6_chat_format,
                op7_suffix_dedup, op8_quality, op9_bpe_codec, op10_hash_forest, op11_ranked_search, op12_packing, op13_chat_repair)
    return {f.__name__: f for f in numbered} | {"pipeline": corpus_pipeline.run}
