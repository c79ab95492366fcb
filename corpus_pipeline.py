"""A corpus from raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.llm import bpe_codec, jaccard_join, mixing, quality, secret_scan
from zonekit.llm.common import small_batches, stored, table

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the n-gram ratio reject."""
    small_batches(spark)
    scored = quality.quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) keep the
    row with the smallest id (null last, then by a digest of id and text; of rows equal in both, the
    least by all columns). Rows are told apart by that digest, so rows of equal or missing ids are no copies for it;
    a text without words is in no group and stays."""
    return jaccard_join.one_of_each(docs, k=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by a mark; other texts stay as they are."""
    return _sized(secret_scan.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by their sources' targets, some more than once, some not at all."""
    return _sized(mixing.mixed_documents(docs))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again."""
    small_batches(spark)
    # decoded from the stored ids: in one go, each core would keep two Python workers, in the stages of a next run as well
    ids = stored(bpe_codec.encode(docs.select("doc_id", "source", "text"), BYTE_RANKS, public_tokenizers.PATTERN), "pipeline-ids")
    coded = bpe_codec.decode(ids, BYTE_RANKS, public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_texts),
]

#: the quality, Jaccard and BPE stages are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
