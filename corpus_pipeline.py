"""From raw documents to token ids: language, near-duplicates, benchmark passages, personal data, BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm import bpe_trie, decontam, langid, pii, simhash
from textquarry.llm.queries import BYTE_BPE, PII_KEY
from textquarry.llm.runtime import discard, durable
from textquarry.session import table

#: Languages that are kept, as a set of labels; None: all that the labelled documents teach.
LANGUAGES = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in the languages asked for; drops those foreign to all learned ones, null texts and those without a letter.

    A null label becomes the predicted language.
    """
    return langid.keep_identified(docs, langid.learn(docs), LANGUAGES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark."""
    hit = durable(decontam.matches(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("__id")) & F.xxhash64("text").eqNullSafe(F.col("__hash")), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts pseudonyms in the place of personal data; n_chars follows the text."""
    done = pii.pseudonymise(docs, PII_KEY, found_col="__pii").drop("__pii")
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left, decodes it again, and returns counts and digests."""
    return bpe_trie.round_trip(docs, public_tokenizers.path(BYTE_BPE))


STAGES = [("language_id", language), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontaminate), ("pii_pseudonyms", personal_data), ("bpe_round_trip", tokens)]

#: Fingerprints, suffix automata and BPE can't be written in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)  # its successor has been written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
