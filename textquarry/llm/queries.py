"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.llm import bpe_trie, decontam, langid, pii, quality_llr, sharding, simhash, suffix_dedup, token_counts, warc
from textquarry.session import table

BYTE_BPE = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages"))).drop("headers", "date", "content_type")


def op4_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").selectExpr("doc_id", "quality = 1 AND toxic = 0 AS trusted")
    return quality_llr.judge(docs, *quality_llr.fit(docs, labels))


def op5_cross_parsing_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), sharding.layout(24), sharding.grow(sharding.layout(24)))


def op7_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: For these queries only; a real key comes from a secret store.
PII_KEY = "textquarry-demo-key"


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pii.pseudonymise(docs, PII_KEY)
    kinds = F.transform("pii", lambda m: m["kind"])
    return done.select("doc_id", "text", kinds.alias("kinds")).select("doc_id", "text", F.size("kinds").alias("n_found"), F.array_join("kinds", " ").alias("kinds"))


def op9_minhash_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op10_bucket_pointer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_bpe_trie, op3_warc_derivatives, op4_quality_llr, op5_cross_parsing_langid, op6_hash_tree_shards, op7_covering_simhash, op8_feistel_pseudonyms, op9_minhash_decontam, op10_bucket_pointer_dedup)}
ORACLES: dict[str, str] = {"op3_warc_derivatives": warc.ORACLE, "op9_minhash_decontam": decontam.ORACLE}
