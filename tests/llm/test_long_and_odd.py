"""Very long texts, repeated rows, null ids and clashing columns for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from textquarry.llm import bpe_trie, decontam, langid, quality_llr, sharding, simhash, suffix_dedup, token_counts, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = {"one": "a" * 1_000_000, "words": "word " * 200_000, "dots": "." * 1_000_000, "caps": "Abc " * 250_000, "digits": "12345 " * 160_000, "lines": "x\n" * 500_000, "cjk": "\u65e5\u672c" * 170_000, "tags": "<script>" * 125_000, "blank": " " * 1_000_000}


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame(list(enumerate(LONG.values())), "doc_id bigint, text string").repartition(4).cache()


def test_tokens_of_long_texts(long_docs):
    library = Tokenizer.from_file(PATH)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(LONG.values())}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(long_docs, PATH).collect()} == want
    got = bpe_trie.round_trip(long_docs, PATH).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and all(r["same"] for r in got)


def test_other_operators_on_long_texts(spark, long_docs):
    parser = langid.CrossParser({"x": ["word abc the cat"], "y": ["zzz yyy"]})
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(long_docs, parser).collect()}
    names = dict(enumerate(LONG))
    assert {names[i] for i, lang in found.items() if lang == "und"} == {"dots", "digits", "blank"} and found[1] == "x"
    facts = {names[r["doc_id"]]: r for r in quality_llr.judge(long_docs, quality_llr.ratios(long_docs, long_docs.where("doc_id = 1"))).collect()}
    assert facts["words"]["n_words"] == facts["words"]["n_repeat_words"] == 200_000 and facts["lines"]["n_dup_lines"] == 499_999 and facts["blank"]["n_words"] == 0
    assert simhash.near_duplicates(long_docs).count() == sharding.shard(long_docs, sharding.layout(24)).count() == len(LONG)
    items = spark.createDataFrame([(1, "word word word word word"), (2, "abc abc"), (3, "not there at all today")], "item_id int, text string")
    assert {(names[r["doc_id"]], r["item_id"]) for r in decontam.matches(long_docs, items).collect()} == {("words", 1), ("caps", 2)}
    cut = {names[r["doc_id"]]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(long_docs).collect()}
    assert all(cut[k] == (len(t.encode()), len(t.encode()), 1) for k, t in LONG.items())
    pages = long_docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example/").alias("url"), F.col("text").alias("html"))
    made = {names[r["page_id"]]: r["content_length"] for r in warc.derive(warc.responses(pages)).where("type = 'conversion'").collect()}
    assert made["tags"] == 0 and all(made[k] == len(t.encode()) for k, t in LONG.items() if k != "tags")


def test_quality_of_repeated_rows_and_null_ids(make_docs, spark):
    text = "some words of a text that is long enough " * 2
    docs = make_docs([(1, text), (1, text), (None, text), (2, None)])
    labels = spark.createDataFrame([(1, True), (1, False), (None, True), (2, True)], "doc_id bigint, trusted boolean")
    got = quality_llr.judge(docs, *quality_llr.fit(docs, labels)).collect()
    assert len(got) == 4 and len({tuple(r)[1:] for r in got if r["doc_id"] != 2}) == 1
    assert quality_llr.fit(docs.where("false"), labels.where("false"))[1] == quality_llr.THRESHOLD


def test_stages_with_clashing_columns(spark, tmp_path):
    text = "the cat sat on the mat and looked at the dog "
    rows = [(i, f"{text} {'abcdefghij'[i % 10]} " * 3 if i != 7 else None) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", *[F.lit(k).alias(c) for k, c in enumerate(("lang", "times", "root", "fp", "text_hash", "pii", "item_id", "h", "nr", "bits", "items", "row", "source", "n_chars", "score", "lang_pred"))])
    docs = docs.withColumn("lang", F.lit("en"))
    docs.limit(0).select(F.col("doc_id").alias("item_id"), "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and 0 < out.count() <= 12
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 12
