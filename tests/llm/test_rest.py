"""WARC, quality, language, shards, personal data, decontamination and the pipeline."""

import gzip
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from urllib.parse import urlparse

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from textquarry.llm import decontam, langid, quality_llr, queries, sharding, warc


def rows(df, *drop):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=lambda x: tuple((v is None, str(v)) for v in x))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf_dir, tmp_path, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    queries.QUERIES[name](spark, sf_dir).write.parquet(f"{tmp_path}/out")
    want, got = con.sql(queries.ORACLES[name]), con.sql(f"SELECT * FROM '{tmp_path}/out/*.parquet'")
    columns = ", ".join(f'"{c}"' for c in sorted(want.columns))
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(repr, want.project(columns).fetchall())) == sorted(map(repr, got.project(columns).fetchall()))


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.example/", "<p>é</p><a href=\"/x\">y</a>", "clash"), (2, None, None, None), (3, "http://b.example/", "a\r\n\r\nWARC\r\n", "c")], "page_id bigint, url string, html string, block string")
    source = warc.responses(pages)
    made = warc.derive(source).cache()
    assert made.count() == 6 and made.select("record_id").distinct().count() == 6
    one = {r["type"]: r for r in made.where("page_id = 1").collect()}
    assert one["metadata"]["refers_to"] == one["conversion"]["refers_to"] == source.where("page_id = 1").first()["record_id"]
    assert one["metadata"]["concurrent_to"] == one["conversion"]["record_id"]
    assert one["conversion"]["block"] == "éy" and one["conversion"]["content_length"] == 3
    block = one["metadata"]["block"].split("\r\n")
    assert block[0] == "source-status: HTTP/1.1 200 OK" and "source-header: Content-Type: text/html; charset=utf-8" in block and "outlink: /x" in block
    warc.write_records(made, str(tmp_path / "out"), "none")
    text = "".join(p.read_text(encoding="utf-8", newline="") for p in (tmp_path / "out").glob("part*"))
    assert text.count("WARC/1.1\r\n") == 6 and text.endswith("\r\n\r\n")
    for r in made.collect():
        assert r["headers"] + "\r\n\r\n" + r["block"] + "\r\n\r\n" in text
    assert warc.derive(source.where("false")).count() == 0


BODIES = [b"<p>one</p>", b"a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nx", b"", b"\xff\x00\r\n\r\n", b"long " * 700_000, b"last\r\n"]


@pytest.mark.parametrize("packed", ["plain", "members", "whole"])
def test_warc_responses_are_read(spark, tmp_path, packed):
    def record(kind, i, block):
        return f"WARC/1.1\r\nWARC-Type: {kind}\r\nwarc-record-id: <urn:uuid:{i}>\r\nWARC-Target-URI: http://a.example/\r\n {i}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    records = [record("warcinfo", 99, b"x: y\r\n")] + [record("response", i, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + body) for i, body in enumerate(BODIES)]
    data = {"plain": b"".join(records), "members": b"".join(map(gzip.compress, records)), "whole": gzip.compress(b"".join(records))}[packed]
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "b.warc").write_bytes(data[: len(data) // 3])  # a file that breaks off
    got = [r for r in warc.read_responses(spark, str(tmp_path / "a.warc")).orderBy("record_id").collect()]
    assert [(r["record_id"], r["target_uri"], r["http_headers"], bytes(r["payload"])) for r in got] == [(f"<urn:uuid:{i}>", f"http://a.example/ {i}", "HTTP/1.1 200 OK\r\nA: b", body) for i, body in enumerate(BODIES)]
    assert warc.read_responses(spark, str(tmp_path / "b.warc")).count() < len(BODIES)
    made = warc.derive(warc.read_responses(spark, str(tmp_path / "a.warc"))).where("type = 'conversion'").collect()
    assert {r["source_digest"] for r in made} == {"sha256:" + hashlib.sha256(b).hexdigest() for b in BODIES}


def test_many_headers_and_repeated_responses(spark):
    head = "HTTP/1.1 200 OK\r\n" + "\r\n".join(f"H{i}: v" for i in range(100_001)) + "\r\nContent-Type: text/html; charset=iso-8859-1"
    row = ("<urn:uuid:1>", "http://a.example/", "2024-01-01T00:00:00Z", head, b"caf\xe9<a href='x'>y</a>")
    made = warc.derive(spark.createDataFrame([row, row], "record_id string, target_uri string, date string, http_headers string, payload binary")).collect()
    assert len(made) == 4 and len({r["record_id"] for r in made}) == 2
    block = next(r["block"] for r in made if r["type"] == "metadata")
    assert block.count("source-header: ") == 100_002 and "H100000: v" in block and "outlink: x\r\n" in block
    assert {r["block"] for r in made if r["type"] == "conversion"} == {"caféy"}


def test_records_that_are_written_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a.example/{i}", f"<p>{i}\r\n\r\né</p>\r\n") for i in range(40)], "page_id bigint, url string, html string")
    made = warc.derive(warc.responses(pages)).withColumn("headers", F.replace("headers", F.lit("WARC-Type: conversion"), F.lit("WARC-Type: response"))).cache()
    warc.write_records(made, str(tmp_path / "out"))
    got = {r["record_id"]: bytes(r["payload"]) if r["payload"] else r["http_headers"].encode() for r in warc.read_responses(spark, str(tmp_path / "out")).collect()}
    want = {r["record_id"]: r["block"].encode() for r in made.where("type = 'conversion'").collect()}
    assert got.keys() == want.keys() and len(got) == 40
    assert all(want[k].endswith(v) for k, v in got.items())


def slow_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def slow_score(text, table):
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    mask = (1 << 64) - 1
    one = [zlib.crc32(w) * 0x9E3779B97F4A7C15 & mask for w in words]
    two = [((a ^ 0xD6E8FEB86659FD93) * 0xBF58476D1CE4E5B9 + b) & mask for a, b in zip(one, one[1:], strict=False)]
    found = [(h >> 40) % quality_llr.BUCKETS for h in one + two]
    return sum(int(table[b]) for b in found) // len(found) if found else 0, found


def test_quality(make_docs, spark):
    r = random.Random(7)
    prose = lambda names, n: " ".join(r.choice(names) for _ in range(n))
    good, bad = [f"w{i}" for i in range(300)], [f"#q{i}|" for i in range(300)]
    texts = [prose(good, 80) for _ in range(40)] + [prose(bad, 80) for _ in range(20)] + [None, "", "a", "a b\na b\n\na b \n x" + " y z" * 60, "Über <b> & $5 " * 30]
    docs = make_docs(list(enumerate(texts)))
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 40, 2), 0, None, 999]], "doc_id bigint")
    table = quality_llr.ratios(docs, trusted)
    raw, target = Counter(), Counter()
    for i, t in enumerate(texts):
        found = slow_score(t, np.zeros(quality_llr.BUCKETS))[1]
        raw.update(found)
        target.update(found if i in range(0, 40, 2) else [])
    n, m = sum(target.values()) + quality_llr.BUCKETS, sum(raw.values()) + quality_llr.BUCKETS
    assert all(table[b] == round(1e6 * math.log((target[b] + 1) / n / ((raw[b] + 1) / m))) for b in range(0, quality_llr.BUCKETS, 7))
    got = {x["doc_id"]: tuple(x)[1:] for x in quality_llr.judge(docs, table).collect()}
    for i, t in enumerate(texts):
        base, score = slow_base(t), slow_score(t, table)[0]
        assert got[i] == (*base, score, not base[-1] and score >= quality_llr.THRESHOLD)
    assert min(got[i][-2] for i in range(0, 40, 2)) > max(got[i][-2] for i in range(40, 60))
    assert not quality_llr.ratios(docs, trusted.where("false")).any()
    assert quality_llr.judge(docs.where("false"), table).count() == 0


def test_quality_cut_follows_the_labels(make_docs, spark):
    assert [quality_llr.bucket_count(n) for n in (0, 1 << 20, 3 << 20, 25 << 20, 1 << 40)] == [1024, 1024, 2048, 16384, 65536]
    assert quality_llr.best_cut([(-9000, 0, 5), (-2000, 1, 3), (0, 20, 1), (4000, 30, 0)]) == 0
    assert quality_llr.best_cut([(5, 3, 0)]) == quality_llr.THRESHOLD
    r = random.Random(9)
    # Untrusted ones have a few words of their own; the fixed THRESHOLD tells these apart as well.
    prose = lambda k: " ".join(r.choice([f"w{r.randrange(300)}"] * 24 + [f"t{r.randrange(5)}"] * k) for _ in range(150))
    docs = make_docs(list(enumerate(prose(2 * (i % 4 == 0)) for i in range(400))))
    labels = spark.createDataFrame([(i, i % 4 != 0) for i in range(0, 400)], "doc_id bigint, trusted boolean")
    table, cut = quality_llr.fit(docs, labels)
    kept = {x["doc_id"] for x in quality_llr.judge(docs, table, cut).where("kept").collect()}
    assert sum(i % 4 == 0 for i in kept) <= 10 and sum(i % 4 != 0 for i in kept) >= 280


def test_word_numbers_survive_being_forgotten():
    words = quality_llr.Words(most=3)
    for _ in range(3):
        for text in (b"a b c d", b"d e f A", b"g"):
            found = text.split()
            numbers = words.of(found)
            assert words.hashes[numbers].tolist() == [zlib.crc32(w.lower()) for w in found]


def test_new_words_cost_the_same_however_many_there_are():
    words = quality_llr.Words()
    words.of([b"w%d" % i for i in range(300_000)])
    start = time.process_time()
    for i in range(20_000):
        number = words.of([b"w7", b"New%d" % i])
        assert words.hashes[number].tolist() == [zlib.crc32(b"w7"), zlib.crc32(b"new%d" % i)]
    assert time.process_time() - start < 2


@pytest.mark.parametrize("top", [4, 1 << 21, (1 << 21) + 4, 1 << 40])
def test_repeated_windows_of_any_numbers(top):
    r = random.Random(top)
    for n in [*range(12), 60]:
        ids = [top - 1 - r.randrange(4) for _ in range(n)]
        often = Counter(zip(ids, ids[1:], ids[2:], strict=False))
        covered = {i + k for i in range(n - 2) if often[tuple(ids[i : i + 3])] > 1 for k in range(3)}
        assert quality_llr.repeated(np.array(ids, np.int64)) == len(covered)


def test_counts_of_a_task_at_any_bound(monkeypatch):
    pack = zstandard.ZstdCompressor().compress
    batch = pa.RecordBatch.from_arrays([pa.array([pack(b"a b a"), None, pack(b"c a b"), pack(b" "), pack(b"d")]), pa.array([True, None, True, True, None]), pa.array([False, True, True, False, True])], ["packed", "trusted", "held"])
    for bound in (1, 6, 1 << 20):
        monkeypatch.setattr(quality_llr, "COUNTED_AT_ONCE", bound)
        (got,) = quality_llr._count(iter([batch, batch]), 1024)
        assert [sum(got[c].to_pylist()) for c in ("raw", "trusted", "apart")] == [22, 20, 10]


def slow_phrases(sample, line):
    """Greedy longest matches of line in sample, by search."""
    n = at = 0
    while at < len(line):
        end = at + 1
        while end <= len(line) and line[at:end] in sample:
            end += 1
        at, n = max(end - 1, at + 1), n + 1
    return n


def test_cross_parsing():
    samples = {"a": ["the cat sat on the mat", "a dog, a cat"], "b": ["le chat est sur le tapis à midi"], "c": ["Это кошка и собака 猫と犬"]}
    parser = langid.CrossParser(samples)
    table = parser.codes()
    texts = ["The cat", "le tapis, le chat", "zzz Ω!", "à", "cat" * 900 + " dog", "猫 собака", "thecatsat" * 2000, " ".join(["le chat the dog кошка Ω"] * 400)]
    lines = [langid.symbols(t, table) for t in texts]
    got = parser.phrases(lines)
    for k, lang in enumerate(parser.langs):
        sample = "".join(chr(c) for t in samples[lang] for c in [*langid.symbols(t, table).tolist(), langid.BORDER])
        for line, n in zip(lines, got[:, k], strict=True):
            assert n == slow_phrases(sample, "".join(map(chr, line)).replace(chr(langid.UNKNOWN), chr(200)))
    assert [x[0] for x in parser.predict([None, "", "12 !", *texts[:2], texts[5]], table)] == ["und", "und", "und", "a", "b", "c"]


def test_every_letter_has_a_symbol(monkeypatch):
    letters = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 3000))
    parser = langid.CrossParser({"zh": [letters], "ja": [letters[::-1]]})
    assert len(parser.alphabet) == 3000 and parser.predict([letters[100:160], letters[160:100:-1]], parser.codes())[0][0] == "zh"
    assert parser.predict([letters[160:100:-1]], parser.codes())[0][0] == "ja"
    monkeypatch.setattr(langid, "MOST_BYTES", 1000)
    with pytest.raises(ValueError, match="automata"):
        langid.CrossParser({"zh": [letters]})


@pytest.mark.parametrize("at_once", [1, 2, 3, 1500])
def test_phrases_of_random_lines(monkeypatch, at_once):
    monkeypatch.setattr(langid, "AT_ONCE", at_once)
    r = random.Random(2)
    samples = {k: ["".join(r.choice("abcd ") for _ in range(400))] for k in ("x", "y")}
    parser = langid.CrossParser(samples)
    table = parser.codes()
    lines = [langid.symbols("".join(r.choice("abcde ") for _ in range(n)), table) for n in (1, 1023, 1024, 1025, 5000, 2048)]
    for k, lang in enumerate(parser.langs):
        sample = "".join(chr(c) for c in [*langid.symbols(samples[lang][0], table).tolist(), langid.BORDER])
        for line, n in zip(lines, parser.phrases(lines)[:, k], strict=True):
            assert n == slow_phrases(sample, "".join(map(chr, line)).replace(chr(langid.UNKNOWN), chr(200)))


def slow_language(samples, text):
    """The language of the least cost by searching each phrase in the sample."""
    letters = {c for ts in samples.values() for t in ts for c in t.lower() if c.isalpha()}
    form = lambda t: re.sub("[^\\w]+", " ", "".join(c if c in letters else "\x00" if c.isalpha() else " " for c in t.lower()).replace("\x00", "Ω"))
    line, costs = form(text), []
    if not any(map(str.isalpha, text)):
        return "und"
    for lang in sorted(samples):
        sample = "".join(form(t) + "|" for t in samples[lang])
        costs.append((slow_phrases(sample, line) * math.log2(max(2, len(sample))), lang))
    return min(costs)[1]


def test_language(spark, sf_dir, make_docs, edge):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sample, apart = langid.sample(docs)
    parser = langid.CrossParser(sample, apart)
    got = langid.identify(docs, parser).join(docs, "doc_id")
    held = got.where("held_out").collect()
    assert held and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held) and sum(r["is_foreign"] for r in held) == 0
    assert all(r["lang_pred"] == slow_language(sample, r["text"]) for r in got.collect() if len(r["text"]) < 3000)
    learned = docs.where(~langid.held_out())
    texts = {r["text"] for r in learned.collect()}
    assert all(t in texts for ts in [*sample.values(), *apart.values()] for t in ts)
    assert not any(set(apart.get(k, [])) & set(ts) for k, ts in sample.items())
    pred = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(edge, parser).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (8, "und")} <= pred and (4, "und") not in pred
    assert langid.keep_identified(edge, parser).columns == edge.columns
    plain = langid.CrossParser(sample)  # knows nothing of what is foreign
    assert langid.keep_identified(edge, plain).count() == edge.count() - 4
    assert langid.sample(edge) == ({}, {}) and {r["lang_pred"] for r in langid.identify(edge, langid.CrossParser({})).collect()} == {"und"}
    assert langid.keep_identified(edge, langid.CrossParser({})).count() == langid.identify(edge.where("false"), parser).count() == 0


def test_foreign_texts_are_rejected(spark, sf_dir, make_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known, foreign = docs.where("lang IN ('en', 'fr')"), docs.where("lang = 'de' AND n_chars > 300")
    parser = langid.learn(known)
    assert langid.keep_identified(foreign, parser).count() <= 0.1 * foreign.count()
    assert langid.keep_identified(known, parser).count() >= 0.99 * known.count()
    asked = langid.keep_identified(known, parser, {"fr"}).collect()
    assert asked and sum(r["lang"] == "fr" for r in asked) >= 0.95 * len(asked)
    filled = langid.keep_identified(known.withColumn("lang", F.lit(None).cast("string")), parser).join(known.select("doc_id", F.col("lang").alias("label")), "doc_id").collect()
    assert sum(r["lang"] == r["label"] for r in filled) >= 0.97 * len(filled)


def test_only_long_texts_to_learn_from(make_docs):
    r = random.Random(4)
    texts = [" ".join(r.choice(["ab", "cde", "ef"]) for _ in range(20_000)), "xy zx " * 9000, "kurz und gut"]
    sample, _ = langid.sample(make_docs(list(zip([0, 1, 2], texts, strict=True)), ["a", "b", "c"]))
    assert {k: len(v) for k, v in sample.items()} == {"a": 1, "b": 1, "c": 1}


def test_shards(make_docs, edge, edge_rows):
    docs = make_docs([(i, "t" * (i % 90)) for i in range(4000)] + [(5, "again"), (None, None)])
    found = sharding.shard(docs, sharding.layout(24), sharding.grow(sharding.layout(24))).collect()
    assert len(found) == 4002
    for s in range(24):
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots))) and 90 < len(slots) < 260
    assert all(r["grown_shard"] in (r["shard"], 24) for r in found) and 100 < sum(r["grown_shard"] == 24 for r in found) < 230
    assert all(r["text_crc32"] == zlib.crc32(b"t" * (r["doc_id"] % 90)) and r["size"] == r["doc_id"] % 90 + 8 for r in found if r["doc_id"] not in (5, None))
    assert [(r["size"], r["text_crc32"]) for r in found if r["doc_id"] is None] == [(8, 0)]
    assert rows(sharding.shard(edge, sharding.layout(24))) == rows(sharding.shard(edge.repartition(7), sharding.layout(24)))
    assert sharding.shard(edge.where("false"), sharding.layout(24)).count() == 0


def slow_draw(key, node, path=""):
    """The shard by one draw after the other."""
    if node.shard is not None:
        return node.shard
    if len(node.children) == 1:
        return slow_draw(key, node.children[0], f"{path}{node.children[0].name}.")
    u = lambda c: (int(hashlib.md5(f"{key}/{path}{c.name}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
    best = min(node.children, key=lambda c: -math.log(u(c)) / c.weight)
    return best.shard if best.shard is not None else slow_draw(key, best, f"{path}{best.name}.")


def test_shards_by_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op6_hash_tree_shards"](spark, sf_dir).collect()}
    facts = {r["doc_id"]: (len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in texts}
    place = lambda i: (int(hashlib.md5(f"slot/{i}/{facts[i][0]}/{facts[i][1]}".encode()).hexdigest()[:13], 16), i)
    where = {r["doc_id"]: slow_draw(r["doc_id"], sharding.layout(24)) for r in texts}
    order = {s: sorted((i for i in where if where[i] == s), key=place) for s in range(24)}
    for r in texts:
        i, data = r["doc_id"], (r["text"] or "").encode()
        assert got[i] == (len(data) + 8, zlib.crc32(data), "key", where[i], order[where[i]].index(i), slow_draw(i, sharding.grow(sharding.layout(24))))


@pytest.mark.parametrize("n", range(1, 61, 3))
def test_one_more_shard_takes_rows_only_into_itself(n):
    tree = sharding.layout(n)
    more = sharding.grow(tree)
    moved = [(slow_draw(i, tree), slow_draw(i, more)) for i in range(600)]
    assert all(a == b or b == n for a, b in moved) and {b for _, b in moved} <= set(range(n + 1))
    assert 0.4 * 600 / (n + 1) - 4 < sum(b == n for _, b in moved) < 1.8 * 600 / (n + 1) + 8
    again = sharding.grow(more)
    assert all(b == n + 1 or b == slow_draw(i, more) for i, b in ((i, slow_draw(i, again)) for i in range(300)))


def test_slots_of_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LOT", 100)
    docs = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"))
    found = sharding.shard(docs, sharding.layout(24)).collect()
    assert len(found) == 3000 and len({r["shard"] for r in found if r["doc_id"] is None}) == 1
    for s in range(24):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))


def test_a_weight_moves_rows_only_in_its_subtree(spark):
    leaf = lambda i, w=1.0: sharding.Node(f"s{i}", w, shard=i)
    rack = lambda n, *leaves: sharding.Node(n, 2.0, leaves)
    tree = lambda w: sharding.Node("root", 4, (rack("k0", leaf(0), leaf(1, w)), rack("k1", leaf(2), leaf(3))))
    ids = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    moved = ids.select(sharding.draw(F.col("k"), tree(1.0)).alias("a"), sharding.draw(F.col("k"), tree(3.0)).alias("b")).where("a != b").collect()
    assert moved and {(r["a"], r["b"]) for r in moved} == {(0, 1)}


def slow_containment(docs, items):
    words = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    grams = lambda w, k: {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}
    out, wanted = [], []
    for j, u in items:
        w = words(u)
        if w:
            wanted.append((j, min(5, len(w)), grams(w, min(5, len(w)))))
    for i, t in docs:
        w = words(t)
        has = {k: grams(w, k) for k in range(1, 6)}
        out += [(i, j, len(item), len(has[k] & item)) for j, k, item in wanted if 1000 * len(has[k] & item) >= 800 * len(item)]
    return sorted(out, key=lambda x: (x[0] is None, x))


def test_decontamination(spark, make_docs, edge, edge_rows):
    r = random.Random(8)
    prose = lambda n: [f"w{r.randrange(400)}" for _ in range(n)]
    items = [(j, " ".join(prose(n))) for j, n in enumerate((5, 6, 9, 10, 14, 20, 40, 90, 4, 1))] + [(10, None), (11, ""), (12, "a b c d e f"), (2, "other text with the same id as item two")]
    docs = list(edge_rows)
    for k in range(120):
        item = r.choice(items)[1] or ""
        words = item.split()
        for _ in range(k % 4):  # some words changed
            if words:
                words[r.randrange(len(words))] = "changed"
        docs.append((100 + k, ", ".join([*prose(r.randint(0, 300)), *words, *prose(r.randint(0, 50))]).upper()))
    items += [(20, "France is Paris, today"), (21, "w1"), (22, "w2 w3"), (23, "w1"), *((30 + j, f"p{j} q r s t u") for j in range(300))]
    docs += [(300, "so france is paris today."), (301, "paris is"), (302, "france is paris todays"), (303, " ".join(f"p{j} q r s t u" for j in range(300)))]
    found = decontam.matches(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    got = sorted(((x["doc_id"], x["item_id"], x["n_item"], x["n_shared"]) for x in found.collect()), key=lambda x: (x[0] is None, x))
    assert got == slow_containment(docs, items) and len(got) > 20
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.matches(edge, none).count() == decontam.matches(edge.where("false"), spark.createDataFrame(items, none.schema)).count() == 0


def test_urls_of_pages_are_kept(spark, sf_dir):
    made = queries.QUERIES["op3_warc_derivatives"](spark, sf_dir).select("target_uri").distinct().collect()
    assert all(urlparse(r[0]).netloc for r in made)
