"""Near-duplicates and repeated byte strings against brute force."""

import hashlib
import os
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from textquarry.llm import components, queries, runtime, simhash, suffix_dedup


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(prints):
    """Least position reachable over links of at most two bits."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_masks_cover_every_pair():
    masks = simhash.masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not m & (1 << i | 1 << j) for m in masks)


def test_fingerprints():
    for t in [None, "", " ", "One", "A b", "x Y z w", "É É É", "a " * 70000, "w\x85v u t"]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_links_connect_what_brute_force_connects(spark):
    r = random.Random(3)
    prints = [r.getrandbits(64) for _ in range(60)]
    for p in prints[:30]:
        for _ in range(6):
            prints.append(p := p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    centre = r.getrandbits(64)
    prints = [*dict.fromkeys([*prints, *(centre ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i))])]
    edges = simhash.links(spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint"))
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges.collect())
    found = {a: b for a, b in components.components(edges).collect()}
    mine = [found.get(simhash.signed(p), simhash.signed(p)) for p in prints]
    want = slow_classes(prints)
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = dict(components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert got == dict.fromkeys(range(51), 0) | dict.fromkeys(range(100, 140), 100)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates_on_edge_cases(edge, edge_rows):
    prints = [slow_fingerprint(t) for _, t in edge_rows]
    roots = slow_classes(prints)
    least = {r: min((i for (i, _), q in zip(edge_rows, roots, strict=True) if q == r and i is not None), default=None) for r in roots}
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(edge_rows, prints, roots, strict=True)), key=key)
    assert sorted(map(tuple, simhash.near_duplicates(edge).collect()), key=key) == want
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.near_duplicates(edge.where("false")).count() == simhash.keep_one(edge.where("false")).count() == 0


def slow_removal(texts, length=400):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(make_docs):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (70, 90, 150, 400)]
    texts = [None, "", "x" * 399, "x" * 400, "y" * 401, "ab" * 300, "abc" * 500]
    for _ in range(60):
        texts.append(" ".join(r.choice([prose(r.randint(1, 60)), r.choice(shared), r.choice(shared)[r.randint(0, 90) :]]) for _ in range(r.randint(1, 5))))
    base = prose(300)
    texts += [base, base, base + "z", "z" + base, base[:700] + "#" + base[701:], base[1:], base[:-1]]
    exact = prose(60)[:399]
    texts += ["l" + exact + "m", "n" + exact + "m", "n" + exact + "o", "p" + exact]
    got = suffix_dedup.remove_repeats(make_docs(list(enumerate(texts)))).drop("kept")
    assert [tuple(x)[1:] for x in got.orderBy("doc_id").collect()] == slow_removal(texts)


def test_piece_borders_leave_runs_whole(make_docs):
    r = random.Random(8)
    text = "".join(r.choice("abcd ") for _ in range(30_000))
    data = np.frombuffer(text.encode(), np.uint8)
    for size in (50, 700, 29_601):
        got = [np.concatenate(x) for x in zip(*suffix_dedup._runs(data, size), strict=True)]
        assert all((x == y).all() for x, y in zip(got, suffix_dedup.runs_of(data), strict=True))
    texts = [text + text[1000:2000], text[:9000] + "#" + text[9001:12_000], text[3000:4200]]
    alone = suffix_dedup.remove_repeats(make_docs([(0, text)]), piece=700).drop("kept").first()
    assert (alone["n_removed"], alone["n_spans"]) == (0, 0)
    done = suffix_dedup.remove_repeats(make_docs(list(enumerate(texts))), piece=700).drop("kept")
    assert [tuple(x)[1:] for x in done.orderBy("doc_id").collect()] == slow_removal(texts)


def test_buckets_are_refined_by_later_ones():
    data = np.frombuffer(b"abcabcabcab" * 3, np.uint8)
    two = suffix_dedup.refined(suffix_dedup.initial(data, 2), 2)
    four = suffix_dedup.refined(two, 3)
    for buckets, length in ((two, 4), (four, 7)):
        strings = [data[i : i + length].tobytes() for i in range(len(data) - length + 1)]
        assert len(strings) == len(buckets)
        assert [[a == b for a in strings] for b in strings] == [[a == b for a in buckets] for b in buckets]


def test_repeats_over_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = queries.QUERIES["op10_bucket_pointer_dedup"](spark, sf_dir).orderBy("doc_id").collect()
    assert [tuple(x) for x in got] == [(d["doc_id"], *x) for d, x in zip(docs, slow_removal([d["text"] for d in docs]), strict=True)]


def test_repeats_in_long_periodic_texts(make_docs):
    texts = ["z" * 3_000_000, "ab" * 200_000 + "c", "q" * 399]
    got = suffix_dedup.remove_repeats(make_docs(list(enumerate(texts)))).drop("kept", "kept_sha256").orderBy("doc_id").collect()
    assert [tuple(x)[1:] for x in got] == [(3_000_000, 3_000_000, 1), (400_001, 400_000, 1), (399, 0, 0)]


def test_repeats_on_edge_cases(edge, edge_rows):
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(((i, *x) for (i, _), x in zip(edge_rows, slow_removal([t for _, t in edge_rows]), strict=True)), key=key)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(edge).drop("kept").collect()), key=key) == want
    assert suffix_dedup.remove_repeats(edge.where("false")).count() == 0


def test_repeated_rows_are_copies(make_docs):
    text = "".join(random.Random(6).choice("abcdef ") for _ in range(900))
    rows = [(1, text), (1, text), (2, text[100:600] + "#" * 3)]
    assert sorted(tuple(x)[1:] for x in suffix_dedup.remove_repeats(make_docs(rows)).drop("kept").collect()) == sorted(slow_removal([t for _, t in rows]))


def test_tables_are_deleted(spark, make_docs):
    one, two = (runtime.durable(make_docs([(1, "a")])) for _ in range(2))
    runtime.discard(one)
    assert not os.path.exists(one._durable_path) and two.count() == 1
    runtime.clean(spark)
    assert not os.path.exists(two._durable_path) and not runtime._WRITTEN
    assert not os.listdir(os.path.dirname(two._durable_path))


def test_clashing_buckets_remove_nothing(spark):
    """Members of one bucket are repeats only where their digests agree."""
    kinds = [(1, 1), (1, 2), (2, 1), (3, 3), (3, 3)]
    rows = [(7, u, v, 1, i, i, 0, 0, 0, 0, False) for i, (u, v) in enumerate(kinds)] + [(8, 5, 5, 1, 9, 9, 0, 0, 0, 0, False), (9, 6, 6, 2, 10, 10, 0, 0, 0, 0, False)]
    made = spark.createDataFrame(rows, "core bigint, u bigint, v bigint, n bigint, id bigint, row bigint, anchor bigint, first bigint, last bigint, upto bigint, known boolean")
    repeats, left = suffix_dedup._settle(made, F.sum("n") > 1, ["id", "row"])
    assert sorted(r["id"] for r in repeats.collect()) == [3, 4, 10]
    assert sorted((r["id"], r["known"]) for r in left.collect()) == [(0, False), (1, False), (2, False), (3, True)]
