"""The pipeline against a version without Spark, and its edge cases."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from textquarry.llm import langid, pii, queries
from tests.llm.test_dedup import slow_classes, slow_fingerprint
from tests.llm.test_rest import slow_containment

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at, r = str(tmp_path_factory.mktemp("data")), random.Random(9)
    words = {"aa": [f"ka{i}o" for i in range(300)], "bb": [f"zu{i}e" for i in range(300)]}
    words = {k: ["".join("abcdefghij"[int(c)] if c.isdigit() else c for c in w) for w in ws] for k, ws in words.items()}
    docs = []
    for i in range(120):
        lang = r.choice(["aa", "bb"])
        docs.append([i, " ".join(r.choice(words[lang]) for _ in range(r.randint(30, 200))), lang])
    items = [(j, " ".join(r.choice(words["aa"]) for _ in range(30))) for j in range(5)]
    docs += [[200 + i, docs[i][1], docs[i][2]] for i in range(0, 40, 3)]
    docs += [[300 + j, docs[j][1] + " " + items[j % 5][1], "aa"] for j in range(8)]
    docs += [[400, "call +1 (649) 555-1648 " + " ".join(docs[1][1].split()[::-1]), docs[1][2]], [401, None, "aa"], [402, "", None], [403, "12 34", "bb"], [404, "12 34", "bb"], [405, "x", "aa"]]
    docs += [[500 + k, " ".join("".join(r.choice("vwxyz") for _ in range(r.randint(2, 9))) for _ in range(120)), lang] for k, lang in enumerate(["aa", None, "bb"])]
    docs += [[600, " ".join(r.choice(words["bb"]) for _ in range(90)), None]]
    docs += [list(docs[5]), [None, docs[7][1], "aa"], [None, " ".join(docs[9][1].split()[::-1]), docs[9][2]]]
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in docs]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, items


def test_against_brute_force(spark, folder):
    at, rows, items = folder
    parser = langid.learn(spark.read.parquet(f"{at}/documents.parquet"))
    told = parser.predict([r[1] for r in rows], *parser.tables())
    docs = [r for r, (lang, _, foreign) in zip(rows, told, strict=True) if lang != "und" and not foreign]
    assert {r[0] for r in rows} - {r[0] for r in docs} >= {401, 402, 403, 404, 500, 501, 502}
    roots = slow_classes([slow_fingerprint(r[1]) for r in docs])
    best = {}
    for r, root in zip(docs, roots, strict=True):
        if root not in best or (r[0] is None, r[0]) < (best[root][0] is None, best[root][0]):
            best[root] = r
    hit = {i for i, *_ in slow_containment([r[:2] for r in best.values()], items)}
    kept = [r for r in best.values() if r[0] not in hit]
    private = {r["doc_id"]: r["text"] for r in pii.pseudonymise(spark.createDataFrame(kept, COLUMNS), queries.PII_KEY).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in kept:
        ids = library.encode(private[r[0]], add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256(private[r[0]].encode()).hexdigest()))
    got = [tuple(x)[:4] for x in corpus_pipeline.run(spark, at).collect()]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert hit and any("649" not in (private[i] or "") for i in (400,)) and 401 not in private


def test_stages_keep_columns_and_stand_empty_tables(spark, folder):
    at, _, _ = folder
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, at).schema.names == docs.schema.names
        assert stage(spark, docs.where("false"), at).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), at).count() == 0
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language(spark, docs, at).collect()}
    assert not {401, 402, 403, 404, 500, 501, 502} & kept.keys() and kept[600] == "bb" and sum(i is not None and i < 120 for i in kept) == 120


def test_languages_asked_for(spark, folder, monkeypatch):
    at, _, _ = folder
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", {"bb"})
    docs = spark.read.parquet(f"{at}/documents.parquet")
    assert {r["lang"] for r in corpus_pipeline.language(spark, docs, at).collect()} == {"bb"}
