"""Operators, sources and sinks on small frames."""

import http.server
import json
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from textquarry import market, schemas
from textquarry.operators import extract, joins, nested, profile, site, topics
from textquarry.sources import files
from textquarry.streaming import ingest


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def values(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_split_record(spark):
    df = spark.createDataFrame([(1, "a,b,,", ["x", None], [(1, (2,)), (None, (None,))], (None,), [3]), (2, None, [], [], None, None)], "id int, f string, l array<string>, s array<struct<p:int,q:struct<r:int>>>, c struct<e:string>, n array<int>")
    out = nested.split_record(df, "id", {"f": ","})
    assert out.simple.columns == ["id"]
    assert [r[1] for r in values(out.children["f"], "id", "f")] == ["", "", "a", "b"]
    assert values(out.children["l"], "id") == [(1, "x")]
    assert out.children["s"].columns == ["id", "p", "q_r"] and values(out.children["s"], "id") == [(1, 1, 2)]
    assert out.children["c"].count() == 0
    assert values(out.children["n"], "id") == [(1, [3]), (2, None)]
    with pytest.raises(ValueError, match="nope"):
        nested.split_record(df, "nope")


def test_default_entity_json(spark):
    text = spark.range(1).select(nested.full_json(F.expr(schemas.default_entity_json()))).first()[0]
    assert json.loads(text)["communication"] == dict.fromkeys(["facebook_likes", "facebook_follower", "instagram_publication", "instagram_followers"])


def test_upgrade(spark):
    assert set(schemas.struct_of(schemas.ENTITY).names) <= set(schemas.upgrade(schemas.empty(spark, schemas.FORMER_ENTITY)).columns)


def test_upsert_twice_is_once(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    rows = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = joins.upsert(table, rows, "k")
    assert values(once, "k") == values(joins.upsert(once, rows, "k"), "k") == [(1, "a"), (2, "c"), (3, "d")]


def test_upsert_keeps_one_row_of_a_key(spark):
    table, rows = spark.createDataFrame([(1, "a", 0)], "k int, v string, t int"), spark.createDataFrame([(1, "b", 2), (1, "c", 1), (2, "d", 0), (2, "d", 0)], "k int, v string, t int")
    assert values(joins.upsert(table, rows, "k", "t"), "k") == [(1, "b", 2), (2, "d", 0)]
    assert values(joins.upsert(table, rows, "k"), "k") == [(1, "c", 1), (2, "d", 0)]


def test_quantiles(spark):
    r = random.Random(1)
    rows = [(r.random(), float(r.randrange(4)), None if i % 3 else i, None) for i in range(999)] + [(-5.0, 0.0, 7, None)]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double")
    shares = {"p0": 0.0, "p1": 0.01, "q25": 0.25, "q50": 0.5, "p999": 0.999, "p100": 1.0}
    got = {x["column"]: x for x in profile.quantiles(df, ["a", "b", "c", "d"], shares).collect()}
    assert got.keys() == {"a", "b", "c"}
    for k, name in enumerate("abc"):
        own = [x[k] for x in rows if x[k] is not None]
        assert got[name]["n"] == len(own)
        for share, q in shares.items():
            assert abs(got[name][share] - float(np.quantile(own, q))) < 1e-9
    assert values(profile.describe(df.select("d", "b")).select("column", "count", "q50"), "column") == [("b", 1000, float(np.quantile([x[1] for x in rows], 0.5))), ("d", 0, None)]
    assert values(profile.iqr_outliers(df, ["a", "d"]).select("column", "outliers"), "column") == [("a", 1), ("d", None)]


def test_unprocessed(spark):
    texts = spark.createDataFrame([("h", "b", 1), ("h", "a", 2), ("i", "c", 3)], "hash string, file_name string, x int")
    assert values(joins.unprocessed(texts, spark.createDataFrame([("i",)], "hash string")), "hash") == [("h", "a", 2)]


def test_fuzzy(spark):
    left = spark.createDataFrame([("Apple Inc.",), ("Google LLC",), ("corp the-big",), (None,), ("Microsofts",)], "a string")
    right = spark.createDataFrame([("Apple",), ("Google",), ("The Big, Corp",), ("Microsoft",), ("Microsoft ",)], "match string")
    assert values(joins.fuzzy_best(left, right, "a", "match"), "a") == [("Apple Inc.", None, None), ("Google LLC", None, None), ("Microsofts", "Microsoft", 95), ("corp the-big", "The Big, Corp", 100)]
    assert joins.fuzzy_left_join(left, right, "a", "match").count() == 5
    assert dict((a, m) for a, m, _ in values(joins.fuzzy_best(left, right, "a", "match", 60), "a"))["Apple Inc."] == "Apple"


@pytest.mark.parametrize("least", [95, 85, 84, 70, 50, 20])
def test_fuzzy_misses_nothing(spark, least):
    r = random.Random(least)
    names = ["".join(r.choice("abc d") for _ in range(r.randint(1, 20))) for _ in range(24)]
    for n in names[:16]:
        for _ in range(r.randint(1, 3)):
            i = r.randrange(len(n))
            n = n[:i] + r.choice(["", "x", n[i] + "e"]) + n[i + 1 :] or "z"
        names.append(n)
    left, right = names[::2], names[1::2]
    sort = lambda n: " ".join(sorted(n.lower().split()))
    want = {}
    for a in set(left):
        scores = sorted((-(100 if sort(a) == sort(b) else int(200 * lcs(sort(a), sort(b)) / max(1, len(sort(a)) + len(sort(b))) + 0.5)), b) for b in set(right))
        want[a] = (scores[0][1], -scores[0][0]) if -scores[0][0] >= least else (None, None)
    got = joins.fuzzy_best(spark.createDataFrame([(n,) for n in left], "a string"), spark.createDataFrame([(n,) for n in right], "b string"), "a", "b", least)
    assert {x["a"]: (x["match"], x["score"]) for x in got.collect()} == want


def test_suffixes(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert joins.left_join_suffixed(a, a, "k").columns == ["k", "v_x", "v_y"]


def test_row_id_is_gapless(spark):
    df = spark.range(0, 1000, 3).withColumn("x", F.col("id") * 7 % 11).drop("id").withColumn("y", F.monotonically_increasing_id())
    out = profile.with_row_id(df, "x", "y").orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(334)) and [(r["x"], r["y"]) for r in out] == sorted((r["x"], r["y"]) for r in out)


def test_row_id_of_ties_and_nulls(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 4 == 0, F.col("id") % 3).alias("x"), F.col("id").alias("y"), F.lit("same").alias("z"))
    out = profile.with_row_id(df, "x", parts=16).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(2000)) and [r["x"] for r in out] == [None] * 1500 + sorted(r["x"] for r in out if r["x"] is not None)
    same = profile.with_row_id(df.select("z"), "z", parts=4)
    assert sorted(r["id"] for r in same.collect()) == list(range(2000)) and profile.with_row_id(df.where("false"), "x").count() == 0


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, 1.0)], "a double, b double, c double")
    assert {(r["a"], r["b"]): r["corr"] for r in profile.correlations(df, ["a", "b", "c"]).collect()} == {("a", "a"): 1.0, ("a", "b"): None, ("a", "c"): None, ("b", "b"): None, ("b", "c"): None, ("c", "c"): None}


def test_histogram_of_equal_values(spark):
    assert values(profile.histogram(spark.createDataFrame([(1.0,), (1.0,), (None,)], "v double"), "v"), "bin") == [(1, 2)]


def test_topic_gate(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id int, t string")
    assert topics.is_heterogeneous(df, "t") and not topics.is_heterogeneous(df.withColumn("t", F.lit("x")), "t") and not topics.is_heterogeneous(df.where("false"), "t")
    with pytest.raises(topics.NotAllStringsError):
        topics.is_heterogeneous(df.select("id", F.col("id").alias("t")), "t")
    with pytest.raises(topics.TooManyColumnsError):
        topics.is_heterogeneous(df.withColumn("u", F.lit(1)), "t")


def test_topics_of_texts(spark):
    texts = ["red apple pie", "apple tart red", "green apple pie", "fast blue car", "blue car engine", "car blue wheel", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = {r["id"]: r for r in topics.annotate(df, "t", ["the"], k=2, label=lambda words: F.concat(F.lit("L "), F.element_at(words, 1))).collect()}
    assert out[6]["t_topic"] == -1 and out[6]["t_topic_label"] is None and out[6]["t_topic_count"] == 1 and out[6]["t_Representative_Docs"] is None
    for i in range(6):
        same = [t for k, t in enumerate(texts) if t and out[k]["t_topic"] == out[i]["t_topic"]]
        assert out[i]["t_topic_count"] == len(same) and out[i]["t_topic_label"].startswith("L ")
        assert set(out[i]["t_Representative_Docs"]) <= set(same) and len(out[i]["t_Representative_Docs"]) == min(3, len(same))
    assert topics.annotate(df.limit(1), "t", []).columns == df.columns
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0, 1.0])], "word string, vector array<double>")
    words = spark.createDataFrame([(1, w) for w in "abcd"], "topic int, word string")
    assert [r["word"] for r in topics.rerank_words(words, vectors, spark.createDataFrame([(1, [0.0, 2.0])], "topic int, centroid array<double>"), "topic", 2).orderBy("rank").collect()] == ["b", "c"]


def test_names_of_site_files(spark):
    sites = spark.createDataFrame([("https://a.example", "A"), ("https://b.example", "B")], "site string, text string")
    starts = spark.createDataFrame([("https://a.example/", "mine"), ("https://b.example/x", None)], "url string, file_name string")
    assert values(site.site_files(sites, starts), "text") == [("mine", "A"), ("https___b_example_x", "B")]
    assert values(site.site_files(sites, starts, generate=True), "text")[0] == ("https___a_example", "A")


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_bytes("é\nx".encode())
    (tmp_path / "in/b.dat").write_bytes(b"\xe9")
    assert values(files.read_texts(spark, str(tmp_path / "in")), "file_name") == [("a.txt", "é\nx")]
    assert values(files.read_texts_any_encoding(spark, str(tmp_path / "in")), "file_name") == [("a.txt", "é\nx"), ("b.dat", "é")]
    files.write_texts(files.read_texts(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    df = files.records(spark, [{"a": 1, "b": None}, {"a": 2}], "a int, b string")
    files.write_csv(df.select("a"), str(tmp_path / "csv"), ";")
    assert values(files.read_csv(spark, str(tmp_path / "csv"), "a int"), "a") == [(1,), (2,)]
    files.write_json(df, str(tmp_path / "json"))
    assert '"b":null' in spark.read.text(str(tmp_path / "json")).first()[0]
    files.write_tables(df, {"c": df}, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/c")).count() == 2


def test_site(spark):
    pages = spark.createDataFrame([("https://s.example/a", '<a href="b">x</a><a href="https://o.example/">y</a> one '), ("https://s.example/b", "two"), ("https://s.example/c", "  ")], "url string, html string")
    assert values(site.internal_links(pages), "link") == [("https://s.example", "https://s.example/b")]
    assert values(site.site_texts(pages, "|"), "site") == [("https://s.example", 2, "xy one|two")]
    got = site.crawl(spark.createDataFrame([("https://s.example/a",), ("https://gone.example/",)], "url string"), extract.table_fetcher(pages))
    assert values(got.select("url", F.col("html").isNull()), "url") == [("https://gone.example/", True), ("https://s.example/a", False), ("https://s.example/b", False)]


def test_analyse_and_market(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/one.txt").write_text("Entrée 12 € ; contact x@y.fr. 300 followers")
    (tmp_path / "a/two.txt").write_text(("Une phrase. " * 20000) + "Prix 7 euros.")
    directory = spark.createDataFrame([("one.txt", "One", "a, b"), ("two.txt", "Two", None), ("three.txt", "Three", "c")], "file_name string, name string, functions string")
    out = market.run(spark, [str(tmp_path / "a")], directory, separators={"functions": ","}, with_topics=False)
    assert [r["id"] for r in out.simple.orderBy("id").collect()] == [0, 1, 2] and out.children["functions"].count() == 3
    assert values(out.children["contact"].select("email"), "email") == [("x@y.fr",)]
    assert out.children["offers"].select("price").where("price = 12").count() == 1
    assert market.subject(out, "offres").columns == ["id", "description"] and "name" in market.subject(out, "évènements").columns
    counts = spark.createDataFrame([("ONE!", 3)], "declarant_nom_usuel string, n int")
    assert values(market.enrich(out.simple, counts).select("name", "n").where("n IS NOT NULL"), "name") == [("One", 3)]


def test_long_texts_keep_the_order_of_their_chunks(spark):
    texts = spark.createDataFrame([("a", "zebra@z.fr one. " + "x. " * 100 + "middle@m.fr two. " + "y. " * 100 + "apple@a.fr"), ("b", None), ("c", "." * 500), ("d", "short s@s.fr"), ("e", "")], "file_name string, text string")
    out = {r["file_name"]: r for r in extract.analyse(texts, schemas.empty(spark), extract.rule_extractor, 100, 60, 0).collect()}
    assert {k: r["contact"]["email"] for k, r in out.items()} == {"a": "zebra@z.fr", "b": None, "c": None, "d": "s@s.fr", "e": None}
    assert set(out) == set("abcde") and all(r["_error"] is None for r in out.values())


def test_model_extractor(spark):
    def ask(prompt):
        text = prompt.removeprefix("Read: ")
        if "boom" in text:
            raise ValueError("no model")
        if text == "[":
            return "[1, 2]"
        return {"odd": '{"objectives": 7}', "bad": "{"}.get(text, '{"association_name": "' + str(text.count("name")) + '", "objectives": ["o"]}')

    ask.__module__ = "__main__"  # sent by value
    model = extract.model_extractor(ask, "Read: {text}")
    texts = spark.createDataFrame([("a", "name"), ("b", "boom"), ("c", "odd"), ("d", "bad"), ("e", None), ("f", "["), ("g", "name. " * 50 + "boom. " + "name. " * 50)], "file_name string, text string")
    out = {r["file_name"]: r for r in extract.analyse(texts, schemas.empty(spark), model, 100, 60, 0).collect()}
    assert set(out) == set("abcdefg")
    assert out["a"]["association_name"] == "1" and out["a"]["objectives"] == ["o"] and out["a"]["offers"] == [] and out["a"]["_error"] is None
    assert out["b"]["_error"] == "ValueError: no model" and "no record" in out["c"]["_error"] and "no record" in out["d"]["_error"] and out["e"]["_error"] is None and "no record" in out["f"]["_error"]
    assert out["g"]["_error"] == "ValueError: no model" and int(out["g"]["association_name"]) > 5
    df = extract.analyse(texts, schemas.empty(spark), model, 100, 60, 0)
    assert [r["file_name"] for r in extract.failed(df).orderBy("file_name").collect()] == ["b", "c", "d", "f", "g"]


def test_prompts_and_placeholders(spark, tmp_path):
    files.write_prompt(spark, f"{tmp_path}/p.txt", "Name {what}: é")
    assert files.read_prompt(spark, f"{tmp_path}/p.txt", what="it") == "Name it: é"
    files.write_prompt(spark, f"{tmp_path}/p.txt", "new")
    files.placeholders(spark, str(tmp_path / "d"), ["a.txt", "b.txt"])
    assert files.read_prompt(spark, f"{tmp_path}/p.txt") == "new" and (tmp_path / "d/b.txt").read_bytes() == b"" and files.exists(spark, f"{tmp_path}/d") and not files.exists(spark, f"{tmp_path}/e")


class Page(http.server.BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        self.send_response(200 if self.path == "/ok" else 404)
        self.end_headers()
        self.wfile.write("é <b>".encode() + b"\xff")

    def log_message(self, *args):
        pass


def test_pages_are_fetched(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    urls = spark.createDataFrame([(f"{base}/ok",), (f"{base}/gone",), ("nonsense",), (f"{base}/ok",)], "url string")
    assert values(extract.http_fetcher(5)(urls), "url") == [(f"{base}/gone", None), (f"{base}/ok", "é <b>\ufffd"), ("nonsense", None)]
    server.shutdown()


def test_golden_json(spark):
    text = spark.range(1).select(nested.full_json(F.expr(schemas.default_entity_json()), pretty=True)).first()[0]
    want = json.dumps(json.loads(spark.range(1).select(nested.full_json(F.expr(schemas.default_entity_json()))).first()[0]), indent=2)
    assert json.loads(text) == json.loads(want) and text.replace(" :", ":").replace("[ ]", "[]").split() == want.split()


def test_streaming(spark, tmp_path):
    folder, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text("same")
    ingest.append_new(ingest.follow_folder(spark, folder), target, state).awaitTermination()
    (tmp_path / "in/b").write_text("same")
    (tmp_path / "in/c").write_text("new")
    ingest.append_new(ingest.follow_folder(spark, folder), target, state).awaitTermination()
    assert values(spark.read.parquet(target).select("file_name", "text"), "file_name") == [("a", "same"), ("c", "new")]
