"""Edge cases of the functions, by hand."""

import re
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from textquarry.functions import chunks, dates, encoding, redact, similarity
from textquarry.functions import html as H
from textquarry.functions import text as T
from textquarry.functions import url as U
from textquarry.operators import extract


def apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


EDGE = [None, "", " ", " ", "a  b", "Éric Pré", "2024", "2024-03-01", "01/02/2024", "x@y.fr.", "4111 1111 1111 1111", "a\r\nb", "0612345678", "Jean Dupont", "a,b,,"]


def test_normalize_ws(spark):
    assert apply(spark, EDGE, T.normalize_ws) == [None if v is None else " ".join(v.split()) for v in EDGE]


#: The rules as plain patterns, in order.
PLAIN = (
    ("email", r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", "[EMAIL REDACTED]"),
    ("long_number", r"\b\d{10,}\b", "[PHONE NUMBER REDACTED]"),
    ("phone", r"\+?\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}", "[PHONE NUMBER REDACTED]"),
    ("card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "[CREDIT CARD REDACTED]"),
    ("date_dmy", r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b", "[DATE REDACTED]"),
    ("date_ymd", r"\b\d{4}[-/]\d{2}[-/]\d{2}\b", "[DATE REDACTED]"),
    ("name", r"\b[A-Z][a-z]+(?:\s[A-Z][a-z]+)*\b", "[NAME REDACTED]"),
)
PRIVATE = [*EDGE, "a@b.c_x@d.e", "x@y.z@w.v", "Jean Dupont2 Abc Def", "Jean André", "A Bc De Fgh1 Ij", "9 Ab\nCd", "@a.b c@d", "Ab Cd é", "tel 01 23 45 67 89, 5-6-2024", "." * 50 + "@x.y"]


def test_redact_is_pythons(spark):
    def want(v):
        for _, pattern, mask in PLAIN:
            v = re.sub(pattern, mask, v)
        return v

    assert apply(spark, PRIVATE, redact.redact) == [None if v is None else want(v) for v in PRIVATE]


@pytest.mark.parametrize(("name", "pattern", "mask"), PLAIN)
def test_redact_one_rule(spark, name, pattern, mask):
    assert apply(spark, PRIVATE, lambda c: redact.redact(c, name)) == [None if v is None else re.sub(pattern, mask, v) for v in PRIVATE]


@pytest.mark.parametrize("text", ["Abc " * 300_000, "a." * 500_000, "x@" + "a." * 500_000 + "com", "1" * 1_000_000, "12 " * 300_000, "Ab" * 500_000], ids=["names", "dots", "mail", "ones", "numbers", "mixed"])
def test_redact_long_texts(spark, text):
    start = time.time()
    assert apply(spark, [text], redact.redact)[0] is not None
    assert apply(spark, [text], lambda c: F.regexp_extract(c, extract.EMAIL, 0))[0] is not None
    assert time.time() - start < 40


class Texts(HTMLParser):
    """Text nodes outside of scripts and styles, and targets of anchors, by the standard library."""

    def __init__(self):
        super().__init__()
        self.out, self.links, self.inside = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.inside = tag in ("script", "style")
        if tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.links.append(href)

    def handle_endtag(self, tag):
        self.inside = False

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


PAGES = [
    "<p>a<script>var x='<b>';</script>b<style>p{}</style><!-- c -->&amp;d &eacute;</p>", "", None, "a < b", "<a href=\"/x\">1</a><a class='y' href=\"z\">2</a>",
    "&#8217;&#x2019;&rsquo; &uuml;&copy &notit; &bogus; &", "<a href='q'>1</a><a href=u>2</a><a title=\"x>y\" href = 'v&amp;w'>3</a><A HREF=\"W\">4</A><a>5</a><a data-href='n'>6</a><abbr href='n'>7</abbr>",
    "<!-- <a href='no'>x</a> --> 1 <SCRIPT>let a = \"<a href='no'>\";</SCRIPT >2<br/>3", "x<b\nclass='c'\n>y</b\n>", "<!DOCTYPE html><html><head><title>T</title></head><body>é <img alt='>'>z</body>",
]


def test_html_is_the_standard_librarys(spark, sf_dir):
    real = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    texts, links = apply(spark, PAGES + real, H.html_to_text), apply(spark, PAGES + real, H.links)
    for page, text, found in zip(PAGES + real, texts, links, strict=True):
        if page is None:
            assert text is None and found is None
            continue
        want = Texts()
        want.feed(page)
        want.close()
        assert text == "".join(want.out) and found == want.links


@pytest.mark.parametrize("page", ["<script>" * 125_000, "<a " * 300_000, "<a href='" * 100_000, "<!--" * 250_000, "&" * 1_000_000, "<style>" + "</styl" * 160_000, "<a href=\"x\">" * 80_000], ids=["scripts", "tags", "quotes", "comments", "refs", "style", "anchors"])
def test_html_of_long_pages(page):
    start = time.time()
    H.text_of(page)
    list(H.links_of(page))
    assert time.time() - start < 10


def test_first_matches(spark):
    pages = ['<a class="other" href="n">x</a><a href="u" class="big inline-link">x</a>', "<p>", "<a class=inline-link href='v'>", "<a class='inline-link2' href='v'>"]
    assert apply(spark, pages, lambda c: H.first_link(c, "inline-link")) == ["u", None, "v", None]
    assert apply(spark, ['<div class="c"> <b>hi</b> </div>', "<div></div>"], lambda c: H.first_element_text(c, "div")) == ["hi", None]


LINKS = ["/a", "b", "../c", "./d", "#e", "?f=1", "//h.example/g", "https://x.example/", "", "mailto:a@b.c"]


def test_links_resolve_as_in_python(spark):
    base = "https://s.example:81/dir/page.html?q=1#x"
    assert apply(spark, LINKS, lambda c: U.resolve_link(F.lit(base), c)) == [urljoin(base, h) for h in LINKS]


def test_website_type(spark):
    urls = ["https://www.facebook.com/x", "http://m.www.facebook.com", "https://facebook.com:443/", "https://u@facebook.com", "x", "", None]
    assert apply(spark, urls, U.website_type) == ["Facebook", U.OTHER_SITE, U.OTHER_SITE, U.OTHER_SITE, U.OTHER_SITE, U.OTHER_SITE, U.OTHER_SITE]


def test_valid_url(spark):
    urls = ["https://a.fr", "ftp://a.b.example/x?y#z", "http://localhost:80", "http://1.2.3.4/x", "a.fr", "http://a", "http:// a.fr", "", None]
    assert apply(spark, urls, U.is_valid_url) == [True] * 4 + [False] * 5


def test_file_names(spark):
    assert apply(spark, ["a/b:c*?", "  x  ", "_y_", "n" * 300, "back\\slash", ""], U.sanitize_filename) == ["a_b_c", "x", "y", "n" * 255, "back\\slash", ""]
    assert apply(spark, ["https://h.example/a/b.html?x", "https://h.example", "/" + "p" * 60], U.url_to_filename) == ["a_b_html", "", "p" * 50]
    assert apply(spark, ["https://h.example/a/"], U.url_full_filename) == ["https___h_example_a"]
    assert apply(spark, ["https://h.example/a/b", "https://h.example/c.txt", "https://other.example/"], lambda c: U.suffix_filename(c, "https://h.example")) == ["a_b.txt", "c.txt", None]


def test_encoding(spark):
    data = [bytearray(b"A\xffB"), bytearray("é".encode()), bytearray(b""), None]
    assert apply(spark, data, encoding.repair_utf8, "binary") == ["AB", "é", "", None]
    assert apply(spark, data, encoding.detect_encoding, "binary")[:3] == ["ISO-8859-1", "UTF-8", "UTF-8"]
    assert apply(spark, data, encoding.decode_any, "binary") == ["AÿB", "é", "", None]


def test_dates(spark):
    assert [d and d.isoformat()[:10] for d in apply(spark, ["2024-03-01", "01/02/2024", "2024-05", "soon", None], dates.parse_date)] == ["2024-03-01", "2024-02-01", "2024-05-01", None, None]


def test_summary(spark):
    text = " Name of it \n Status \n à Lille\n× one\n× two "
    got = spark.range(1).select(*[c.alias(n) for n, c in T.parse_summary(F.lit(text)).items()]).first().asDict()
    assert got == {"name": "Name of it", "status": "Status", "localisation": "Lille", "functions": "one, two"}
    assert set(spark.range(1).select(*[c.alias(n) for n, c in T.parse_summary(F.lit("?")).items()]).first()) == {""}


def test_token_clean(spark):
    assert apply(spark, ["The cat's, AND dog!", "", None], lambda c: T.clean_tokens(c, ["the", "and"])) == [["cats", "dog"], [], None]
    assert apply(spark, ["The cats and dogs"], lambda c: T.clean_tokens(c, ["the"], lambda x: F.regexp_replace(x, "s$", ""))) == [["cat", "and", "dog"]]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarity(spark):
    pairs = [("blue bolt", "blue bolts"), ("", "a"), ("", ""), ("abc", "abc"), ("kitten", "sitting"), ("éa", "aé"), ("ab" * 31, "ba" * 31), ("ab" * 32, "ba" * 31), ("abc" * 30, "cab" * 25), ("a" * 62, "a" * 200), ("x" * 63, "x" * 62 + "y")]
    df = spark.createDataFrame(pairs, "a string, b string").select(similarity.lcs_length(F.col("a"), F.col("b")), similarity.ratio(F.col("a"), F.col("b")))
    for (a, b), (n, score) in zip(pairs, df.collect(), strict=True):
        assert n == lcs(a, b)
        assert score == (100 if a == b else round(200 * lcs(a, b) / (len(a) + len(b))))


def test_chunks():
    text = ". ".join(f"sentence number {i}" for i in range(200))
    parts = chunks.split_chunks(text, 300, 60)
    assert all(len(p) <= 300 for p in parts) and parts[0].startswith("sentence number 0") and parts[-1].endswith("199")
    assert {int(x) for p in parts for x in re.findall(r"number (\d+)", p)} == set(range(200))
    assert chunks.split_chunks("x" * 50 + ".y", 10, 2) == ["x" * 50, "y"]
    assert chunks.split_chunks("", 10, 2) == chunks.split_chunks(" ", 10, 2) == []
    assert chunks.split_chunks(" . ", 10, 2) == ["."]


def test_nulls_in_chunks(spark):
    assert apply(spark, [None, "a.b"], lambda c: chunks.chunk(c, 10, 2)) == [[], ["a.b"]]
