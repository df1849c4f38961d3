"""HTML to text and links, by one pass of a tokenising pattern over each page.

In Python, by Arrow batches: character references have some two thousand
names, some of which need no semicolon, and one compiled pattern is faster
than the many passes that expressions would take.
"""

from __future__ import annotations

import html as stdlib
import re
from collections.abc import Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: A script or style with all it holds, a comment, any other tag (quoted values may hold >). What is not closed reaches to the end, so that no place is looked at twice.
TOKEN = re.compile(
    r"""<(?:(?P<raw>script|style)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\b[^>]*+>|\Z)"""
    r"""|!--.*?(?:--!?>|\Z)"""
    r"""|(?P<tag>[a-z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|[/!?a-z][^>]*+(?:>|\Z))""",
    re.IGNORECASE | re.DOTALL,
)
HREF = re.compile(r"""(?:^|[\s"'/])href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.IGNORECASE)
#: A character reference that ends in a semicolon.
CLOSED = re.compile(r"&(?:#(?:[0-9]++|[xX][0-9a-fA-F]++)|[a-zA-Z][a-zA-Z0-9]*+);")


def _unescape_closed(m: re.Match) -> str:
    # A name that isn't known may begin with one that is: &ampx; stays.
    return stdlib.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0]


def text_of(page: str, closed: bool = False) -> str:
    text = TOKEN.sub("", page)
    return CLOSED.sub(_unescape_closed, text) if closed else stdlib.unescape(text)


def links_of(page: str) -> Iterator[str]:
    for m in TOKEN.finditer(page):
        if m["tag"] and m["tag"].lower() == "a" and (found := HREF.search(m["rest"])):
            yield stdlib.unescape(next(x for x in found.groups() if x is not None))


@F.pandas_udf(StringType())
def _text(pages: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else text_of(x) for x in pages], dtype=object)


@F.pandas_udf(StringType())
def _closed_text(pages: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else text_of(x, True) for x in pages], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def _links(pages: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else list(links_of(x)) for x in pages], dtype=object)


def html_to_text(html: Column, closed: bool = False) -> Column:
    """The text nodes, joined without a separator, references decoded; scripts, styles and comments are dropped. Null stays null.

    Some references need no semicolon, as browsers read them; ``closed``
    decodes only those that have one, and leaves a cut-off ``&amp`` as it is.
    """
    return _closed_text(html) if closed else _text(html)


def links(html: Column) -> Column:
    """Targets of the anchors, in order, references decoded; quoted in either way or not at all."""
    return _links(html)


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute as it is written; '' if there is none."""
    pattern = rf"""(?i)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def first_link(html: Column, css_class: str) -> Column:
    """Target of the first anchor of a class; null if there is none."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?i)(<a\s[^>]*>)"), F.lit(1))
    of_class = F.get(F.filter(anchors, lambda a: F.array_contains(F.split(attribute(a, "class"), r"\s+"), F.lit(css_class))), F.lit(0))
    return F.nullif(attribute(of_class, "href"), F.lit(""))


def first_element_text(html: Column, tag: str, closed: bool = False) -> Column:
    """Trimmed text of the first element of a kind; null if there is none or it is empty."""
    return F.nullif(F.trim(html_to_text(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1), closed)), F.lit(""))
