"""Text functions, Column to Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_ws(text: Column) -> Column:
    """Runs of white space (Unicode, and the separators U+001C to U+001F) to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def is_blank(text: Column) -> Column:
    return normalize_ws(text) == ""


def strip_control(text: Column) -> Column:
    """The class of characters is a fixed value."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def strip_tags(text: Column) -> Column:
    """Without DOTALL: a tag that spans lines stays."""
    return F.regexp_replace(text, r"(?d)<.*?>", "")


def strip_nonprintable(text: Column) -> Column:
    """Controls, formats and separators other than the blank become blanks."""
    return F.regexp_replace(text, r"[\p{C}\p{Z}&&[^ ]]", " ")


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda x: x != "")


def without_stopwords(found: Column, stop: list[str]) -> Column:
    """Compared in lower case."""
    words = F.array(*[F.lit(w) for w in stop])
    return F.filter(found, lambda x: ~F.array_contains(words, F.lower(x)))


def clean_tokens(text: Column, stop: list[str], lemma: Callable[[Column], Column] | None = None) -> Column:
    """Tokens without punctuation, lower-cased, without stop words or empty ones; ``lemma`` gives each one's base form."""
    bare = F.transform(tokens(text), lambda x: F.lower(F.regexp_replace(x, r"[^\p{L}\p{N}_]", "")))
    found = F.filter(without_stopwords(bare, stop), lambda x: x != "")
    return F.transform(found, lemma) if lemma else found


def text_hash(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def render(template: str, **values: Column) -> Column:
    """The template with {name} replaced by columns; null is the empty text."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def parse_summary(text: Column) -> dict[str, Column]:
    """Name, status, place and functions of a directory entry; '' where there is none. The patterns are fixed values."""
    text = F.trim(F.replace(text, F.lit(" "), F.lit(" ")))
    text = F.regexp_replace(text, r"^\s+|\s+$", "")
    return {
        "name": F.trim(F.regexp_extract(text, r"(?d)^(.*?)\s+\n", 1)),
        "status": F.trim(F.regexp_extract(text, r"(?d)\n\s*(.*?)\s*\n\s*à", 1)),
        "localisation": F.trim(F.regexp_extract(text, r"à\s*([^\n]+)", 1)),
        "functions": F.array_join(F.regexp_extract_all(text, F.lit(r"(?d)×\s*(.*?)\s*(?:\n|$)"), F.lit(1)), ", "),
    }
