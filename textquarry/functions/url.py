"""URL and file-name functions, Column to Column."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Host to label; below, the characters of file names. Fixed values.
SITE_TYPES = {"facebook.com": "Facebook", "instagram.com": "Instagram", "twitter.com": "Twitter", "linkedin.com": "LinkedIn", "youtube.com": "YouTube", "tiktok.com": "TikTok", "soundcloud.com": "SoundCloud", "bandcamp.com": "Bandcamp"}
OTHER_SITE = "Site personnel"


def netloc(url: Column) -> Column:
    """What stands between // and the path, port and user included; '' if there is none."""
    return F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)


def site_base(url: Column) -> Column:
    """Scheme and host."""
    return F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)


def website_type(url: Column) -> Column:
    host, out = F.replace(netloc(url), F.lit("www."), F.lit("")), None
    for name, label in SITE_TYPES.items():
        out = F.when(host == name, label) if out is None else out.when(host == name, label)
    return out.otherwise(OTHER_SITE)


def is_valid_url(url: Column) -> Column:
    """http, https or ftp with a host that has a dot or is localhost."""
    return F.coalesce(url.rlike(r"(?i)^(?:https?|ftp)://(?:[^\s/?#@]+@)?(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)++[\p{L}]{2,63}(?::\d{1,5})?(?:[/?#]\S*)?$") | url.rlike(r"(?i)^(?:https?|ftp)://(?:localhost|\d{1,3}(?:\.\d{1,3}){3})(?::\d{1,5})?(?:[/?#]\S*)?$"), F.lit(False))


def resolve(base: Column, href: Column) -> Column:
    """A link of a page as an absolute URL: absolute, //host, /path, ?query, #fragment, and names beside the page, without dot segments."""
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page.rlike("^[^:/?#]+://[^/]*$"), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([^:/?#]+:)", 1), href))
        .when(href.startswith("/"), F.concat(site_base(base), href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(folder, href))
    )


@F.pandas_udf(StringType())
def resolve_any(base: pd.Series, href: pd.Series) -> pd.Series:
    """As resolve, with dot segments; in Python, for the few links that have them."""
    from urllib.parse import urljoin

    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)])


def resolve_link(base: Column, href: Column) -> Column:
    """Native unless the link has dot segments."""
    return F.when(href.rlike(r"(^|/)\.\.?(/|$)"), resolve_any(base, href)).otherwise(resolve(base, href))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#;]*)", 1)


def _safe(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "^/+|/+$", ""), "[^a-zA-Z0-9_-]", "_")


def url_to_filename(url: Column, most: int = 50) -> Column:
    """The path with anything unusual as _, cut to ``most`` characters."""
    return F.substring(_safe(path(url)), 1, most)


def url_full_filename(url: Column) -> Column:
    return _safe(url)


def suffix_filename(url: Column, base: str | Column) -> Column:
    """What follows ``base``/ in the URL, / as _, with .txt; null if the URL does not have it."""
    start = F.concat(F.lit(base) if isinstance(base, str) else base, F.lit("/"))
    rest = F.when(F.contains(url, start), F.replace(F.regexp_extract(F.substring_index(F.replace(url, start, F.lit("\x01")), "\x01", -1), "^([^\\n]*)", 1), F.lit("/"), F.lit("_")))
    return F.when(rest.endswith(".txt"), rest).otherwise(F.concat(rest, F.lit(".txt")))


def sanitize_filename(name: Column, most: int = 255) -> Column:
    """Characters that file systems forbid and runs of blanks as _, none at the ends, cut to ``most``."""
    name = F.regexp_replace(F.regexp_replace(name, r'[/:*?"<>|]', "_"), r"(?U)\s+", "_")
    return F.left(F.regexp_replace(name, "^_+|_+$", ""), F.lit(most))
