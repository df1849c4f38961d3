"""From pages to the text of a site, and directory listings to records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.functions import html as H
from textquarry.functions import text as T
from textquarry.functions import url as U
from textquarry.operators.extract import Fetcher


def internal_links(pages: DataFrame) -> DataFrame:
    """(base, link): distinct links of the pages (url, html) that stay within the page's site."""
    base = U.site_base(F.col("url"))
    found = pages.select("url", base.alias("base"), F.explode(H.links(F.col("html"))).alias("href"))
    return found.select("base", U.resolve_link(F.col("url"), F.col("href")).alias("link")).where(F.col("link").startswith(F.col("base"))).distinct()


def site_texts(pages: DataFrame, separator: str = "", closed: bool = False) -> DataFrame:
    """(site, n_pages, text): texts of a site's pages that have any, blanks collapsed, in the order of their URLs.

    A site's text is one value, so a site must fit a task; Spark's limit is 2 GB.
    """
    text = T.normalize_ws(H.html_to_text(F.col("html"), closed))
    found = pages.select(U.site_base(F.col("url")).alias("site"), "url", text.alias("text")).where("text != ''")
    return found.groupBy("site").agg(F.count("*").alias("n_pages"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("url", "text"))), lambda r: r["text"]), separator).alias("text"))


def site_files(sites: DataFrame, starts: DataFrame, generate: bool = False) -> DataFrame:
    """(file_name, text) of sites (site, text): named as starts (url, file_name) say, by the whole URL where that is null or ``generate`` asks for it."""
    name = F.lit(None).cast("string") if generate else F.col("file_name")
    named = starts.select(U.site_base(F.col("url")).alias("site"), F.coalesce(name, U.url_full_filename(F.col("url"))).alias("file_name"))
    return named.join(sites, "site").select("file_name", "text")


def crawl(starts: DataFrame, fetch: Fetcher) -> DataFrame:
    """(url, html) of the start pages (url) and of all pages of their sites that they link to."""
    first = fetch(starts)
    more = internal_links(first.where("html IS NOT NULL")).select(F.col("link").alias("url"))
    return fetch(starts.select("url").unionByName(more).distinct())


def directory_records(entries: DataFrame, wanted: str, base: str, fetch: Fetcher | None = None, link_class: str = "inline-link") -> DataFrame:
    """Records of directory entries (summary, url_suffix) that contain ``wanted``, with what their detail pages add."""
    kept = entries.where(F.contains("summary", F.lit(wanted)))
    out = kept.select(*[c.alias(n) for n, c in T.parse_summary(F.col("summary")).items()], "url_suffix").withColumn("file_name", U.sanitize_filename(F.col("name")))
    if fetch is None:
        return out
    address = F.concat(F.lit(base), F.lit("/"), F.col("url_suffix"))
    details = fetch(kept.select(address.alias("url")))
    details = details.select(F.col("url").alias("__address"), H.first_link(F.col("html"), link_class).alias("url"), H.first_element_text(F.col("html"), "div").alias("description"))
    joined = out.join(details, address == F.col("__address"), "left").drop("__address")
    return joined.withColumn("website_type", F.when(U.is_valid_url(F.col("url")), U.website_type(F.col("url"))))
