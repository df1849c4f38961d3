"""Records from text: providers, rules, and map-reduce over chunks."""

from __future__ import annotations

import logging
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry import schemas
from textquarry.functions.chunks import chunk


log = logging.getLogger(__name__)
#: Column of what went wrong with a text; null where nothing did.
ERROR = "_error"


class Fetcher(Protocol):
    """(url) -> (url, html); html is null where fetching failed."""

    def __call__(self, urls: DataFrame) -> DataFrame: ...


class Extractor(Protocol):
    """Rows with hash, file_name and text -> entity records."""

    def __call__(self, texts: DataFrame) -> DataFrame: ...


def table_fetcher(pages: DataFrame) -> Fetcher:
    """Fetches from a table of (url, html): for work without a network, and for tests."""
    return lambda urls: urls.select("url").distinct().join(pages.select("url", "html").dropDuplicates(["url"]), "url", "left")


def http_fetcher(timeout: float = 10.0) -> Fetcher:
    """Fetches over HTTP in the executors; any failure is a null."""

    def run(batches):
        import urllib.request

        for pdf in batches:
            found = []
            for url in pdf["url"]:
                try:
                    with urllib.request.urlopen(url, timeout=timeout) as reply:  # noqa: S310
                        found.append(reply.read().decode("utf-8", "replace"))
                except Exception:  # noqa: BLE001
                    found.append(None)
            yield pdf[["url"]].assign(html=found)

    return lambda urls: urls.select("url").distinct().mapInPandas(run, "url string, html string")


#: What the rules look for. Own choices, for corpora of associations' sites.
EMAIL = r"(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
PRICE = r"(\d{1,7})(?:[.,]\d+)? ?(?:€|EUR|euros?)"


def rule_fields(text: Column) -> dict[str, Column]:
    """First e-mail address, lowest price, follower and like counts, years of a text."""
    number = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("bigint")
    return {
        "email": F.nullif(F.regexp_extract(text, EMAIL, 0), F.lit("")),
        "price": F.array_min(F.transform(F.regexp_extract_all(text, F.lit(PRICE), F.lit(1)), lambda x: x.try_cast("bigint"))),
        "followers": number(r"(?i)(\d{1,12}) (?:followers|abonnés)"),
        "likes": number(r"(?i)(\d{1,12}) (?:likes|j'aime)"),
        "n_years": F.size(F.regexp_extract_all(text, F.lit(r"\b((?:19|20)\d{2})\b"), F.lit(1))).cast("bigint"),
    }


def rule_extractor(texts: DataFrame) -> DataFrame:
    """Entity records by rules: what can be found without a model, the rest null or empty."""
    f, struct = rule_fields(F.col("text")), schemas.struct_of(schemas.ENTITY)
    made = {
        "contact": F.struct(f["email"].alias("email")),
        "communication": F.struct(f["likes"].alias("facebook_likes"), f["followers"].alias("facebook_follower"), F.lit(None).cast("bigint").alias("instagram_publication"), F.lit(None).cast("bigint").alias("instagram_followers")),
        "offers": F.when(f["price"].isNotNull(), F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("target_group"), f["price"].alias("price")))),
        "hash": F.col("hash"), "file_name": F.col("file_name"),
    }
    empty = lambda t: F.array().cast(t) if t.typeName() == "array" else F.lit(None).cast(t)
    return texts.select(*[F.coalesce(made[x.name].cast(x.dataType), empty(x.dataType)).alias(x.name) if x.name in made else empty(x.dataType).alias(x.name) for x in struct])


def chunk_map_reduce(texts: DataFrame, key: str, extract: Callable[[Column], Column], size: int = 30_000, overlap: int = 100) -> DataFrame:
    """(key, n_chunks, parts): ``extract`` of each chunk of a text, joined in order by new lines.

    Chunks are rows of their own, so one long text is worked on by many tasks.
    """
    parts = texts.select(key, F.posexplode(chunk(F.col("text"), size, overlap)).alias("pos", "chunk")).select(key, "pos", extract(F.col("chunk")).alias("part"))
    return parts.groupBy(key).agg(F.count("*").alias("n_chunks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda r: F.coalesce(r["part"], F.lit(""))), "\n").alias("parts"))


def _filled(found: Column, given: dict[str, Column]) -> list[Column]:
    """The entity record's columns from a parsed struct, and from those given; what is missing is null or empty."""
    empty = lambda t: F.array().cast(t) if t.typeName() == "array" else F.lit(None).cast(t)
    return [F.coalesce(given.get(x.name, found[x.name]).cast(x.dataType), empty(x.dataType)).alias(x.name) for x in schemas.struct_of(schemas.ENTITY)]


def model_extractor(ask: Callable[[str], str], prompt: str = "{text}") -> Extractor:
    """Entity records by a model: ``ask`` gets the prompt with {text} replaced and returns JSON.

    Called in the executors, a batch of rows at a time. A call that fails, a
    reply that isn't JSON of an object or has a field of another type than the
    record's gives an empty record and says why in ``_error``; other rows go
    on. Null texts aren't asked about.
    """

    def run(batches):
        for pdf in batches:
            replies, errors = [], []
            for text in pdf["text"]:
                try:
                    replies.append(None if text is None else ask(prompt.replace("{text}", text)))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf[["hash", "file_name"]].assign(reply=replies, error=errors)

    def extract(texts: DataFrame) -> DataFrame:
        asked = texts.select("hash", "file_name", "text").mapInPandas(run, "hash string, file_name string, reply string, error string")
        wrong = "__wrong"
        found = F.from_json("reply", f"{schemas.ENTITY}, {wrong} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": wrong})
        rows = asked.withColumn("__found", found)
        bad = F.when(F.col("reply").isNotNull() & (F.col("__found").isNull() | F.col("__found")[wrong].isNotNull() | ~F.col("reply").rlike(r"^\s*\{")), F.concat(F.lit("the reply is no record: "), F.left("reply", F.lit(200))))
        rows = rows.withColumn(ERROR, F.coalesce("error", bad)).withColumn("__found", F.when(F.col(ERROR).isNull(), F.col("__found")))
        return rows.select(*_filled(F.col("__found"), {"hash": F.col("hash"), "file_name": F.col("file_name")}), ERROR)

    return extract


def failed(records: DataFrame) -> DataFrame:
    """(hash, file_name, _error) of the texts that gave no record, to be written apart and tried again."""
    return records.where(F.col(ERROR).isNotNull()).select("hash", "file_name", ERROR)


def analyse(texts: DataFrame, done: DataFrame, extract: Extractor, long_text: int = 100_000, size: int = 30_000, overlap: int = 100) -> DataFrame:
    """Records, with ``_error``, of the texts (file_name, text) whose hash isn't in done; long ones by way of their chunks.

    A long text's chunks are worked on by themselves; what is found in them,
    as JSON in the order of the chunks, is the text that its record is made
    from. Null texts and texts without a chunk have a record too. A chunk that
    fails is left out, and the text's record says so.
    """
    from textquarry.functions.text import text_hash
    from textquarry.operators.joins import unprocessed

    new = unprocessed(texts.withColumn("hash", text_hash(F.col("text"))), done)
    is_long = F.coalesce(F.char_length("text") >= long_text, F.lit(False))
    short, long = new.where(~is_long), new.where(is_long)
    # A chunk's position goes with the hash: an extractor hands on hash and name, nothing else.
    chunks = long.select("hash", "file_name", F.posexplode_outer(chunk(F.col("text"), size, overlap)).alias("pos", "text"))
    chunks = chunks.select(F.concat("hash", F.lit("#"), F.coalesce("pos", F.lit(0)).cast("string")).alias("hash"), "file_name", "text")
    pieces = _with_error(extract(chunks))
    found = F.to_json(F.struct(*[c for c in pieces.columns if c not in ("hash", "file_name", ERROR)]))
    pieces = pieces.select(F.substring_index("hash", "#", 1).alias("hash"), "file_name", F.substring_index("hash", "#", -1).cast("int").alias("pos"), F.when(F.col(ERROR).isNull(), found).alias("found"), ERROR)
    joined = pieces.groupBy("hash", "file_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "found"))), lambda r: r["found"]), "\n").alias("text"), F.min_by(ERROR, F.when(F.col(ERROR).isNotNull(), F.col("pos"))).alias("__error"))
    whole = _with_error(extract(joined.select("hash", "file_name", "text"))).join(joined.select("hash", F.col("__error")), "hash", "left")
    whole = whole.withColumn(ERROR, F.coalesce(ERROR, "__error")).drop("__error")
    log.info("texts of %d characters and more go by chunks of %d", long_text, size)
    return _with_error(extract(short.select("hash", "file_name", "text"))).unionByName(whole)


def _with_error(records: DataFrame) -> DataFrame:
    return records if ERROR in records.columns else records.withColumn(ERROR, F.lit(None).cast("string"))
