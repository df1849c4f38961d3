"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is in a document if the document holds at least ``threshold`` of the
item's distinct shingles. An item's sketch is the least hashes of its
shingles: of q shingles, so many that at least one of them must be in any
document that holds ceil(threshold * q). So a document that shares no hash
with the sketch can't contain the item, whatever its own length: nothing is
missed, and a document's size does not dilute the sketch as it does a
Jaccard estimate. Items are partitioned by their size (powers of two), each
part with a bound on the hashes that its sketches use and on the size of the
documents that can contain its items. Candidates are verified by the exact
containment of their shingles as text.

Only DataFrame functions, and one plan at every size. Documents' hashes are
looked up where they are read in two broadcast tables of hash bits, of at most
2 ** FILTER_BITS rows each however many items there are (a Bloom filter);
what passes meets the sketches, and documents with a candidate are verified.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.llm.runtime import durable

SHINGLE, THRESHOLD = 5, 0.8
#: Bits of a hash in each of the two filters.
FILTER_BITS = 20
#: Items that are verified against a document at once, as a power of two.
TOGETHER = 7


def words(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often use refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def over_shingles(found: Column, make: Callable[[Column], Column], n: int) -> Column:
    """make(first index) for each shingle of n words; none for fewer words."""
    last = F.size(found) - n
    return F.slice(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), make), 1, F.greatest(last + 1, F.lit(0)))


def hashes(found: Column, n: int = SHINGLE) -> Column:
    return over_shingles(found, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(n)]), n)


def strings(found: Column, n: int = SHINGLE) -> Column:
    return over_shingles(found, lambda i: F.array_join(F.slice(found, i + 1, n), " "), n)


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, n_item, n_shared, containment of all pairs of containment ``threshold`` or more.

    An item of fewer than n words has one shingle, all its words in order; it
    is in a document that has these words in a row. Items without words are in
    no document. Repeated rows of either side give repeated pairs; other
    columns are ignored.
    """
    # Containment is compared in whole thousandths, so that 0.8 * 35 is 28.
    per_mille = round(1000 * threshold)
    need = lambda q: F.ceil(q * per_mille / F.lit(1000)).cast("int")
    whole = lambda w: F.array(F.array_join(w, " "))
    wanted = items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col).cast("string")).alias("w")).where(F.size("w") > 0)
    short = F.when(F.size("w") < n, F.size("w")).otherwise(0)
    hashed = hashes(F.col("w"), n)
    for k in range(1, n):
        hashed = F.when(F.size("w") == k, hashes(F.col("w"), k)).otherwise(hashed)
    wanted = durable(wanted.select("item_id", short.alias("short"), F.array_distinct(F.when(F.size("w") < n, whole(F.col("w"))).otherwise(strings(F.col("w"), n))).alias("item"), F.array_sort(F.array_distinct(hashed)).alias("h"), F.monotonically_increasing_id().alias("nr")))
    sized = wanted.withColumns({"q": F.size("item"), "part": F.floor(F.log2(F.size("item"))).cast("int")})
    sketches = durable(sized.select("nr", "short", "part", need(F.col("q")).alias("need"), F.explode(F.slice("h", 1, F.col("q") - need(F.col("q")) + 1)).alias("h")))
    # A few rows: one for each power of two and each number of words under n.
    parts = sketches.groupBy("part", "short").agg(F.min("need").alias("need"), F.max("h").alias("most")).collect()

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    if not parts:
        none = F.lit(0)
        return texts.where("false").select("doc_id", "text_hash", F.lit(None).cast(items.schema[item_col].dataType).alias("item_id"), none.alias("n_item"), none.alias("n_shared"), F.lit(0.0).alias("containment"))
    lengths = sorted({p["short"] or n for p in parts})
    # Hashes alone are exploded: what else a row has is copied for each of them, so words must not be there any more.
    held = texts.select("doc_id", "text_hash", bind(words(F.col("text")), lambda w: F.concat(*[hashes(w, k) for k in lengths])).alias("hs"))
    held = held.select("doc_id", "text_hash", F.size("hs").alias("size"), "hs").select("doc_id", "text_hash", "size", F.explode("hs").alias("h"))
    # What no part can use goes before the look-up.
    useful = None
    for p in parts:
        one = (F.col("size") >= p["need"]) & (F.col("h") <= p["most"])
        useful = one if useful is None else useful | one
    held = held.where(useful)
    for k in range(2):
        bits = F.shiftrightunsigned("h", 64 - FILTER_BITS * (k + 1)).bitwiseAND((1 << FILTER_BITS) - 1)
        held = held.withColumn("bits", bits).join(F.broadcast(sketches.select(bits.alias("bits")).distinct()), "bits", "left_semi").drop("bits")
    found = durable(held.join(sketches, "h").where("size >= need").select("doc_id", "text_hash", "nr").distinct())

    # A document meets its candidates TOGETHER at a time, so that its shingles are worked out once for all of them.
    chosen = found.join(wanted.select("nr", "item_id", "short", "item"), "nr").groupBy("doc_id", "text_hash", F.shiftright("nr", TOGETHER).alias("__lot")).agg(F.collect_list(F.struct("item_id", "short", "item")).alias("items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    # Texts that have no candidate go first, by ids alone.
    near = found.select("doc_id", "text_hash").distinct()
    held = texts.join(near, same(texts, near), "left_semi")
    both = held.join(chosen, same(held, chosen)).select(held["doc_id"], held["text_hash"], "text", "items")

    def shared(has: Column) -> Column:
        count = lambda x: F.when(x["short"] > 0, F.contains(has["line"], F.concat(F.lit(" "), F.get(x["item"], F.lit(0)), F.lit(" "))).cast("int")).otherwise(F.size(F.array_intersect(has["shingles"], x["item"])))
        return F.transform("items", lambda x: F.struct(x["item_id"].alias("item_id"), F.size(x["item"]).alias("n_item"), count(x).alias("n_shared")))

    has = bind(words(F.col("text")), lambda w: F.struct(F.array_distinct(strings(w, n)).alias("shingles"), F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" ")).alias("line")))
    pairs = both.select("doc_id", "text_hash", F.explode(bind(has, shared)).alias("p")).select("doc_id", "text_hash", "p.*")
    return pairs.where(F.col("n_shared") >= need(F.col("n_item"))).withColumn("containment", F.round(F.col("n_shared") / F.col("n_item"), 6))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda x: x <> '') AS w FROM benchmark),
its AS (SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda j: array_to_string(w[j:j + 4], ' '))) AS s FROM i WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM its),
ds AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS s FROM d, ks),
n AS (SELECT item_id, count(*)::INT AS n_item FROM its GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*)::INT AS n_shared, round(count(*) / n_item, 6) AS containment
FROM ds JOIN its USING (k, s) JOIN n USING (item_id) GROUP BY doc_id, item_id, n_item HAVING count(*) * 1000 >= n_item * 800
"""
