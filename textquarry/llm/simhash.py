"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 bits gets a non-zero vector of RADIUS + 1 bits. For each
non-zero vector v of as many bits there is a table that keeps those bits of a
fingerprint whose vector has an odd product with v. For at most RADIUS
differing bits there is always a v orthogonal to all their vectors, so the
pair agrees on what that table keeps: no pair within the radius is missed
(Pagh, 2016).

A table's bucket may hold very many fingerprints, so its members aren't paired.
Two fingerprints of a bucket are within 2 bits of each other just if they
share a variant, itself or one of its free bits flipped; a variant is shared
by no more fingerprints than it has free bits, and all who share it are
within the radius of each other.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.components import components
from textquarry.llm.runtime import durable, keyed_text, map_texts

RADIUS, BITS, SHINGLE, SEED = 2, 64, 3, 42
#: A fingerprint of as large a part of all rows is hot; there are no more than so many.
HOT = 1000


def masks() -> list[int]:
    """The bits that each table keeps."""
    vectors = [1 + (i * 5 + i // 7) % 7 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 2 ** (RADIUS + 1))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None) -> int:
    """Bit b is set if over half of the shingles' hashes have it set; without words, zero."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and just the blanks of a word's definition
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, n).astype("<u8")
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i : i + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (64 bits, as a signed integer) of every row; worked out where rows are read."""

    def make():
        return lambda ids, texts: {"doc_id": ids, "fp": [signed(fingerprint(t)) for t in texts]}

    return map_texts(keyed_text(docs, id_col, text_col), make, "doc_id bigint, fp bigint")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints fp that connect all pairs within the radius, and no others."""
    tables = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(signed(m)).alias("kept")) for k, m in enumerate(masks())])
    keyed = fps.select("fp", F.explode(tables).alias("t")).select("fp", "t.k", F.col("fp").bitwiseAND(F.col("t.kept")).alias("key"))
    crowded = durable(keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1").select("k", "key"))
    members = keyed.join(crowded, ["k", "key"]).select("fp", "k")
    free = F.array(*[F.array(*[F.lit(0).cast("bigint"), *[F.lit(signed(1 << i)) for i in range(BITS) if not m >> i & 1]]) for m in masks()])
    variants = members.select("fp", "k", F.explode(F.element_at(free, F.col("k") + 1)).alias("flip")).select("fp", "k", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    shared = variants.groupBy("k", "variant").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()


def classes_of(found: DataFrame) -> DataFrame:
    """(fp, root) of each fingerprint of found (fp, ...); root is the least fingerprint of its class."""
    nodes = durable(found.select("fp").distinct())
    roots = durable(components(links(nodes)))
    return durable(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the least id that can be reached over links of at most
    RADIUS differing bits. Null texts are as texts without words: fingerprint
    zero, linked like any other. Rows with a null id count, but lend a
    component no name; a component of such rows only has none. Equal
    fingerprints, however many, are one node of the graph.
    """
    found = durable(fingerprints(docs, id_col, text_col))
    classes = classes_of(found)
    least = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = least.join(classes, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    names = durable(classes.join(named, "root").select("fp", "component_id"))
    # Fingerprints of one row in HOT or more: so few that they are broadcast, and so many rows that none may go to one task.
    hot = durable(found.groupBy("fp").agg(F.count("*").alias("n")).where(F.col("n") * HOT >= found.count()).join(names, "fp").select("fp", "component_id"))
    told = found.join(F.broadcast(hot), "fp").select("doc_id", "fp", "component_id").unionByName(found.join(F.broadcast(hot), "fp", "left_anti").join(names, "fp").select("doc_id", "fp", "component_id"))
    return told.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row left of each class: the one with the least id (nulls last), then the least hash of its text.

    Columns stay as they are. Of rows that agree in id and text, one stays, chosen by a hash of the row.
    """
    key = F.xxhash64(F.col(text_col).cast("string"))
    make = lambda: lambda ids, texts: {"doc_id": ids[0], "text_hash": ids[1], "fp": [signed(fingerprint(t)) for t in texts]}
    # A text's hash goes with its id, so that rows are found again whatever their ids.
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), key.alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    found = durable(map_texts(rows, make, "doc_id bigint, text_hash bigint, fp bigint", ("doc_id", "text_hash")))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = found.groupBy("fp").agg(F.min(rank).alias("first"))
    chosen = first.join(classes_of(found), "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    times = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("times"))
    chosen = durable(chosen.join(times, chosen["doc_id"].eqNullSafe(times["doc_id"]) & (chosen["text_hash"] == times["text_hash"])).select(chosen["doc_id"].alias("__id"), chosen["text_hash"].alias("__hash"), F.col("times").alias("__times")))
    kept = docs.join(chosen, F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (key == F.col("__hash")))
    # Only rows that are there several times have to meet; a hash of all columns chooses, so that any task chooses alike.
    whole = F.struct(*[kept[c] for c in docs.columns])
    again = kept.where("__times > 1").groupBy("__id", "__hash").agg(F.min_by(whole, F.xxhash64(*[kept[c] for c in docs.columns])).alias("one")).select("one.*")
    return kept.where("__times = 1").select(*docs.columns).unionByName(again)
