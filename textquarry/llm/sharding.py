"""Shards by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws one number for every child, -ln(u) / weight with u
from a hash of the row's key and the child's name, and descends to the child
with the least. A child's draw does not depend on its siblings, so a weight
that changes moves rows only into or out of that child's subtree, and a child
that is added takes rows only into itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Slots of rows that are alike, given out at once.
LOT = 1 << 14


@dataclass(frozen=True)
class Node:
    """A shard (``shard`` set) or a group of nodes. Names are unique among siblings."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def layout(n: int, rack: int = 4, region: int = 2) -> Node:
    """Shards 0 to n - 1 of weight 1 in racks of ``rack``, racks in regions of ``region``, filled in order."""
    racks = [Node(f"k{i}", min(rack, n - rack * i), tuple(Node(f"s{s}", 1, shard=s) for s in range(rack * i, min(n, rack * (i + 1))))) for i in range(math.ceil(n / rack))]
    regions = [Node(f"r{i}", sum(k.weight for k in racks[region * i : region * (i + 1)]), tuple(racks[region * i : region * (i + 1)])) for i in range(math.ceil(len(racks) / region))]
    return Node("root", n, tuple(regions))


def grow(tree: Node) -> Node:
    """The tree with one more shard, in a region of its own: no weight that is there changes, so rows move into the new shard only."""

    def highest(node: Node) -> int:
        return node.shard if node.shard is not None else max(map(highest, node.children))

    new = highest(tree) + 1
    return Node(tree.name, tree.weight + 1, (*tree.children, Node(f"r{len(tree.children)}", 1, (Node(f"s{new}", 1, shard=new),))))


def uniform(*parts: Column) -> Column:
    """In (0, 1), from the first 52 bits of the MD5 of the parts."""
    return (F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def draw(key: Column, node: Node, path: str = "") -> Column:
    """The shard that ``key`` (string) descends to."""
    if node.shard is not None:
        return F.lit(node.shard)
    if len(node.children) == 1:
        return draw(key, node.children[0], f"{path}{node.children[0].name}.")
    # Only the chosen child's subtree is evaluated: CASE is lazy.
    draws = [F.struct((-F.ln(uniform(key, F.lit(path + c.name))) / F.lit(float(c.weight))).alias("x"), F.lit(i).alias("i")) for i, c in enumerate(node.children)]
    best = F.least(*draws)["i"]
    if all(c.shard is not None for c in node.children):
        return F.element_at(F.array(*[F.lit(c.shard) for c in node.children]), best + 1)
    # An array of one index, bound once: its lambda sees the chosen child without drawing again for each branch.
    def descend(i: Column) -> Column:
        out = None
        for k, c in enumerate(node.children):
            below = draw(key, c, f"{path}{c.name}.")
            out = F.when(i == k, below) if out is None else out.when(i == k, below)
        return out

    return F.transform(F.array(best), descend)[0]


def shard(docs: DataFrame, tree: Node, grown: Node | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    size: UTF-8 bytes of the text (null: none) plus 8; text_crc32 of a null
    text is that of the empty one. A null id is a key of its own. slot numbers
    a shard's rows from 0 without gaps, in the order of a hash of id, size and
    checksum (then these), so it does not depend on how rows are dealt out.

    Rows that agree in all of this are counted first and numbered together,
    so a repeated or null id is no hot key. Numbering is in two levels: a
    shard's rows are dealt to sub-ranges of the hash, as many as make the
    groups fit the session's shuffle partitions; counts per sub-range, at most
    shards times sub-ranges of them, are broadcast and give where each starts.
    Texts aren't shuffled: 40 bytes a row are.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("bigint") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = rows.withColumns({"shard": draw(F.col("key"), tree), "grown_shard": draw(F.col("key"), grown) if grown else F.lit(None).cast("int"), "place": F.conv(F.substring(F.md5(F.concat_ws("/", F.lit("slot"), "key", F.col("size").cast("string"), F.col("text_crc32").cast("string"))), 1, 13), 16, 10).cast("bigint")})
    leaves = max(1, int(tree.weight))
    parts = 1 << max(2, math.ceil(math.log2(4 * int(spark.conf.get("spark.sql.shuffle.partitions")) / leaves + 1)))
    rows = rows.withColumn("sub", F.shiftright("place", 52 - int(math.log2(parts))).cast("int")).drop("key")
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("times"))
    # Counted where the rows are, then added up along each shard.
    before = rows.groupBy("shard", "sub").agg(F.count("*").alias("n"))
    before = before.withColumn("start", F.sum("n").over(Window.partitionBy("shard").orderBy("sub")) - F.col("n")).drop("n")
    within = F.sum("times").over(Window.partitionBy("shard", "sub").orderBy("place", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)) - F.col("times")
    slots = alike.withColumn("within", within).join(F.broadcast(before), ["shard", "sub"]).withColumn("first", F.col("start") + F.col("within"))
    # So many at once that no array of numbers is large.
    many = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1, F.lit(LOT).cast("bigint")))
    slots = slots.withColumn("lot", many).withColumn("at", F.explode(F.sequence("lot", F.least(F.col("times"), F.col("lot") + LOT) - 1)))
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("at")).cast("bigint").alias("slot"), "grown_shard")
