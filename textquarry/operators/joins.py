"""Joins by key, by other keys, by hash, and by fuzzy name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions.similarity import ratio, token_sort


#: Scores from which names meet on a piece that they share; below, on one of their rarer characters. No result depends on it.
PIECES_FROM = 85
#: Characters from rare to frequent; any order is right, this one makes few names meet.
RARE = "zqxjkvbpygfwmucldhrsnioate "


def left_join_new_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that takes only those columns of the right side that the left lacks."""
    return left.join(right.select(key, *[c for c in right.columns if c not in left.columns]), key, "left")


def left_join_suffixed(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left join that keeps columns of one name from both sides, with suffixes."""
    both = {c for c in left.columns if c in right.columns and c != key}
    named = lambda df, end: df.select(*[F.col(c).alias(c + end if c in both else c) for c in df.columns])
    return named(left, suffixes[0]).join(named(right, suffixes[1]), key, "left")


def left_join_on(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Left join on keys of different names; both stay."""
    return left.join(right, left[left_on] == right[right_on], "left")


def semi_join(parents: DataFrame, children: DataFrame, key: str = "id") -> DataFrame:
    return parents.join(children.select(key), key, "left_semi")


def unprocessed(texts: DataFrame, done: DataFrame, hash_col: str = "hash", name_col: str = "file_name") -> DataFrame:
    """One row, the first by name, for each hash that isn't in done."""
    first = texts.groupBy(hash_col).agg(F.min_by(F.struct(*[c for c in texts.columns if c != hash_col]), name_col).alias("first"))
    return first.select(hash_col, "first.*").select(*texts.columns).join(done.select(hash_col), hash_col, "left_anti")


def upsert(table: DataFrame, rows: DataFrame, key: str, latest: str | None = None) -> DataFrame:
    """table without the keys of rows, and rows; columns that one side lacks are null.

    Of several new rows of one key, the one with the greatest ``latest``
    stays, then the one with the greatest JSON.
    """
    whole = F.struct(*rows.columns)
    order = F.struct(*([latest] if latest else []), F.to_json(whole))
    one = rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(whole, order).alias("__one")).select("__one.*")
    return table.join(rows.select(key), key, "left_anti").unionByName(one, allowMissingColumns=True)


def fuzzy_best(left: DataFrame, right: DataFrame, left_on: str, right_on: str, least: int = 95) -> DataFrame:
    """(left_on, match, score) of each distinct left name: its best right name by token-sort ratio, null below ``least``.

    Names equal once sorted meet in a hash join. For the others, a score of
    ``least`` bounds the characters that may be inserted and deleted, and so
    the other name's length. A name cut into one piece more than that has a
    piece that no change touches, which stands in the other name, shifted by
    no more than the bound (Li et al., 2011): names meet on pieces, no pair
    of ``least`` or more is lost, and only those that meet are scored. Of
    equal scores the first right name wins.
    """
    r = (least - 0.5) / 100
    if r <= 0:
        raise ValueError("least must be 1 or more")
    names = left.select(left_on).where(F.col(left_on).isNotNull()).distinct().withColumn("__a", token_sort(F.col(left_on)))
    choices = right.select(F.col(right_on).alias("match")).where(F.col(right_on).isNotNull()).distinct().withColumn("__b", token_sort(F.col("match")))
    exact = names.join(choices, F.col("__a") == F.col("__b")).groupBy(left_on).agg(F.min("match").alias("match")).withColumn("score", F.lit(100))
    rest = names.join(exact.select(left_on), left_on, "left_anti")

    longest = (2 - r) / r
    changes = lambda n: F.floor(F.lit(2 * (1 - r) / r) * n + F.lit(1e-9)).cast("int")  # noqa: E731  of a name of length n and the longest that can reach it
    edge = lambda n, i: F.floor(i * n / (changes(n) + 1)).cast("int")  # noqa: E731  where piece i begins
    piece = lambda text, n, i, shift: F.struct(n.alias("n"), i.alias("i"), F.substring(text, edge(n, i) + shift + 1, edge(n, i + 1) - edge(n, i)).alias("s"))
    whole = F.length("__a")
    pieces = F.transform(F.sequence(F.lit(0), changes(whole)), lambda i: piece(F.col("__a"), whole, i, F.lit(0)))
    size = F.length("__b")
    lengths = F.sequence(F.ceil(size / F.lit(longest) - F.lit(1e-9)).cast("int"), F.floor(size * F.lit(longest) + F.lit(1e-9)).cast("int"))
    # Shifts that would begin before the text or end after it give pieces that are too short, which meet nothing.
    fits = lambda n, i, shift: (edge(n, i) + shift >= 0) & (edge(n, i + 1) + shift <= size)
    sought = F.flatten(F.transform(lengths, lambda n: F.flatten(F.transform(F.sequence(F.lit(0), changes(n)), lambda i: F.transform(F.filter(F.sequence(-changes(n), changes(n)), lambda d: fits(n, i, d)), lambda d: piece(F.col("__b"), n, i, d))))))
    if least < PIECES_FROM:  # so many changes leave pieces of a character or none
        pieces, sought = _rare(F.col("__a"), r), _rare(F.col("__b"), r)
    meet = rest.select(left_on, "__a", F.explode(pieces).alias("__p")).join(choices.select("match", "__b", F.explode(F.array_distinct(sought)).alias("__p")), "__p")
    pairs = meet.select(left_on, "__a", "match", "__b").distinct().where(2 * F.least(F.length("__a"), F.length("__b")) >= r * (F.length("__a") + F.length("__b")))
    scored = pairs.withColumn("score", ratio(F.col("__a"), F.col("__b"))).where(F.col("score") >= least)
    best = scored.groupBy(left_on).agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("match"))).alias("best")).select(left_on, "best.match", (-F.col("best.minus")).alias("score"))
    return names.select(left_on).join(exact.unionByName(best), left_on, "left")


def _rare(name: Column, r: float) -> Column:
    """The name's first characters from rare to frequent, each with its number among equals; names of a score of r share one.

    A name of length n has at least n * r / (2 - r) characters in common with
    any that reaches the score, so of all but as many and one, one is common
    if both sides take theirs in one order (prefix filtering).
    """
    order = F.transform(F.array_remove(F.split(name, ""), ""), lambda c: F.struct(F.instr(F.lit(RARE), c).alias("at"), c.alias("c")))
    found = F.array_sort(order)
    numbered = F.transform(found, lambda x, k: F.struct(F.lit(0).alias("n"), (k - F.array_position(found, x)).cast("int").alias("i"), x["c"].alias("s")))
    return F.slice(numbered, F.lit(1), F.length(name) - F.ceil(F.length(name) * F.lit(r / (2 - r)) - F.lit(1e-9)).cast("int") + 1)


def fuzzy_left_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, least: int = 95) -> DataFrame:
    """left with name_match, the best right name, and that row's other columns."""
    found = fuzzy_best(left, right, left_on, right_on, least).select(left_on, F.col("match").alias("name_match"))
    return left.join(found, left_on, "left").join(right.withColumnRenamed(right_on, "name_match"), "name_match", "left")
