"""Fuzzy string similarity as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_sort(name: Column) -> Column:
    """Lower-cased words in order, joined by blanks."""
    bare = F.trim(F.lower(F.regexp_replace(name, r"(?U)[^\w]+", " ")))
    return F.array_join(F.array_sort(F.split(bare, " ")), " ")


#: Characters up to which a text's positions are the bits of a number, with room for a sum.
BITS = 62


def _characters(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")


def _lcs_by_bits(a: Column, b: Column) -> Column:
    """For b of at most BITS characters: a bit for each of its positions, cleared where the subsequence grows (Hyyro, 2004)."""
    n, zero = F.length(b), F.lit(0).cast("bigint")
    bit = lambda j: F.call_function("shiftleft", F.lit(1).cast("bigint"), j)
    where = lambda c: F.aggregate(F.transform(_characters(b), lambda x, j: F.when(x == c, bit(j)).otherwise(zero)), zero, lambda m, x: m.bitwiseOR(x))
    step = lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v - v.bitwiseAND(m)).bitwiseAND(bit(n) - 1)
    return n - F.bit_count(F.aggregate(F.transform(_characters(a), where), bit(n) - 1, step))


def _lcs_by_rows(a: Column, b: Column) -> Column:
    n = F.length(b)

    def row(before: Column, c: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            same = F.substring(b, j, F.lit(1)) == c
            return F.array_append(done, F.when(same, F.get(before, j - 1) + 1).otherwise(F.greatest(F.get(before, j), F.get(done, j - 1))))

        return F.aggregate(F.sequence(F.lit(1), n), F.array(F.lit(0)), cell)

    return F.element_at(F.aggregate(_characters(a), F.array_repeat(F.lit(0), n + 1), row), -1)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence; by bits if one of the two is short."""
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).when(F.length(b) <= BITS, _lcs_by_bits(a, b)).when(F.length(a) <= BITS, _lcs_by_bits(b, a)).otherwise(_lcs_by_rows(a, b)).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """100 * 2 * LCS / (lengths), rounded; two empty texts are equal."""
    both = F.length(a) + F.length(b)
    return F.when(a == b, 100).otherwise(F.round(100.0 * 2 * lcs_length(a, b) / F.greatest(both, F.lit(1)))).cast("int")


def cosine(a: Column, b: Column) -> Column:
    """Of two vectors; null if one of them is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
