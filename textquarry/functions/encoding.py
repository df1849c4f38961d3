"""Bytes to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def detect_encoding(data: Column) -> Column:
    """'UTF-8' if the bytes are valid, else 'ISO-8859-1'."""
    return F.when(F.is_valid_utf8(data.cast("string")), "UTF-8").otherwise("ISO-8859-1")


def repair_utf8(data: Column) -> Column:
    """Decoded with invalid bytes left out (and U+FFFD, which marks them)."""
    return F.replace(F.make_valid_utf8(data.cast("string")), F.lit("�"), F.lit(""))


def latin1(data: Column) -> Column:
    return F.decode(data, "ISO-8859-1")


def decode_any(data: Column) -> Column:
    return F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).otherwise(latin1(data))
