"""Dates in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy-MM")


def parse_date(text: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def month(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")
