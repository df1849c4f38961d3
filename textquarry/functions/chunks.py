"""Splitting of long texts at a separator, with overlap."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def split_chunks(text: str, size: int, overlap: int, separator: str = ".") -> list[str]:
    """Pieces between separators packed into chunks of at most ``size`` characters.

    A chunk starts with the last pieces of the one before it, as many as have
    at most ``overlap`` characters and leave room for the next piece. A piece
    longer than ``size`` is a chunk by itself. Chunks are trimmed; blank ones
    are left out.
    """
    out: list[str] = []
    held: list[str] = []
    total, gap = 0, len(separator)

    def close() -> None:
        chunk = separator.join(held).strip()
        if chunk:
            out.append(chunk)

    for piece in filter(None, text.split(separator)):
        if held and total + len(piece) + gap > size:
            close()
            while total > overlap or total and total + len(piece) + gap > size:
                total -= len(held.pop(0)) + (gap if held else 0)
        total += len(piece) + (gap if held else 0)
        held.append(piece)
    close()
    return out


def chunk(text: Column, size: int = 30_000, overlap: int = 100, separator: str = ".") -> Column:
    """array<string> of the chunks; null has none. In Python: packing depends on all pieces before."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[] if t is None else split_chunks(t, size, overlap, separator) for t in texts], dtype=object)

    return run(text)
