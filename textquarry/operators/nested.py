"""Splitting records with nested columns into a flat parent and child tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, StringType, StructType


def flat_fields(kind: StructType, at: str, prefix: str = "") -> list[Column]:
    """Leaves of a struct column, named by their path below it, joined by _."""
    out: list[Column] = []
    for f in kind:
        where, name = f"{at}.`{f.name}`", prefix + f.name
        out += flat_fields(f.dataType, where, f"{name}_") if isinstance(f.dataType, StructType) else [F.col(where).alias(name)]
    return out


def explode_strings(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """(key, column) for each element that isn't null."""
    return df.select(key, F.explode(column).alias(column)).where(F.col(column).isNotNull())


def flatten_struct(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """(key, leaves); rows of which all leaves are null are dropped."""
    leaves = flat_fields(df.schema[column].dataType, f"`{column}`")
    out = df.select(key, *leaves)
    return out.where(F.coalesce(*[F.lit(None).cast("boolean"), *[F.when(F.col(f"`{c}`").isNotNull(), True) for c in out.columns[1:]]], F.lit(False)))


def explode_structs(df: DataFrame, column: str, key: str = "id") -> DataFrame:
    """(key, leaves) for each element; elements of which all leaves are null are dropped."""
    return flatten_struct(df.select(key, F.explode(column).alias(column)), column, key)


def split_explode(df: DataFrame, column: str, separator: str, key: str = "id") -> DataFrame:
    """(key, part) for each part between separators, not trimmed; null has none."""
    return df.select(key, F.explode(F.split(column, "\\Q" + separator + "\\E", -1)).alias(column))


@dataclass
class SplitResult:
    simple: DataFrame
    children: dict[str, DataFrame] = field(default_factory=dict)


def kind_of(kind: DataType, separator: str | None) -> str:
    if isinstance(kind, AtomicType):
        return "split" if separator is not None else "simple"
    if isinstance(kind, ArrayType):
        return "strings" if isinstance(kind.elementType, StringType) else "structs" if isinstance(kind.elementType, StructType) else "other"
    return "struct" if isinstance(kind, StructType) else "other"


def split_record(df: DataFrame, key: str = "id", separators: dict[str, str] | None = None) -> SplitResult:
    """The flat columns of df, and a child table for each nested or configured one; told by the schema alone."""
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    separators, simple, out = separators or {}, [], SplitResult(df)
    for f in df.schema:
        kind = kind_of(f.dataType, separators.get(f.name))
        if f.name == key or kind == "simple":
            simple.append(f.name)
        elif kind == "split":
            out.children[f.name] = split_explode(df, f.name, separators[f.name], key)
        elif kind == "strings":
            out.children[f.name] = explode_strings(df, f.name, key)
        elif kind == "structs":
            out.children[f.name] = explode_structs(df, f.name, key)
        elif kind == "struct":
            out.children[f.name] = flatten_struct(df, f.name, key)
        else:
            out.children[f.name] = df.select(key, f.name)
    out.simple = df.select(*simple)
    return out


def prune_nulls_json(value: Column) -> Column:
    """JSON without null fields; nulls inside arrays and structs that end up empty stay."""
    return F.to_json(value)


def full_json(value: Column, pretty: bool = False) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false", "pretty": str(pretty).lower()})
