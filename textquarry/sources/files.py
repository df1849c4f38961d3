"""Folders of texts, CSV, bytes, and the tables written from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textquarry.functions.encoding import decode_any


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(file_name, text) of the files of a folder; pattern '*' for all of them."""
    return spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def read_bytes(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(file_name, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select(F.col("_metadata.file_name").alias("file_name"), "content")


def read_texts_any_encoding(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """As read_texts, files that aren't UTF-8 taken as ISO-8859-1."""
    return read_bytes(spark, folder, pattern).select("file_name", decode_any(F.col("content")).alias("text"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, separator: str = ";") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=separator, header=True)


def records(spark: SparkSession, rows: list[dict], schema: StructType | str) -> DataFrame:
    """Rows given as dicts; missing keys are null. The schema is explicit: columns of nulls have no type to infer."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in struct) for r in rows], struct)


def write_texts(texts: DataFrame, folder: str) -> None:
    """(file_name, text) as Parquet, replacing what is there."""
    texts.select("file_name", "text").write.mode("overwrite").parquet(folder)


def write_tables(simple: DataFrame, children: dict[str, DataFrame], folder: str) -> None:
    """The parent table and a table for each child."""
    simple.write.mode("overwrite").parquet(f"{folder}/simple")
    for name, child in children.items():
        child.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").csv(path, sep=separator, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """Nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_prompt(spark: SparkSession, path: str, **values: str) -> str:
    """One small text file, with {name} replaced by values."""
    text = spark.read.text(path, wholetext=True).first()[0]
    for name, value in values.items():
        text = text.replace("{" + name + "}", value)
    return text


def write_prompt(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small text file."""
    with_file(spark, path, text.encode())


def placeholders(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Empty files, there from now on; those that exist are emptied."""
    for name in names:
        with_file(spark, f"{folder}/{name}", b"")


def with_file(spark: SparkSession, path: str, data: bytes) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file, or a folder with something in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and len(fs.listStatus(at)) > 0
