"""Texts that keep arriving: each new one is hashed, skipped if known, and appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textquarry.functions.text import text_hash
from textquarry.operators.joins import unprocessed
from textquarry.sources.files import exists


def follow_folder(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """A stream of (file_name, text) of the files that appear in a folder."""
    return spark.readStream.format("text").schema("value string").option("wholetext", True).option("pathGlobFilter", pattern).load(folder).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def append_new(texts: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends (hash, file_name, text) of texts not yet in ``target`` (Parquet), batch by batch; ends when all that is there is done."""

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        schema = "hash string, file_name string, text string, batch bigint"
        # A batch that runs again after a failure replaces what it had written.
        known = spark.read.schema(schema).option("basePath", target).parquet(target).where(F.col("batch") != number) if exists(spark, target) else spark.createDataFrame([], schema)
        unprocessed(batch.withColumn("hash", text_hash(F.col("text"))), known).select("hash", "file_name", "text").write.mode("overwrite").parquet(f"{target}/batch={number}")

    return texts.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
