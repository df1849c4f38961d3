"""Topics of a text column: gate, corpus, clusters, words and labels."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from textquarry.functions.similarity import cosine
from textquarry.functions.text import render, tokens, without_stopwords


class TooManyColumnsError(ValueError):
    """More than an id and one column."""


class NotAllStringsError(ValueError):
    """The column isn't text throughout."""


def is_heterogeneous(df: DataFrame, column: str, most: float = 0.9) -> bool:
    """Whether over ``most`` of the column's values are distinct; no for empty columns."""
    if len(df.columns) > 2:
        raise TooManyColumnsError(df.columns)
    if not isinstance(df.schema[column].dataType, StringType):
        raise NotAllStringsError(column)
    n, distinct = df.agg(F.count(column), F.countDistinct(column)).first()
    return n > 0 and distinct / n > most


def corpus_text(text: Column, stop: list[str]) -> Column:
    """Lower-cased, without stop words."""
    return F.lower(F.array_join(without_stopwords(tokens(text.cast("string")), stop), " "))


def class_words(df: DataFrame, topic: str, text: str, top: int = 10) -> DataFrame:
    """(topic, rank, word, weight): words of most weight in each topic by class-based TF-IDF.

    weight = tf * ln(1 + A / f): tf the word's count in the topic, f in all
    topics, A the mean number of words of a topic (Grootendorst, 2022).
    """
    counts = df.select(topic, F.explode(tokens(F.lower(text))).alias("word")).groupBy(topic, "word").agg(F.count("*").alias("tf"))
    overall = counts.groupBy("word").agg(F.sum("tf").alias("f"))
    mean = counts.agg(F.sum("tf") / F.countDistinct(topic)).scalar()
    weighed = counts.join(overall, "word").select(topic, "word", F.round(F.col("tf") * F.ln(1 + mean / F.col("f")), 6).alias("weight"))
    rank = F.row_number().over(Window.partitionBy(topic).orderBy(F.desc("weight"), "word"))
    return weighed.withColumn("rank", rank).where(F.col("rank") <= top)


def topic_table(words: DataFrame, topic: str, column: str) -> DataFrame:
    """(topic, <column>_topic_representation, <column>_topic_label): the words in order, and the number with the first four."""
    ordered = words.groupBy(topic).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda r: r["word"]).alias("words"))
    return ordered.select(topic, F.col("words").alias(f"{column}_topic_representation"), F.concat_ws("_", F.col(topic).cast("string"), F.slice("words", 1, 4)).alias(f"{column}_topic_label"))


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(label, centroid): mean vector of each label, by position."""
    parts = df.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda r: r["x"]).alias("centroid"))


def cluster(df: DataFrame, column: str, stop: list[str], k: int | None = None, seed: int = 1, most: int = 50) -> DataFrame:
    """df with <column>_topic: k-means on TF-IDF of the corpus text, with a fixed seed; null texts, which no topic fits, are topic -1.

    Without ``k``, the root of half the texts, ``most`` at most (more clusters
    than a person names). With fewer texts than topics, df as it is.
    """
    n = df.where(F.col(column).isNotNull()).count()
    k = k or max(2, min(most, round(math.sqrt(n / 2))))
    if n < k:
        return df
    words = df.withColumn("__words", F.coalesce(tokens(corpus_text(F.col(column), stop)), F.array().cast("array<string>")))
    counted = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=1 << 14).transform(words)
    weighed = IDF(inputCol="__tf", outputCol="__idf").fit(counted).transform(counted)
    unit = Normalizer(inputCol="__idf", outputCol="features").transform(weighed)
    model = KMeans(k=k, seed=seed, predictionCol="__topic").fit(unit.where(F.col(column).isNotNull()))
    return model.transform(unit).select(*df.columns, F.when(F.col(column).isNotNull(), F.col("__topic")).otherwise(-1).cast("int").alias(f"{column}_topic"))


def representatives(texts: DataFrame, words: DataFrame, topic: str, text: str, top: int = 3) -> DataFrame:
    """texts with ``score`` and ``rank``: the ``top`` texts of each topic that most have the topic's words (topic, word).

    score: tokens that are words of the topic over the root of all tokens. Of
    equals, the first by text and then by the other columns. Only the best of
    a task leave it.
    """
    by_topic = words.groupBy(topic).agg(F.collect_set("word").alias("__words"))
    found = F.filter(tokens(F.lower(F.col(text))), lambda x: x != "")
    scored = texts.join(by_topic, topic).withColumn("score", F.round(F.size(F.filter(found, lambda x: F.array_contains("__words", x))) / F.sqrt(F.greatest(F.size(found), F.lit(1))), 9)).drop("__words")
    order = [F.desc("score"), text, *[c for c in texts.columns if c not in (topic, text)]]
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(topic).orderBy(*order))).where(F.col("rank") <= top)


def rerank_words(words: DataFrame, vectors: DataFrame, centres: DataFrame, topic: str, top: int = 10) -> DataFrame:
    """(topic, rank, word, score): a topic's words (topic, word) by the cosine similarity of their vectors (word, vector) to the topic's (topic, centroid).

    Words without a vector are left out; of equals, the first word.
    """
    scored = words.select(topic, "word").distinct().join(vectors.select("word", "vector"), "word").join(centres.select(topic, "centroid"), topic).select(topic, "word", cosine(F.col("vector"), F.col("centroid")).alias("score"))
    rank = F.row_number().over(Window.partitionBy(topic).orderBy(F.desc("score"), "word"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select(topic, "rank", "word", "score")


def annotate(df: DataFrame, column: str, stop: list[str], k: int | None = None, label=None) -> DataFrame:
    """df with the column's topic, its label, representation, count and representative texts.

    ``label(representation)`` may rename topics, but not topic -1, which has
    no words and no texts. With too few texts for topics, df as it is.
    """
    topic = f"{column}_topic"
    found = cluster(df, column, stop, k)
    if topic not in found.columns:
        return df
    found = found.withColumn("__corpus", corpus_text(F.col(column), stop))
    words = class_words(found.where(F.col(topic) >= 0), topic, "__corpus")
    info = topic_table(words, topic, column)
    if label:
        info = info.withColumn(f"{column}_topic_label", label(F.col(f"{column}_topic_representation")))
    shown = representatives(found.where(F.col(topic) >= 0).select(topic, "__corpus", F.col(column).alias("__text")).distinct(), words, topic, "__corpus")
    shown = shown.groupBy(topic).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "__text"))), lambda r: r["__text"]).alias(f"{column}_Representative_Docs"))
    counts = found.groupBy(topic).agg(F.count("*").alias(f"{column}_topic_count"))
    info = counts.join(info, topic, "left").join(shown, topic, "left")
    return found.drop("__corpus").join(info, topic, "left")


def annotate_texts(df: DataFrame, stop: list[str], key: str = "id") -> DataFrame:
    """Topics for each text column that is heterogeneous or whose name has 'description'; other columns stay as they are."""
    for f in df.schema:
        if f.name != key and isinstance(f.dataType, StringType) and ("description" in f.name or is_heterogeneous(df.select(key, f.name), f.name)):
            df = annotate(df, f.name, stop)
    return df


def naming_prompt(words: Column, template: str) -> Column:
    """The prompt that asks a model to name a topic by its words."""
    return render(template, words=F.array_join(words, ", "))


def nearest(vectors: DataFrame, asked: DataFrame, key: str, vector: str, top: int = 10) -> DataFrame:
    """(query_id, key, score): for each row of ``asked`` the ``top`` other rows of ``vectors`` by cosine similarity; of equals, the lower key first.

    The queries go to each of as many parts as there are shuffle partitions,
    the vectors to one each by a hash of their key. Only the best of a part
    leave it before the last ranking.
    """
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    queries = asked.select(F.col(key).alias("query_id"), F.col(vector).alias("__asked"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("__part"))
    held = vectors.select(key, vector, F.pmod(F.hash(key), F.lit(parts)).alias("__part"))
    scored = held.join(queries, "__part").where(F.col(key) != F.col("query_id")).select("query_id", key, cosine(F.col("__asked"), F.col(vector)).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", key, "score")
