"""The whole way: folders of texts to entity tables with topics."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry import schemas
from textquarry.operators import topics
from textquarry.operators.extract import Extractor, analyse, rule_extractor
from textquarry.operators.joins import fuzzy_left_join, left_join_new_columns
from textquarry.operators.nested import SplitResult, split_record
from textquarry.operators.profile import with_row_id
from textquarry.sources.files import read_texts


log = logging.getLogger(__name__)

#: Subject of a report: child table, label column, representation column, text column. Fixed values.
SUBJECTS = {
    "objectifs": ("objectives", "objectives_topic_label", "objectives_topic_representation", "objectives"),
    "offres": ("offers", "description_topic_label", "description_topic_representation", "description"),
    "évènements": ("events", None, None, None),
}


def subject(out: SplitResult, name: str) -> DataFrame:
    """A subject's rows: id, label, representation and text; what the subject has no column for is left out."""
    child, *columns = SUBJECTS[name]
    table = out.children[child]
    return table.select("id", *[c for c in columns if c in table.columns]) if any(columns) else table


def run(spark: SparkSession, folders: list[str], directory: DataFrame, extract: Extractor = rule_extractor, done: DataFrame | None = None, separators: dict[str, str] | None = None, stop: list[str] | None = None, with_topics: bool = True) -> SplitResult:
    """Texts to records, joined to the directory by file_name, numbered, split, and annotated with topics.

    Nothing runs before a result is written, but the topics' gates and models.
    """
    done = schemas.empty(spark) if done is None else done
    log.info("texts of %s", ", ".join(folders))
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [analyse(read_texts(spark, f, "*"), done, extract) for f in folders])
    raw = with_row_id(left_join_new_columns(directory, found.unionByName(done, allowMissingColumns=True), "file_name"), "file_name")
    out = split_record(raw, "id", separators)
    log.info("child tables: %s", ", ".join(out.children))
    if with_topics:
        out.children = {name: topics.annotate_texts(child, stop or []) for name, child in out.children.items()}
    return out


def count_declarations(tickets: DataFrame, name_col: str, date_col: str, first: str, last: str, count_col: str = "nb_events") -> DataFrame:
    """(name, count) of the declarations from first to last, both included."""
    within = tickets.where((F.col(date_col) >= F.lit(first).cast("timestamp_ntz")) & (F.col(date_col) <= F.lit(last).cast("timestamp_ntz")))
    return within.where(F.col(name_col).isNotNull()).groupBy(name_col).agg(F.count("*").alias(count_col))


def enrich(simple: DataFrame, counts: DataFrame, left_on: str = "name", right_on: str = "declarant_nom_usuel", least: int = 95) -> DataFrame:
    """Parents with the counts of the name that matches best."""
    return fuzzy_left_join(simple, counts, left_on, right_on, least)
