"""Nested records: split, flatten, JSON, and the whole transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry import schemas
from textquarry.operators import nested, topics
from textquarry.plans.registry import query
from textquarry.session import table


def entities(spark: SparkSession, d: str) -> DataFrame:
    """A nested record for each customer: tags, orders as events, contact with a place in it."""
    orders = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"), F.struct(F.col("o_totalprice").alias("amount")).alias("price")))).alias("events"))
    both = table(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return both.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat_ws(",", "c_mktsegment", F.col("c_nationkey").cast("string"), F.lit("")).alias("functions"),
        F.when(F.col("c_custkey") % 5 != 0, F.array(F.col("c_mktsegment"), F.lit(None).cast("string"), F.lit("x"))).alias("objectives"), "events",
        F.when(F.col("c_custkey") % 7 != 0, F.struct(F.col("c_name").alias("email"), F.struct(F.col("c_nationkey").alias("nation")).alias("place"))).alias("contact"),
        F.array(F.col("c_nationkey")).alias("numbers"),
    )


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def split_simple(spark: SparkSession, d: str) -> DataFrame:
    return nested.split_record(entities(spark, d), "id", {"functions": ","}).simple


def _child(spark: SparkSession, d: str, name: str) -> DataFrame:
    return nested.split_record(entities(spark, d), "id", {"functions": ","}).children[name]


@query("SELECT c_custkey AS id, unnest([c_mktsegment, 'x']) AS objectives FROM customer WHERE c_custkey % 5 <> 0")
def explode_strings(spark: SparkSession, d: str) -> DataFrame:
    return _child(spark, d, "objectives")


@query("SELECT o_custkey AS id, o_orderkey AS key, o_orderpriority AS priority, o_totalprice AS price_amount FROM orders JOIN customer ON o_custkey = c_custkey")
def explode_structs(spark: SparkSession, d: str) -> DataFrame:
    return _child(spark, d, "events")


@query("SELECT c_custkey AS id, c_name AS email, c_nationkey AS place_nation FROM customer WHERE c_custkey % 7 <> 0")
def struct_flatten(spark: SparkSession, d: str) -> DataFrame:
    return _child(spark, d, "contact")


@query("SELECT c_custkey AS id, unnest([c_mktsegment, c_nationkey::VARCHAR, '']) AS functions FROM customer")
def split_explode(spark: SparkSession, d: str) -> DataFrame:
    return _child(spark, d, "functions")


@query("SELECT c_custkey AS id, c_nationkey::VARCHAR AS numbers FROM customer")
def split_other(spark: SparkSession, d: str) -> DataFrame:
    return _child(spark, d, "numbers").select("id", F.concat_ws(",", F.transform("numbers", lambda x: x.cast("string"))).alias("numbers"))


@query("""SELECT event_id, '{' || CASE WHEN event_id % 2 = 0 THEN '"a":' || user_id || ',' ELSE '' END || '"b":[{}]}' AS json FROM events""")
def prune_nulls_json(spark: SparkSession, d: str) -> DataFrame:
    made = F.struct(F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("a"), F.array(F.struct(F.lit(None).cast("string").alias("c"))).alias("b"))
    return table(spark, d, "events").select("event_id", nested.prune_nulls_json(made).alias("json"))


#: Fixed value: the record with nothing in it.
_GOLDEN = '{"association_name":null,"objectives":[],"activities":[],"offers":[],"member_statuses":[],"contact":{"email":null},"communication":{"facebook_likes":null,"facebook_follower":null,"instagram_publication":null,"instagram_followers":null},"hash":null,"text_name":null}'


@query(f"SELECT c_custkey AS id, '{_GOLDEN}' AS json FROM customer")
def entity_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), nested.full_json(F.expr(schemas.default_entity_json())).alias("json"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_parse(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT", {"mode": "PERMISSIVE"})["k"].alias("k"))


@query()
def transform_entry(spark: SparkSession, d: str) -> DataFrame:
    """Split, and topics for the texts of a child table: k-means has no SQL."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.struct(F.col("text").alias("description")).alias("about"))
    child = nested.split_record(rows).children["about"]
    return topics.annotate(child, "description", ["the", "and", "of"], k=4).select("id", "description_topic", "description_topic_label", "description_topic_count")
