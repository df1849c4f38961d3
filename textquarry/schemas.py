"""The entity record, current and former."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Names and types of the record's fields.
ENTITY = """association_name STRING, objectives ARRAY<STRING>,
events ARRAY<STRUCT<name:STRING,price:BIGINT,nb_participants:BIGINT,date:STRING,description:STRING,music_type:STRING>>,
offers ARRAY<STRUCT<name:STRING,description:STRING,target_group:STRING,price:BIGINT>>,
member_statuses ARRAY<STRUCT<status:STRING,description:STRING,price:BIGINT>>,
neologisms ARRAY<STRUCT<name:STRING,interpretation:STRING,components:ARRAY<STRING>>>,
contact STRUCT<email:STRING>,
communication STRUCT<facebook_likes:BIGINT,facebook_follower:BIGINT,instagram_publication:BIGINT,instagram_followers:BIGINT>,
hash STRING, file_name STRING"""
#: Fixed values, as above.
FORMER_ENTITY = """association_name STRING, objectives ARRAY<STRING>,
activities ARRAY<STRUCT<name:STRING,price:BIGINT>>,
offers ARRAY<STRUCT<name:STRING,description:STRING,target_group:STRING,price:BIGINT>>,
member_statuses ARRAY<STRUCT<status:STRING,description:STRING,price:BIGINT>>,
contact STRUCT<email:STRING>,
communication STRUCT<facebook_likes:BIGINT,facebook_follower:BIGINT,instagram_publication:BIGINT,instagram_followers:BIGINT>,
hash STRING, text_name STRING"""


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def empty(spark: SparkSession, ddl: str = ENTITY) -> DataFrame:
    return spark.createDataFrame([], struct_of(ddl))


def upgrade(former: DataFrame) -> DataFrame:
    """Records of the former schema in the current one; activities stay as an extra column."""
    now = struct_of(ENTITY)
    return former.withColumnRenamed("text_name", "file_name").withColumns({c: F.lit(None).cast(now[c].dataType) for c in ("events", "neologisms")})


def default_entity_json(ddl: str = FORMER_ENTITY) -> str:
    """SQL of the record with nothing in it: nulls, empty arrays, structs of nulls."""
    fields = []
    for f in struct_of(ddl):
        kind = f.dataType.typeName()
        value = f"CAST(array() AS {f.dataType.simpleString()})" if kind == "array" else "named_struct(" + ", ".join(f"'{g.name}', CAST(NULL AS {g.dataType.simpleString()})" for g in f.dataType) + ")" if kind == "struct" else f"CAST(NULL AS {f.dataType.simpleString()})"
        fields.append(f"'{f.name}', {value}")
    return "named_struct(" + ", ".join(fields) + ")"
