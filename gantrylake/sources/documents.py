"""JSON inputs: nested documents and id dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gantrylake.schemas import DIMENSION_ATTRIBUTES, KNOWLEDGE_SCHEMA


def read_knowledge(spark: SparkSession, path: str) -> DataFrame:
    """One row per knowledge document, chunks as an array of structs."""
    return spark.read.schema(KNOWLEDGE_SCHEMA).option("multiLine", "true").json(path)


def dictionary_rows(documents: DataFrame, column: str = "value", key: str = "gantry_id") -> DataFrame:
    """A JSON object ``id → attributes`` as one row per id; keys that open with ``_`` are metadata."""
    entries = F.from_json(F.col(column), T.MapType(T.StringType(), DIMENSION_ATTRIBUTES))
    rows = documents.select(F.explode(entries).alias(key, "attributes"))
    return rows.where(~F.col(key).startswith("_")).select(key, "attributes.*")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return dictionary_rows(spark.read.text(path, wholetext=True))


def json_number(document: Column, field: str) -> Column:
    """One numeric field of a flat JSON object, NULL where it is absent or malformed."""
    return F.from_json(document, f"`{field}` bigint").getField(field)
