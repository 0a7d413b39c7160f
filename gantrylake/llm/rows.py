"""Rows that travel through a task beside their text, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> F.Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_text(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    """``row`` (a struct of the carried columns) and ``text``."""
    return docs.select(F.struct(*[quoted(name) for name in carry]).alias("row"), quoted(text_col).cast("string").alias("text"))


def result_schema(frame: DataFrame, columns: str) -> T.StructType:
    """``row`` as in the frame, then the given columns."""
    return T.StructType([frame.schema["row"], *T.StructType.fromDDL(columns).fields])


def unpacked(frame: DataFrame, carry: list[str], *columns: str | F.Column) -> DataFrame:
    """The carried columns as they were, then the given ones."""
    return frame.select(*[F.col("row").getField(name).alias(name) for name in carry], *columns)
