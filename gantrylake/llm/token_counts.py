"""Token counts through a cache keyed by content digest and tokenizer version."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.llm.arrays import blocks
from gantrylake.llm.bpe import encoder, version_digest
from gantrylake.session import fresh_path

CACHED = "digest binary, n_tokens long"


def normalised(text_col: str) -> F.Column:
    """The content that is digested and encoded: the text itself, NULL as empty.

    Counts are of exact texts, so nothing is folded that a tokenizer could tell apart.
    """
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Counts in the cache for one tokenizer version, a row per digest; None before its first write."""
    folder = f"{cache}/version={version}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    # Two runs may both have appended a digest.
    # The second key keeps the join on the digest behind a shuffle of its own, which Spark can split where it is hot.
    groups = spark.read.schema(CACHED).parquet(folder).groupBy("digest", F.crc32("digest")).agg(F.max("n_tokens").alias("n_tokens"))
    return groups.select("digest", "n_tokens")


def count_tokens(
    docs: DataFrame, path: str, cache: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` for every row.

    Looks each text's digest up in ``cache`` (a folder all executors share; a fresh one if not given), encodes
    every distinct missing text once, appends its count, then joins rows with counts by digest. Copies
    are combined before the shuffle, and texts move once; a hot digest holds small rows in the last join,
    which Spark may split. A NULL text counts as empty (0 tokens); repeated rows stay; an empty table
    gives no rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    version = version_digest(path)
    cache = cache or fresh_path(spark, "token-cache")
    content = normalised(text_col)
    digest = F.unhex(F.sha2(content, 256))
    known = stored_counts(spark, cache, version)
    missing = docs.select(digest.alias("digest"), content.alias("text")).distinct()
    if known is not None:
        missing = missing.join(known, "digest", "left_anti")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in blocks(batch):
                counts = encoder(path).counts(rows.column("text").to_pylist())
                yield pa.record_batch([rows.column("digest"), pa.array(counts)], ["digest", "n_tokens"])

    missing.mapInArrow(encoded, CACHED).write.mode("append").parquet(f"{cache}/version={version}")
    counts = stored_counts(spark, cache, version)
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"), F.octet_length(content).cast("long").alias("n_bytes"))
    joined = rows.join(counts, "digest", "left")
    return joined.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
