"""From raw documents to packed sequences: the stages in order, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.llm.decontaminate import contamination
from gantrylake.llm.packing import pack_documents
from gantrylake.llm.parity_join import near_duplicates
from gantrylake.llm.quality import fit_quality, grade_quality
from gantrylake.llm.queries import tokenizer_path
from gantrylake.llm.rows import quoted
from gantrylake.llm.suffix_dedup import remove_repeats
from gantrylake.session import fresh_path
from gantrylake.sinks.lake import drop_folder


def own(docs: DataFrame) -> list[Column]:
    """The columns of documents, whatever their names."""
    return [quoted(name) for name in docs.columns]


def bundled(docs: DataFrame) -> DataFrame:
    """``text`` beside ``_row``, which holds all columns, so that none clashes with an operator's."""
    return docs.select(F.struct(*own(docs)).alias("_row"), "text")


def unbundled(frame: DataFrame, docs: DataFrame, **new: Column) -> DataFrame:
    """The columns of documents as they were, or as given anew."""
    return frame.select(*[new.get(name, F.col("_row").getField(name)).alias(name) for name in docs.columns])


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the graded ones among them, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels)
    return unbundled(grade_quality(bundled(docs), model, carry=["_row"], rejected=False), docs)


def row_key(docs: DataFrame) -> Column:
    """What tells rows apart, least ids first and rows without an id last: the id and a digest of the text."""
    kind = docs.schema["doc_id"].dataType
    known = F.coalesce(F.col("doc_id"), F.lit(0).cast(kind))
    digest = F.coalesce(F.unhex(F.sha2(F.col("text").cast("string"), 256)), F.lit(b""))
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), known.alias("id"), digest.alias("text"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the row with the least id; one without an id at need.

    Rows are told apart by id and text, so rows under one id are compared like any others; equal rows are one.
    """
    keyed = docs.select(row_key(docs).alias("doc_id"), "text")
    found = near_duplicates(keyed, width=5, percent=80)
    chosen = found.where("doc_id = component_id").select(F.col("doc_id").alias("_key")).distinct()
    kept = docs.withColumn("_key", row_key(docs)).join(chosen, "_key", "left_semi")
    return kept.dropDuplicates(["_key"]).select(own(docs))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings that start elsewhere too; their length is counted anew."""
    cut = remove_repeats(bundled(docs), carry=["_row"], as_text=True)
    return unbundled(cut, docs, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return unbundled(contamination(bundled(docs), items, carry=["_row"]).where(F.size("spans") == 0), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document kept so far, as pieces of fixed windows."""
    return pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", accept),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", clean_of_benchmark),
    ("packing", pack),
]

#: Trained models, digests of token ids and byte spans have no SQL form; the tests hold brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = None
    for name, stage in STAGES:
        folder = fresh_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if done:
            drop_folder(spark, done)  # the next stage's input is all that is still needed
        done = folder
    return docs
