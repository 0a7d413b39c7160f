"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantrylake.llm.oracle import SQL  # noqa: F401  the queries' SQL, for whoever registers them

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf, "documents"), tokenizer_path())


@query
def op8_pack_windows(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.packing import pack_documents

    pieces = pack_documents(table(spark, sf, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_contamination(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.decontaminate import contamination, hit_words

    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op10_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.parity_join import near_duplicates

    return near_duplicates(table(spark, sf, "documents"))


@query
def op6_remove_repeats(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.decontaminate import hit_words
    from gantrylake.llm.suffix_dedup import remove_repeats

    cut = remove_repeats(table(spark, sf, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        hit_words().alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op1_quality_grades(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.quality import fit_quality, grade_quality

    docs = table(spark, sf, "documents")
    return grade_quality(docs, fit_quality(docs, table(spark, sf, "labels")))


@query
def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.divergence import language_references, quality_rules

    docs = table(spark, sf, "documents")
    return quality_rules(docs, language_references(docs, "lang", "text"))


def remainder(divisor: int) -> F.Column:
    """The fold of a document: its id's checksum, by a divisor; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


@query
def op3_word_languages(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.language import identify, learn_languages

    docs = table(spark, sf, "documents")
    found = identify(docs, learn_languages(docs, remainder(3) != 1))
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.toxicity import learn_toxicity, score_toxicity

    docs = table(spark, sf, "documents")
    model = learn_toxicity(docs, table(spark, sf, "labels"), remainder(5) != 0)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


@query
def op2_licences(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.licences import fit_licences, scan_licences

    docs = table(spark, sf, "documents")
    return scan_licences(docs, fit_licences(docs))


@query
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.filter_audit import audit_filters

    return audit_filters(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_manifest(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.manifest import merkle_manifest

    return merkle_manifest(table(spark, sf, "documents"))


@query
def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    from gantrylake.llm.personal import KINDS, count_of, find_personal, shown

    found = find_personal(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        *[count_of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
