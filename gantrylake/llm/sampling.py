"""Bounded samples: few rows and few bytes reach the driver, and no task gathers more than its share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gantrylake.llm.rows import quoted
from gantrylake.llm.scratch import Scratch

#: Bytes of text that a sample holds at most.
SAMPLE_BYTES = 64 << 20


def least_hashes(rows: DataFrame, limit: int, group: str | None, key: list[str], scratch: Scratch) -> DataFrame:
    """(rank, bytes) of at most ``limit`` distinct keys, spread evenly over the groups: those with the least hashes.

    Ranks below a bound are taken, which follows from the number of distinct keys per group; about twice as many as
    wanted pass it, so what is put in order does not grow with the table. Copies have one rank and count once.
    """
    own = F.lit(0) if group is None else quoted(group)
    size = F.lit(0) if "text" not in key else F.octet_length("text")
    ranked = rows.select(own.alias("group"), F.xxhash64(*map(quoted, key)).alias("rank"), size.cast("long").alias("bytes"))
    sizes = ranked.groupBy("group").agg(F.approx_count_distinct("rank").alias("n"))
    sizes = scratch.write(sizes, "sizes")
    share = max(1, limit // max(1, sizes.count()))
    # A rank is a whole number from -2**63 on; its share of the range is even.
    bound = F.least(F.lit(1.0), F.lit(2.0 * share + 64) / F.greatest("n", F.lit(1)))
    passed = ranked.join(sizes, ranked["group"].eqNullSafe(sizes["group"])).where((F.col("rank") / F.lit(2.0**64) + 0.5) <= bound)
    distinct = passed.select(ranked["group"].alias("group"), "rank", "bytes").groupBy("group", "rank").agg(F.max("bytes").alias("bytes"))
    place = F.row_number().over(Window.partitionBy("group").orderBy("rank"))
    return distinct.withColumn("place", place).where(F.col("place") <= share)


def sample_of(rows: DataFrame, limit: int, scratch: Scratch, group: str | None = None, most: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``limit`` different rows, evenly over the values of ``group``, with ``most`` bytes of ``text`` at most.

    Rows are ranked by a hash of all they hold, so one id may hold any share of the table; a group with few rows
    gives all it has. The result reads tables in ``scratch``.
    """
    picked = least_hashes(rows, limit, group, rows.columns, scratch)
    total = F.sum("bytes").over(Window.orderBy("place", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # `limit` rows of numbers, by place so that every group keeps its first ones.
    chosen = scratch.write(picked.withColumn("total", total).where(F.col("total") <= most).select(F.col("rank").alias("_rank")).distinct(), "picked")
    ranked = rows.withColumn("_rank", F.xxhash64(*map(quoted, rows.columns)))
    return ranked.join(F.broadcast(chosen), "_rank", "left_semi").dropDuplicates(["_rank"]).drop("_rank")


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int, scratch: Scratch) -> DataFrame:
    """At most ``limit`` different rows of ``docs`` (id, text and more) with their ``label`` (from ``labels``: id, label).

    Ids are picked from the labels first and broadcast, as many as are wanted at most; then rows among theirs.
    """
    known = labels.where("id is not null and label is not null").select("id", "label")
    picked = least_hashes(known, limit, None, known.columns, scratch).select(F.col("rank").alias("_rank"))
    ids = known.withColumn("_rank", F.xxhash64("id", "label")).join(F.broadcast(picked), "_rank", "left_semi").select("id", "label").distinct()
    ids = scratch.write(ids, "ids")
    return sample_of(docs.where("text is not null").join(F.broadcast(ids), "id").drop("id"), limit, scratch)


def collected(sample: DataFrame) -> list[Row]:
    """The rows of a sample, ordered by content, so that their order of arrival doesn't matter."""
    return sorted(sample.collect(), key=lambda row: tuple((value is not None, value if value is not None else 0) for value in row))
