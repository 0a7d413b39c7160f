"""How filters interact: what each removes at every place of every order, from one table of counts.

One pass gives every document the set of filters that it fails. Counted per part, those sets are a tensor with
one axis per filter (0: passes, 1: fails) and one for the kinds of documents that are counted. Each figure of
each step of each order is a contraction of that tensor: an axis takes what passes, what fails, or all.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gantrylake.llm.rows import quoted

#: What an axis takes.
PASS, FAIL, ALL = np.eye(2, dtype=np.int64)[0], np.eye(2, dtype=np.int64)[1], np.ones(2, np.int64)
#: Orders grow as a factorial: seven filters have 5,040.
MOST_FILTERS = 7
LETTERS = "abcdefg"
FIGURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions A to D of a text that isn't NULL."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_of(failures: dict[str, Column]) -> Column:
    """The failed conditions as bits, the first condition lowest."""
    bits = [F.when(failed, F.lit(1 << n)).otherwise(F.lit(0)) for n, failed in enumerate(failures.values())]
    return reduce(lambda a, b: a + b, bits)


def failure_counts(
    docs: DataFrame, labels: DataFrame, part_col: str = "lang", text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(part, mask, good, toxic, n): documents of each part by the set of filters that they fail, A lowest.

    NULL texts are empty, NULL parts are the empty part. E fails for a text that a smaller id has too; rows
    without an id, and rows that share the least id, pass it. A document is good or toxic if any of its label rows
    says so. Copies of a text fall together before they are compared, so a group of any size is a few rows.
    """
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    marked = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask_of(text_failures(F.col("text"))).alias("mask"))
    graded = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    joined = marked.join(graded, "id", "left").fillna(False, ["good", "toxic"])
    same = ["digest", "mask", "part", "good", "toxic"]
    each = joined.groupBy(*same, "id").agg(F.count(F.lit(1)).alias("n"))
    with_id = F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)
    least = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least")
    groups = each.groupBy(*same).agg(F.sum("n").alias("n"), F.sum(with_id).alias("with_id"), least)
    first = F.min("least.id").over(Window.partitionBy("digest"))
    spared = F.when(F.col("least.id") == first, F.col("least.n")).otherwise(0)
    split = groups.withColumn("repeats", F.coalesce(F.col("with_id") - spared, F.lit(0)))
    both = F.explode(
        F.array(
            F.struct(F.col("mask"), (F.col("n") - F.col("repeats")).alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), F.col("repeats").alias("n")),
        )
    )
    cells = split.select("part", "good", "toxic", both.alias("cell")).select("part", "good", "toxic", "cell.*")
    return cells.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def tensor_of(cells: pd.DataFrame, filters: int) -> np.ndarray:
    """Counts of one part: an axis per filter, then all, good and toxic documents."""
    flat = np.zeros((1 << filters, 3), np.int64)
    for kind, mine in enumerate((np.ones(len(cells), bool), cells["good"].to_numpy(bool), cells["toxic"].to_numpy(bool))):
        np.add.at(flat[:, kind], cells["mask"].to_numpy()[mine], cells["n"].to_numpy()[mine])
    # The first filter is the lowest bit and so the last of the axes that reshape gives.
    return flat.reshape((2,) * filters + (3,)).transpose(*range(filters - 1, -1, -1), filters)


def contracted(tensor: np.ndarray, choices: np.ndarray) -> np.ndarray:
    """The tensor's sums for rows of choices (row, filter, pass or fail): one row per choice, by kind."""
    axes = LETTERS[: choices.shape[1]]
    terms = ",".join([f"{axes}m", *(f"z{axis}" for axis in axes)])
    return np.einsum(f"{terms}->zm", tensor, *choices.transpose(1, 0, 2), optimize="greedy")


def step_figures(tensor: np.ndarray, names: str) -> pd.DataFrame:
    """One row per order and step with every figure."""
    count = len(names)
    orders = list(permutations(range(count)))
    kept, removed = (np.tile(ALL, (len(orders) * count, count, 1)) for _ in range(2))
    at = 0
    for order in orders:
        for step in range(count):
            kept[at, list(order[: step + 1])] = PASS
            removed[at, list(order[:step])] = PASS
            removed[at, order[step]] = FAIL
            at += 1
    alone, failing = np.tile(PASS, (count, count, 1)), np.tile(ALL, (count, count, 1))
    alone[range(count), range(count)] = failing[range(count), range(count)] = FAIL
    here = contracted(tensor, removed)
    own = np.array(orders).ravel()
    shapley = np.zeros(count, np.int64)
    np.add.at(shapley, own, here[:, 0])
    fails, only = contracted(tensor, failing)[:, 0], contracted(tensor, alone)[:, 0]
    columns = {
        "filter_order": np.repeat(["".join(names[n] for n in order) for order in orders], count),
        "step": np.tile(np.arange(1, count + 1, dtype=np.int32), len(orders)),
        "kept": contracted(tensor, kept)[:, 0],
        "removed": here[:, 0],
        "redundant": fails[own] - here[:, 0],
        "unique_fails": only[own],
        "good_lost": here[:, 1],
        "toxic_lost": here[:, 2],
        "shapley": shapley[own],
    }
    return pd.DataFrame(columns)


def audit_orders(counts: DataFrame, names: str) -> DataFrame:
    """Every order of the filters ``names`` (a letter each, lowest bit first), step by step, for each part.

    ``counts`` holds part, mask, good, toxic and n, at most 4 * 2 ** filters rows a part, so a part is a task's small
    piece of work whatever the corpus holds. Zeros are included; an empty table gives no rows.
    """
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"between one and {MOST_FILTERS} filters can be audited in every order")

    def audited(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        out = step_figures(tensor_of(cells, len(names)), names)
        out.insert(0, "part", key[0])
        return out

    kinds = ", ".join(f"{name} long" for name in FIGURES)
    return counts.groupBy("part").applyInPandas(audited, f"part string, filter_order string, step int, {kinds}")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters of :func:`failure_counts` in all 120 orders, per language.

    Repeated rows count each; ties in the order of ids don't arise, as only the least id of a text matters.
    Texts of any length are read once, in generated code.
    """
    return audit_orders(failure_counts(docs, labels), "ABCDE")
