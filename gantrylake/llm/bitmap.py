"""A filter of fixed size for keys that many rows may hold.

A set bit means that the key may be among them, a clear bit that it is not. The size does not grow with the
data; a filter that fills up lets more rows through to the exact join behind it, and drops none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**BITS bits, 8 MB.
BITS = 26


def bitmap_of(keys: DataFrame, column: str) -> np.ndarray:
    """The words of the bitmap of a column of 64-bit hashes; at most 2**(BITS - 6) rows reach the driver."""
    # The low bits: a hash chosen for being small still spreads evenly over them.
    place = F.col(column).bitwiseAND(F.lit((1 << BITS) - 1))
    words = keys.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("bits")
    )
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    for row in words.toArrow().to_batches():
        bitmap[row.column("word").to_numpy()] = row.column("bits").to_numpy().view(np.uint64)
    return bitmap


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Flags of the keys (unsigned) whose bit is set."""
    place = keys & np.uint64((1 << BITS) - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


#: 2**SLOTS bytes, 16 MB.
SLOTS = 24


def rarity_table(counts: DataFrame, column: str, number: str) -> np.ndarray:
    """For each slot of hashed keys the binary order of magnitude of its most frequent key, 0 if it has none.

    ``counts`` holds the keys that occur more than once with their numbers. The table has one size whatever the
    data; keys that share a slot share a rank, which makes an order coarser and never wrong.
    """
    slot = F.col(column).bitwiseAND(F.lit((1 << SLOTS) - 1)).cast("int")
    grades = counts.groupBy(slot.alias("slot")).agg(F.max(F.ceil(F.log2(F.col(number) + 1))).cast("tinyint").alias("grade"))
    table = np.zeros(1 << SLOTS, np.int8)
    for batch in grades.toArrow().to_batches():
        table[batch.column("slot").to_numpy()] = batch.column("grade").to_numpy()
    return table


def rarity(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The rank of each key (unsigned): 0 for keys that occur once."""
    return table[(keys & np.uint64((1 << SLOTS) - 1)).astype(np.int64)]
