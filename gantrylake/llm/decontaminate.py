"""Benchmark passages in documents, by a prefix-filtered set join.

A window (ten consecutive words of an item, or a whole shorter item) is the set of its shingles, ordered by
how rare they are in the corpus. A document that holds the window holds all of its shingles, so the
necessary prefix is the single rarest one: documents are joined on that shingle only. The shingle's place
in the window and the window's length bound where the window can lie in the document, and what is left
is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import LOWER, WORD, HashIndex, SpanHash, blocks, ragged, runs, text_buffers
from gantrylake.llm.rows import quoted, result_schema, unpacked, with_text
from gantrylake.session import fresh_path

#: Bytes of item text that one pass over the documents may broadcast; more items take more passes.
ITEM_BYTES = 8 << 20
SHINGLE = 3


@dataclass
class Words:
    """The words of a block of texts."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        data = LOWER[data]
        starts, ends, first = runs(WORD[data], offsets)
        return cls(data, starts, ends, first, SpanHash(data)(starts, ends))

    def content(self, start: int, end: int) -> bytes:
        text = self.data
        return b" ".join(text[a:b].tobytes() for a, b in zip(self.starts[start:end], self.ends[start:end], strict=True))


@dataclass
class Items:
    """The windows of a block of items: each distinct content once, with the items that hold it."""

    contents: list[bytes]
    hashes: np.ndarray
    sizes: np.ndarray
    owners: list[tuple[str, ...]]
    shingles: np.ndarray
    shingle_first: np.ndarray

    @property
    def widths(self) -> np.ndarray:
        """Words in a shingle of each window."""
        return np.minimum(self.sizes, SHINGLE)


def item_windows(rows: list[tuple[str, str | None]], width: int) -> Items:
    """Windows of bounded item rows (id, text)."""
    data, offsets = text_buffers(pa.array([text for _, text in rows], pa.large_string()))
    words = Words.of(data, offsets)
    found: dict[bytes, set[str]] = {}
    hashes, sizes, shingles, counts = [], [], [], []
    spans = SpanHash(words.hashes)
    for n, (item, _) in enumerate(rows):
        low, high = int(words.first[n]), int(words.first[n + 1])
        size = min(width, high - low)
        for start in range(low, high - size + 1) if size else ():
            content = words.content(start, start + size)
            if content not in found:
                found[content] = set()
                at = np.arange(start, start + size - min(size, SHINGLE) + 1)
                hashes.append(spans(np.array([start]), np.array([start + size]))[0])
                sizes.append(size)
                shingles.append(spans(at, at + min(size, SHINGLE)))
                counts.append(len(at))
            found[content].add(item)
    return Items(
        list(found),
        np.array(hashes, np.uint64),
        np.array(sizes, np.int64),
        [tuple(sorted(owners)) for owners in found.values()],
        np.concatenate(shingles) if shingles else np.zeros(0, np.uint64),
        np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
    )


def shingle_hashes(words: Words, spans: SpanHash, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all shingles of one width that lie inside a text, and their hashes."""
    counts = np.maximum(np.diff(words.first) - width + 1, 0)
    at = ragged(words.first[:-1], counts)
    return at, spans(at, at + width)


def shingle_frequencies(docs: DataFrame, text_col: str, items: Items) -> np.ndarray:
    """How often each shingle of the windows occurs in all documents."""
    wanted, place = np.unique(items.shingles, return_inverse=True)
    widths = sorted(set(items.widths.tolist()))
    index = HashIndex(len(wanted))
    index.add(wanted, np.arange(len(wanted), dtype=np.int32))
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, data, offsets in blocks(batch):
                words = Words.of(data, offsets)
                spans = SpanHash(words.hashes)
                for width in widths:
                    found = shared.value.find(shingle_hashes(words, spans, width)[1])
                    total += np.bincount(found[found >= 0], minlength=len(wanted))
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held.astype(np.int32)), pa.array(total[held])], ["shingle", "n"])

    texts = docs.select(quoted(text_col).cast("string").alias("text"))
    sums = texts.mapInArrow(counted, "shingle int, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    frequencies = np.zeros(len(wanted), np.int64)
    for row in sums.toLocalIterator():  # one row per shingle of a bounded block of items
        frequencies[row["shingle"]] = row["n"]
    return frequencies[place]


@dataclass
class Prefixes:
    """Windows by their rarest shingle."""

    index: HashIndex
    first: np.ndarray
    windows: np.ndarray
    places: np.ndarray
    widths: list[int]

    @classmethod
    def of(cls, items: Items, frequencies: np.ndarray) -> Prefixes:
        """The rarest shingle of each window; among equals that of the least hash, then the first."""
        owner = np.repeat(np.arange(len(items.sizes)), np.diff(items.shingle_first))
        place = np.arange(len(owner)) - items.shingle_first[owner]
        order = np.lexsort((place, items.shingles, frequencies, owner))
        least = order[np.searchsorted(owner[order], np.arange(len(items.sizes)))]
        keys, each = np.unique(items.shingles[least], return_inverse=True)
        by_key = np.argsort(each, kind="stable")
        index = HashIndex(max(1, len(keys)))
        index.add(keys, np.arange(len(keys), dtype=np.int32))
        first = np.searchsorted(each[by_key], np.arange(len(keys) + 1))
        return cls(index, first, by_key, place[least][by_key], sorted(set(items.widths.tolist())))


def occurrences(words: Words, items: Items, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence in a block of texts."""
    spans = SpanHash(words.hashes)
    starts, windows = [], []
    text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for width in prefixes.widths:
        at, hashes = shingle_hashes(words, spans, width)
        key = prefixes.index.find(hashes)
        hit = np.flatnonzero(key >= 0)
        key, at = key[hit], at[hit]
        counts = prefixes.first[key + 1] - prefixes.first[key]
        listed = ragged(prefixes.first[key], counts)
        at = np.repeat(at, counts)
        window = prefixes.windows[listed]
        start = at - prefixes.places[listed]
        # Position and length: the window must lie inside the text that holds the shingle.
        text = text_of[at] if len(at) else at
        size = items.sizes[window]
        inside = (items.widths[window] == width) & (start >= words.first[text]) & (start + size <= words.first[text + 1])
        start, window = start[inside], window[inside]
        same = spans(start, start + items.sizes[window]) == items.hashes[window]
        starts.append(start[same])
        windows.append(window[same])
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    window = np.concatenate(windows) if windows else np.zeros(0, np.int64)
    exact = [
        words.content(a, a + n) == items.contents[w]
        for a, n, w in zip(start.tolist(), items.sizes[window].tolist(), window.tolist(), strict=True)
    ]
    keep = np.array(exact, bool)
    return start[keep], window[keep]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    carry: list[str] | None = None,
) -> DataFrame:
    """The carried columns of every document, ``n_words``, ``spans`` and ``items``.

    ``spans`` are the merged runs of hit words as flat pairs (first, end); ``items`` the ids of items with an
    occurring window, as sorted text. NULL and empty texts have no words and no hits; an item without
    words has no window; items with the same id count as one, a NULL id as empty text. Repeated documents
    are judged each. An empty item table hits nothing. Documents are never shuffled: bounded blocks of
    items, dealt by id and text, are broadcast one after the other, and what the passes found is joined in the row.
    """
    spark = docs.sparkSession
    carry = carry or [id_col]
    selected = items.select(
        F.coalesce(quoted(item_col).cast("string"), F.lit("")).alias("item"), quoted(item_text).cast("string").alias("text")
    ).distinct()
    total = selected.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = int(total) // ITEM_BYTES + 1
    frame = with_text(docs, text_col, carry).withColumns(
        {"spans": F.array().cast("array<long>"), "items": F.array().cast("array<string>")}
    )
    schema = result_schema(frame, "text string, spans array<long>, items array<string>, n_words long")
    for n in range(passes):
        part = selected if passes == 1 else selected.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == n)
        block = item_windows(sorted((row["item"], row["text"]) for row in part.collect() if row["text"]), width)
        prefixes = Prefixes.of(block, shingle_frequencies(docs, text_col, block))
        last = n == passes - 1
        if n:
            frame = frame.drop("n_words")
        frame = frame.mapInArrow(_marker(spark, block, prefixes, last), schema)
        if not last:
            folder = fresh_path(spark, "contamination")
            frame.write.parquet(folder)
            frame = spark.read.parquet(folder)
    return unpacked(frame, carry, "n_words", "spans", F.array_sort("items").alias("items"))


def _marker(spark, block: Items, prefixes: Prefixes, last: bool):
    shared = spark.sparkContext.broadcast((block, prefixes))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, index = shared.value
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                words = Words.of(data, offsets)
                start, window = occurrences(words, items, index)
                text = np.searchsorted(words.first, start, side="right") - 1
                spans = [list(x or ()) for x in rows.column("spans").to_pylist()]
                owners = [set(x or ()) for x in rows.column("items").to_pylist()]
                for n, w, a in zip(text.tolist(), window.tolist(), (start - words.first[text]).tolist(), strict=True):
                    spans[n] += (a, a + int(items.sizes[w]))
                    owners[n].update(items.owners[w])
                yield pa.record_batch(
                    [
                        rows.column("row"),
                        pa.nulls(rows.num_rows, pa.string()) if last else rows.column("text"),
                        pa.array([_merged(x) for x in spans], pa.list_(pa.int64())),
                        pa.array([sorted(x) for x in owners], pa.list_(pa.string())),
                        pa.array(np.diff(words.first)),
                    ],
                    ["row", "text", "spans", "items", "n_words"],
                )

    return marked


def _merged(pairs: list[int]) -> list[int]:
    """Overlapping and touching spans as one, in order, as flat pairs."""
    out: list[int] = []
    for start, end in sorted(zip(pairs[::2], pairs[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


def hit_words(spans: str = "spans") -> F.Column:
    """Words inside the merged spans."""
    pairs = F.transform(spans, lambda x, n: F.when(n % 2 == 0, -x).otherwise(x))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda total, x: total + x)
