"""Repeated strings of a minimum length, removed from all documents by suffix sorting in bounded groups.

Every string of ``length`` bytes has an anchor: the leftmost least of its ``GRAM``-byte grams by hash. Equal
strings have equal anchors, so a repeat is found inside the group of runs that share an anchor (a run: the
consecutive strings of a document that have one anchor). Groups of one run need no work; runs with equal
content are one unit. Groups are put together into blocks, and in each block a Burrows-Wheeler
transform is extended backwards, breadth first: intervals of equal prefixes are expanded by every symbol, which
finds the common prefixes of neighbouring suffixes by increasing value, and stops at ``length``. Neighbours whose
common prefix is not found by then are repeats.

A group beyond ``GROUP_UNITS`` is split: the strings by where the anchor lies in them, and the units by the
bytes that all strings of a part share. Parts end at the single string, so any group becomes small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import SpanHash, blocks, mix, ragged, text_buffers
from gantrylake.llm.bitmap import bitmap_of, may_hold
from gantrylake.llm.rows import quoted, result_schema, unpacked
from gantrylake.llm.scratch import Scratch

GRAM = 100
#: Units of a group that one task sorts together, and bytes of a block that it transforms.
GROUP_UNITS = 4096
BLOCK = 2 << 20
SALT = 0x5EED


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    least, have = values, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if width > have:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    return least


class Runs:
    """The runs of a block of texts: first and last string, anchor, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        gram = min(GRAM, length)
        self.spans = SpanHash(data)
        sizes = np.diff(offsets)
        low = np.zeros(0, np.int64)
        high = anchor = low
        if len(data) >= length:
            grams = self.spans.windows(gram)
            ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            least = sliding_least(ranked, length - gram + 1)
            counts = np.maximum(sizes - length + 1, 0)
            strings = ragged(offsets[:-1], counts)
            anchors = (least[strings] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            edge = np.ones(len(strings), bool)
            edge[1:] = (anchors[1:] != anchors[:-1]) | (strings[1:] != strings[:-1] + 1)
            first = np.flatnonzero(edge)
            last = np.append(first[1:], len(strings))[: len(first)] - 1
            low, high, anchor = strings[first], strings[last], anchors[first]
            self.keys = grams[anchor]
        else:
            self.keys = np.zeros(0, np.uint64)
        self.low, self.high, self.anchor = low, high, anchor
        near = (anchor - high).astype(np.uint64)
        self.units = mix(self.spans(low, high + length) + mix(near * np.uint64(131071) + (high - low).astype(np.uint64) + np.uint64(1)))


def run_keys(docs: DataFrame, length: int, text_col: str) -> DataFrame:
    """``key`` of every anchor that has at least two runs."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in blocks(batch):
                yield pa.record_batch([pa.array(Runs(data, offsets, length).keys.view(np.int64))], ["key"])

    rows = docs.select(quoted(text_col).cast("string").alias("text")).mapInArrow(keyed, "key long")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")


def reference(text: F.Column) -> list[F.Column]:
    """Two digests that stand for a whole text."""
    return [F.xxhash64(text).alias("ref"), F.xxhash64(F.lit(SALT), text).alias("ref2")]


def _referenced(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(text.alias("text"), *reference(text))


def _occurrences(rows: pa.RecordBatch, offsets: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text digests, place and a hash of all three for the runs that begin at ``low``."""
    text = np.searchsorted(offsets, low, side="right") - 1
    ref, ref2 = (rows.column(name).to_numpy()[text] for name in ("ref", "ref2"))
    at = low - offsets[text]
    spot = mix(ref.view(np.uint64) ^ mix(ref2.view(np.uint64) + mix(at.astype(np.uint64) + np.uint64(1))))
    return ref, ref2, at, spot.view(np.int64)


def repeated_runs(docs: DataFrame, length: int, text_col: str, every: np.ndarray) -> DataFrame:
    """The runs whose anchor the bitmap may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(every)
    names = ["key", "unit", "strings", "near", "ref", "ref2", "at", "spot"]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                found = Runs(data, offsets, length)
                hit = np.flatnonzero(may_hold(shared.value, found.keys))
                low, high = found.low[hit], found.high[hit]
                own = [found.keys[hit].view(np.int64), found.units[hit].view(np.int64)]
                sizes = [(high - low + 1).astype(np.int32), (found.anchor[hit] - high).astype(np.int32)]
                columns = [*own, *sizes, *_occurrences(rows, offsets, low)]
                yield pa.record_batch([pa.array(column) for column in columns], names)

    kinds = "key long, unit long, strings int, near int, ref long, ref2 long, at long, spot long"
    return _referenced(docs, text_col).mapInArrow(chosen, kinds)


def run_contents(docs: DataFrame, length: int, text_col: str, spots: np.ndarray) -> DataFrame:
    """(key, unit, content) of the runs whose place the bitmap may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(spots)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                found = Runs(data, offsets, length)
                spot = _occurrences(rows, offsets, found.low)[3]
                hit = np.flatnonzero(may_hold(shared.value, spot.view(np.uint64)))
                raw = data.tobytes()
                content = [raw[a:b] for a, b in zip(found.low[hit].tolist(), (found.high[hit] + length).tolist(), strict=True)]
                keys = [pa.array(found.keys[hit].view(np.int64)), pa.array(found.units[hit].view(np.int64))]
                yield pa.record_batch([*keys, pa.array(content, pa.binary())], ["key", "unit", "content"])

    return _referenced(docs, text_col).mapInArrow(chosen, "key long, unit long, content binary").distinct()


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first ``depth`` symbols at least (prefix doubling)."""
    total = len(symbols)
    padded = np.zeros(total + depth + 8, np.uint64)
    padded[:total] = symbols
    packed = np.zeros(total, np.uint64)
    for n in range(8):
        packed = (packed << np.uint64(8)) | padded[n : n + total]
    order = np.argsort(packed)
    ordered = packed[order]
    edge = np.ones(total, bool)
    edge[1:] = ordered[1:] != ordered[:-1]
    rank = np.zeros(total + depth + 8, np.int64)
    rank[order] = np.flatnonzero(edge)[np.cumsum(edge) - 1] + 1
    have = 8
    while have < depth:
        step = min(have, depth - have)
        # Only suffixes that still share their rank with another are sorted on.
        first = np.flatnonzero(edge)
        alone = np.diff(np.append(first, total)) == 1
        open_ = ~np.repeat(alone, np.diff(np.append(first, total)))
        spots = np.flatnonzero(open_)
        if not len(spots):
            break
        places = order[spots]
        pair = (rank[places].astype(np.uint64) << np.uint64(32)) | rank[places + step].astype(np.uint64)
        resorted = np.argsort(pair)
        places, pair = places[resorted], pair[resorted]
        order[spots] = places
        new = np.ones(len(spots), bool)
        new[1:] = pair[1:] != pair[:-1]
        edge[spots] = new
        fresh = rank.copy()
        fresh[places] = spots[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1
        rank = fresh
        have += step
    return order


def common_prefix_edges(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Flags of the places in ``order`` whose common prefix with the place before is shorter than ``length``.

    Symbol 0 ends a string: prefixes reach up to it, never across. Breadth-first backward extension: each
    interval holds the suffixes that begin with one string; extended by a symbol it gives the interval of a
    string one longer, and if no shorter string ends at its upper end, that is a common prefix's value.
    """
    total = len(symbols)
    before = symbols[order - 1].astype(np.int64)  # the transform; place 0 takes the last symbol, a separator
    counts = np.bincount(symbols, minlength=256)
    starts = np.cumsum(counts) - counts
    by_symbol = np.argsort(before.astype(np.uint8), kind="stable")
    step = np.empty(total, np.int64)
    step[by_symbol] = np.arange(total)
    places = [by_symbol[starts[c] : starts[c] + counts[c]] for c in range(256)]
    present = np.flatnonzero(counts)
    found = np.zeros(total + 1, bool)
    found[0] = found[total] = True
    low, high = starts[present], starts[present] + counts[present]
    new = ~found[high]
    found[high] = True
    # The last symbol's interval ends at the end, which is known; its string is extended all the same.
    new[-1] = True
    low, high = low[new], high[new]
    for _ in range(1, length):
        if not len(low):
            break
        size = high - low
        lows, highs = [], []
        one = low[size == 1]
        one = one[before[one] != 0]
        lows.append(step[one])
        highs.append(step[one] + 1)
        some = (size > 1) & (size <= 64)
        if some.any():
            owner = np.repeat(np.arange(int(some.sum())), size[some])
            at = ragged(low[some], size[some])
            symbol = before[at]
            real = symbol != 0
            owner, at, symbol = owner[real], at[real], symbol[real]
            group = owner * 256 + symbol
            sort = np.argsort(group, kind="stable")
            group, target = group[sort], step[at[sort]]
            edge = np.ones(len(group), bool)
            edge[1:] = group[1:] != group[:-1]
            begin = np.flatnonzero(edge)
            end = np.append(begin[1:], len(group))[: len(begin)]
            lows.append(target[begin])
            highs.append(target[end - 1] + 1)
        many = size > 64
        if many.any():
            for c in present[present > 0]:
                a = np.searchsorted(places[c], low[many])
                b = np.searchsorted(places[c], high[many])
                kept = b > a
                lows.append(starts[c] + a[kept])
                highs.append(starts[c] + b[kept])
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = ~found[high]
        low, high = low[new], high[new]
        found[high] = True
    return found


def repeated_strings(contents: list[bytes], length: int) -> list[list[int]]:
    """For each content, the flat (first, end) ranges of its strings that also start elsewhere among them."""
    sizes = np.array([len(content) for content in contents], np.int64)
    raw = np.frombuffer(b"\x00".join(contents) + b"\x00", np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols = raw + np.uint8(1)  # bytes 255 do not occur in UTF-8
    symbols[begins + sizes] = 0
    order = suffix_order(symbols, length)
    edges = common_prefix_edges(symbols, order, length)
    shared = np.zeros(len(symbols), bool)
    shared[order] = ~edges[:-1] | ~edges[1:]
    out = []
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        flags = np.zeros(max(size - length + 1, 0) + 2, np.int8)
        flags[1:-1] = shared[begin : begin + len(flags) - 2]
        out.append(np.flatnonzero(np.diff(flags)).reshape(-1, 2).ravel().tolist())
    return out


def _searched(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, whole groups gathered into blocks, each transformed once."""
    rows: list[tuple[int, int, bytes]] = []
    held = 0

    def found() -> pa.RecordBatch:
        ranges = repeated_strings([content for _, _, content in rows], length)
        columns = [pa.array([row[n] for row in rows], pa.int64()) for n in (0, 1)]
        return pa.record_batch([*columns, pa.array(ranges, pa.list_(pa.int32()))], ["key", "unit", "ranges"])

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("key", "unit", "content")), strict=True):
            if held >= BLOCK and row[0] != rows[-1][0]:
                yield found()
                rows, held = [], 0
            rows.append(row)
            held += len(row[2])
    if rows:
        yield found()


def _parts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each unit as two: strings whose anchor lies in the nearer and in the farther half of the group's range."""
    names = ("key", "unit", "strings", "near", "content", "first", "end")
    for batch in batches:
        out: list[tuple] = []
        for key, unit, strings, near, content, first, end in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            middle = (first + end) // 2
            for a, b in ((first, middle), (middle, end)):  # distances a <= d < b of the anchor from the string's start
                least, most = max(near, a), min(near + strings, b)
                if least >= most:
                    continue
                skipped = near + strings - most
                part = content[skipped : skipped + (most - least) + length - 1]
                common = content[near + strings - 1 - a : near + strings - 1 - (b - 1) + length]
                group = hash_bytes(common, key ^ (a << 20) ^ b)
                out.append((key, unit, skipped, group, hash_bytes(part, group ^ least), most - least, least, part, a, b))
        if out:
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()] + [pa.int32()] * 2
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], PART_NAMES)


PART_NAMES = ["old_key", "old_unit", "skipped", "key", "unit", "strings", "near", "content", "first", "end"]
PARTS = "old_key long, old_unit long, skipped long, key long, unit long, strings int, near int, content binary, first int, end int"


def hash_bytes(content: bytes, salt: int) -> int:
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(content, seed=salt & (2**64 - 1)), "big", signed=True)


def _sized(units: DataFrame, scratch: Scratch) -> DataFrame:
    """Units with the number of their group's ``members``.

    Both sides of the join are written first: it then reads plain shuffles, which Spark splits where a key is hot.
    """
    stored = scratch.write(units, "kinds")
    sizes = scratch.write(stored.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "sizes")
    return scratch.write(stored.join(sizes, "key"), "units")


def repeated_ranges(units: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(key, unit, ranges) of the strings that occur twice or more among sized units.

    ``units``: distinct runs with their key, ``content`` (where ``members`` is above 1), how often they occur (``n``),
    their number of ``strings``, how far the anchor lies from the last string's start (``near``), and the range of
    such distances in the group (``first``, ``end``).
    """
    whole = units.where("n > 1").select("key", "unit", F.array(F.lit(0), F.col("strings")).alias("ranges"))
    small = units.where(f"members > 1 and members <= {GROUP_UNITS}").select("key", "unit", "content")
    searched = small.repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda batches: _searched(batches, length), "key long, unit long, ranges array<int>"
    )
    results = whole.union(searched.where("size(ranges) > 0"))
    large = units.where(f"members > {GROUP_UNITS}")
    if not large.limit(1).count():
        return results
    parts = large.select("key", "unit", "strings", "near", "content", "first", "end").repartition("unit")
    split = scratch.write(parts.mapInArrow(lambda batches: _parts(batches, length), PARTS), "parts")
    counted = split.join(large.select(F.col("key").alias("old_key"), F.col("unit").alias("old_unit"), "n"), ["old_key", "old_unit"])
    grouped = ["key", "unit", "strings", "near", "content", "first", "end"]
    below = repeated_ranges(_sized(counted.groupBy(*grouped).agg(F.sum("n").alias("n")), scratch), length, scratch)
    back = split.select("old_key", "old_unit", "skipped", "key", "unit").join(below, ["key", "unit"])
    shifted = F.transform("ranges", lambda x: (x + F.col("skipped")).cast("int"))
    return results.union(back.select(F.col("old_key").alias("key"), F.col("old_unit").alias("unit"), shifted.alias("ranges")))


def remove_repeats(
    docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, as_text: bool = False
) -> DataFrame:
    """The carried columns of every row, ``n_bytes``, ``spans`` (removed runs as flat pairs) and ``kept`` (bytes).

    With ``as_text``, ``kept`` is text: characters of which only a part was removed go whole.

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else in the documents, as
    they come in. Strings never cross texts. NULL is an empty text: nothing to remove, no bytes kept. Repeated
    rows and copies repeat each other, so all of them lose those strings. Texts shorter than ``length`` stay.
    An empty table gives no rows.
    """
    carry = carry or [id_col]
    scratch = Scratch(docs.sparkSession, "repeats")
    every = bitmap_of(run_keys(docs, length, text_col), "key")
    runs = scratch.write(repeated_runs(docs, length, text_col, every), "runs")
    # One place of each unit stands for it, so that its bytes are fetched once.
    kinds = runs.groupBy("key", "unit", "strings", "near").agg(F.count(F.lit(1)).alias("n"), F.min("spot").alias("spot"))
    span = max(length - GRAM, 0) + 1
    units = _sized(kinds.withColumns({"first": F.lit(0), "end": F.lit(span)}), scratch)
    several = units.where("members > 1")
    contents = run_contents(docs, length, text_col, bitmap_of(several, "spot"))
    columns = ["key", "unit", "strings", "near", "content", "n", "members", "first", "end"]
    filled = several.join(contents, ["key", "unit"]).select(*columns)
    alone = units.where("members = 1").withColumn("content", F.lit(None).cast("binary")).select(*columns)
    ranges = scratch.write(repeated_ranges(scratch.write(filled, "contents").union(alone), length, scratch), "ranges")
    where = runs.select("key", "unit", "ref", "ref2", "at")
    pieces = where.join(ranges, ["key", "unit"]).select(
        "ref", "ref2", F.transform("ranges", lambda x: x + F.col("at")).alias("strings")
    )
    # A set: copies of one text have the same strings, and are combined before the shuffle.
    found = scratch.finish(pieces.groupBy("ref", "ref2").agg(F.flatten(F.collect_set("strings")).alias("strings")))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[quoted(name) for name in carry]).alias("row"), text.alias("text"), *reference(text))
    joined = rows.join(found, ["ref", "ref2"], "left").select("row", "text", "strings")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, offsets in blocks(batch):
                spans, kept = [], []
                for n, flat in enumerate(own.column("strings").to_pylist()):
                    mine = data[offsets[n] : offsets[n + 1]]
                    spans.append(_covered(flat or [], length))
                    gone = np.zeros(len(mine) + 1, np.int8)
                    pairs = np.array(spans[-1], np.int64).reshape(-1, 2)
                    gone[pairs[:, 0]] += 1
                    gone[pairs[:, 1]] -= 1
                    kept.append(mine[np.cumsum(gone[:-1]) == 0].tobytes())
                left = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
                columns = [own.column("row"), pa.array(np.diff(offsets)), pa.array(spans, pa.list_(pa.int64())), left]
                yield pa.record_batch(columns, ["row", "n_bytes", "spans", "kept"])

    kind = "string" if as_text else "binary"
    out = joined.mapInArrow(cut, result_schema(joined, f"n_bytes long, spans array<long>, kept {kind}"))
    return unpacked(out, carry, "n_bytes", "spans", "kept")


def _covered(flat: list[int], length: int) -> list[int]:
    """Bytes under ranges of string starts, as merged flat pairs."""
    out: list[int] = []
    for first, end in sorted(zip(flat[::2], flat[1::2], strict=True)):
        if out and first <= out[-1]:
            out[-1] = max(out[-1], end - 1 + length)
        else:
            out += (first, end - 1 + length)
    return out
