"""Jaccard join of word-shingle sets by parity sketches.

A set of size s is hashed into a sketch of m blocks: each shingle flips one bit of one block. Every bit
in which two sketches differ comes from a shingle that the sets do not share, so the blocks that differ
number at most the symmetric difference. Two linked sets differ in at most d shingles, d known from their
sizes: of m blocks at least m - d are equal. With the blocks of each set in one common order, linked sets share
one of their d + 1 first blocks. The order puts rare blocks first (by a table of fixed size), so blocks
that no other set has, where a copy was edited, take up the first places and meet nothing. m
depends on the size band only; a set that may have partners in the next band is sketched for that band too.

Sets in one bucket are not paired with each other. Each is compared with one or two centres, the sets with the
fewest blocks of their own that it shares a bucket with; what links is one component. Only sets of different
components that still share a bucket are then compared, so that no link between components is lost: their
whole sketches side by side in tiles of bounded size, and the sets themselves only where the Hamming distance
leaves a link possible.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import LOWER, SPACE, SpanHash, blocks, content_ids, mix, ragged, runs, text_buffers
from gantrylake.llm.bitmap import bitmap_of, may_hold, rarity, rarity_table
from gantrylake.llm.components import connected_components
from gantrylake.llm.rows import quoted
from gantrylake.llm.scratch import Scratch, small_batches

#: Bits of a sketch block, and blocks per block that must be looked at. Blocks travel as hashes, so their width costs
#: nothing; wide ones agree only where sets share shingles, not by chance, however many sets there are.
BLOCK_BITS = 1 << 20
SPARE = 1.25
#: Sizes in a band differ by this factor at most.
BAND = 1.5
#: Sets of a bucket that are compared in one piece of work, and bits of a whole sketch per differing shingle.
TILE = 2048
WHOLE_BITS = 4
#: Blocks of its own that are told apart when a centre is chosen.
OWN_LIMIT = (1 << 15) - 1
_BIT_CODE = np.uint64(0x6A09E667F3BCC909)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, one after the other, and where each text's begin.

    Shingles are hashes; ``exact`` ones are numbers that hold among the given texts, equal where all words are.
    """
    data = LOWER[data]
    starts, ends, first = runs(~SPACE[data], offsets)
    words = SpanHash(data)(starts, ends)
    number = np.diff(first)
    size = np.minimum(number, width)
    counts = np.where(number > 0, number - size + 1, 0)
    at = ragged(first[:-1], counts)
    until = at + np.repeat(size, counts)
    shingles = SpanHash(words)(at, until)
    if exact:
        shingles = content_ids(content_ids(data, starts, ends, words), at, until, shingles)
    bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    sets = [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    total = np.concatenate([[0], np.cumsum([len(own) for own in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), total


def set_digests(members: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each set."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    for n, salt in enumerate((0x51, 0xA7C3)):
        sums = np.zeros(len(members) + 1, np.uint64)
        np.cumsum(mix(members + np.uint64(salt)), out=sums[1:])
        out[:, n] = mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))
    return out


class Bands:
    """Size bands and the numbers of blocks for a threshold of ``percent`` per cent."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        lows = [1]
        while lows[-1] < 1 << 40:
            lows.append(max(lows[-1] + 1, lows[-1] * 100 // percent + 1, int(lows[-1] * BAND)))
        self.lows = np.array(lows, np.int64)

    def differing(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The most shingles by which linked sets of these sizes can differ."""
        return (one + other) * (100 - self.percent) // (100 + self.percent)

    def roles(self, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(sets, band, blocks, leading blocks) for the own band, and for the next where a partner can lie."""
        band = np.searchsorted(self.lows, sizes, side="right") - 1
        partner = sizes * 100 // self.percent
        out = []
        for step in (0, 1):
            own = np.flatnonzero((sizes > 0) & (partner >= self.lows[band + step]))
            at = band[own] + step
            high = self.lows[at + 1] - 1
            lead = self.differing(sizes[own], np.minimum(high, partner[own])) + 1
            most = self.differing(high, high) + 1
            out.append((own, at, np.ceil(most * SPARE).astype(np.int64), lead))
        return out


def sketch_keys(members: np.ndarray, first: np.ndarray, bands: Bands) -> list[tuple]:
    """Per role: (sets, blocks, leading blocks, keys of all blocks set after set, the fullest first; sketches)."""
    out = []
    sizes = np.diff(first)
    for own, band, number, lead in bands.roles(sizes):
        counts = sizes[own]
        values = members[ragged(first[own], counts)]
        local = np.repeat(np.arange(len(own)), counts)
        block = ((values >> np.uint64(20)) % np.repeat(number, counts).astype(np.uint64)).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(number)]).astype(np.int64)
        cell = (base[local] + block) * BLOCK_BITS + (values & np.uint64(BLOCK_BITS - 1)).astype(np.int64)
        cell.sort()
        edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        odd = np.diff(np.append(edge, len(cell))) % 2 == 1
        cell = cell[edge[odd]]
        # Blocks with a bit set: their pattern's hash and their number of bits.
        full = cell // BLOCK_BITS
        begin = np.flatnonzero(np.concatenate([[True], full[1:] != full[:-1]])) if len(full) else np.zeros(0, np.int64)
        pattern = np.zeros(int(base[-1]), np.uint64)
        bits = np.zeros(int(base[-1]), np.int64)
        if len(full):
            pattern[full[begin]] = np.bitwise_xor.reduceat(mix((cell % BLOCK_BITS).astype(np.uint64) + _BIT_CODE), begin)
            bits[full[begin]] = np.diff(np.append(begin, len(full)))
        owner = np.repeat(np.arange(len(own)), number)
        place = np.arange(len(owner)) - base[owner]
        label = (band[owner].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)
        key = mix(pattern + mix(label + np.uint64(1)))
        whole = 1 << np.ceil(np.log2(np.maximum(256, WHOLE_BITS * number))).astype(np.int64)
        ends = np.cumsum(whole)
        flips = (ends - whole)[local] + ((mix(values) >> np.uint64(8)).astype(np.int64) & (np.repeat(whole, counts) - 1))
        packed = np.packbits((np.bincount(flips, minlength=int(ends[-1]) if len(ends) else 0) & 1).astype(bool)).tobytes()
        sketches = [packed[a // 8 : b // 8] for a, b in zip((ends - whole).tolist(), ends.tolist(), strict=True)]
        out.append((own, number, lead, key[np.lexsort((key, -bits, owner))], sketches))
    return out


def _role_columns(role: tuple, rows: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Keys, number of leading blocks and sketch per row; a row without this role has none."""
    own, number, lead, keys, sketches = role
    sizes, leads = np.zeros(rows, np.int64), np.zeros(rows, np.int32)
    sizes[own], leads[own] = number, lead
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    whole: list[bytes | None] = [None] * rows
    for n, sketch in zip(own.tolist(), sketches, strict=True):
        whole[n] = sketch
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64))), pa.array(leads), pa.array(whole, pa.binary())


def sketched(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (digest of the set) and for both roles ``keys``, ``lead``, ``sketch`` of every row."""
    selected = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    kind = selected.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_shingles", "node", "keys", "lead", "sketch", "next_keys", "next_lead", "next_sketch"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                members, first = shingle_sets(data, offsets, width)
                own, after = sketch_keys(members, first, bands)
                roles = [*_role_columns(own, rows.num_rows), *_role_columns(after, rows.num_rows)]
                yield pa.record_batch([rows.column("doc_id"), pa.array(np.diff(first)), _nodes(members, first), *roles], names)

    kinds = "node binary, keys array<long>, lead int, sketch binary, next_keys array<long>, next_lead int, next_sketch binary"
    return selected.mapInArrow(sketch, f"doc_id {kind}, n_shingles long, {kinds}")


def _standing(batch: pa.RecordBatch, alone: np.ndarray) -> pa.RecordBatch:
    """Rows that may stand for their set."""
    return batch.filter(pa.array(may_hold(alone, batch.column("spot").to_numpy().view(np.uint64))))


def leading_keys(table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, short, own, later) of each set's leading blocks that another set may have.

    ``own`` counts blocks it has alone; ``later`` marks blocks of its sketch for the next band.
    """
    for batch in batches:
        short = batch.column("short").to_numpy()
        alone = np.zeros(len(short), np.int64)
        keys, owners = [], []
        for name, lead_name in (("keys", "lead"), ("next_keys", "next_lead")):
            listed = batch.column(name)
            flat = listed.flatten().to_numpy(zero_copy_only=False)
            sizes = listed.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            lead = batch.column(lead_name).to_numpy()
            owner = np.repeat(np.arange(len(short)), sizes)
            first = np.cumsum(sizes) - sizes
            often = rarity(table, flat.view(np.uint64))
            if name == "keys":
                alone = np.bincount(owner[often == 0], minlength=len(short))
            order = np.lexsort((often, owner))  # stable: ties stay fullest first
            chosen = order[(np.arange(len(flat)) - first[owner] < lead[owner]) & (often[order] > 0)]
            keys.append(flat[chosen])
            owners.append(owner[chosen])
        later = np.repeat([False, True], [len(keys[0]), len(keys[1])])
        owner = np.concatenate(owners)
        own = np.minimum(alone, OWN_LIMIT).astype(np.int64)
        columns = [np.concatenate(keys), short[owner], own[owner], later]
        yield pa.record_batch([pa.array(column) for column in columns], ["key", "short", "own", "later"])


def _nodes(members: np.ndarray, first: np.ndarray) -> pa.Array:
    raw = set_digests(members, first).astype(">u8").tobytes()
    return pa.array([raw[n : n + 16] for n in range(0, len(raw), 16)], pa.binary())


def _short(node: str) -> F.Column:
    """The first half of a node's digest, which stands for it in buckets."""
    return F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("long")


def candidate_texts(docs: DataFrame, shorts: np.ndarray, width: int, text_col: str) -> DataFrame:
    """One (short, node, text) for each distinct set that the bitmap may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(shorts)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                members, first = shingle_sets(data, offsets, width)
                digests = set_digests(members, first)
                hit = pa.array(may_hold(shared.value, digests[:, 0]) & (np.diff(first) > 0))
                yield pa.record_batch(
                    [pa.array(digests[:, 0].view(np.int64)).filter(hit), _nodes(members, first).filter(hit), rows.column("text").filter(hit)],
                    ["short", "node", "text"],
                )

    texts = docs.select(quoted(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(chosen, "short long, node binary, text string")
    # Equal sets may come from different texts: any one of them will do.
    return found.groupBy("short", "node").agg(F.min("text").alias("text"))


def _brief(short: str) -> F.Column:
    """48 bits of a set's short digest. Sets that share them are all compared: nothing is lost by it."""
    return F.shiftrightunsigned(short, 16)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b) nodes of the candidate pairs (short, brief) whose sets are linked, compared word by word."""
    left = texts.select("short", F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(_brief("short").alias("brief"), F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "short").join(right, "brief").select("a", "text_a", "b", "text_b")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, data, offsets in blocks(batch, "text_a"):
                others, after = text_buffers(own.column("text_b"))
                both = np.concatenate([data, others]), np.concatenate([offsets, len(data) + after[1:]])
                members, first = shingle_sets(*both, width, exact=True)
                linked = []
                for n in range(own.num_rows):
                    m = own.num_rows + n
                    one, two = members[first[n] : first[n + 1]], members[first[m] : first[m + 1]]
                    common = len(np.intersect1d(one, two, assume_unique=True))
                    linked.append(100 * common >= percent * (len(one) + len(two) - common))
                hit = pa.array(linked, pa.bool_())
                yield pa.record_batch([own.column("a").filter(hit), own.column("b").filter(hit)], ["a", "b"])

    return rows.mapInArrow(checked, "a binary, b binary")


def _tile_pairs(rows: list[tuple], low: int, high: int, bands: Bands) -> list[tuple[int, int]]:
    """(short, short) of different components whose sketches leave a link possible, once per pair and bucket.

    A pair that shares several buckets belongs to the one with the least key.
    """
    key = rows[0][0]
    short = np.array([row[1] for row in rows], np.int64)
    roots = np.array([row[2] for row in rows], np.int64)
    sizes = np.array([row[3] for row in rows], np.int64)
    words = np.frombuffer(b"".join(row[4] for row in rows), np.uint64).reshape(len(rows), -1)
    keys = [frozenset(row[5]) for row in rows]
    tile = np.array([row[6] for row in rows])
    found = []
    left = np.flatnonzero(tile == low)
    right = np.flatnonzero(tile == high)
    step = max(1, (1 << 21) // max(1, len(right) * words.shape[1]))
    for at in range(0, len(left), step):
        mine = left[at : at + step]
        apart = np.bitwise_count(words[mine][:, None, :] ^ words[right][None, :, :]).sum(2)
        near = (apart <= bands.differing(sizes[mine][:, None], sizes[right][None, :])) & (roots[mine][:, None] != roots[right][None, :])
        for a, b in zip(*np.nonzero(near), strict=True):
            one, two = int(mine[a]), int(right[b])
            if (low != high or one < two) and min(keys[one] & keys[two]) == key:
                found.append((int(short[one]), int(short[two])))
    return found


def compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (short, other) of rows sorted by tile."""
    bands = Bands(percent)
    names = ("key", "short", "root", "n_shingles", "sketch", "shared", "tile", "low", "high")
    rows: list[tuple] = []

    def pairs() -> pa.RecordBatch:
        found = _tile_pairs(rows, rows[0][7], rows[0][8], bands)
        return pa.record_batch([pa.array([pair[n] for pair in found], pa.int64()) for n in (0, 1)], ["short", "other"])

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
            if rows and (row[0], row[7], row[8]) != (rows[0][0], rows[0][7], rows[0][8]):
                yield pairs()
                rows = []
            rows.append(row)
    if rows:
        yield pairs()


def pairs_across(open_: DataFrame, sketches: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components that share a bucket and whose whole sketches are near enough.

    A large bucket is cut into tiles by hash, and every two tiles are one piece of work, so no task holds more than
    two tiles at a time.
    """
    tiles = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    shared = open_.groupBy("short").agg(F.collect_set("key").alias("shared"))
    rows = open_.join(scratch.write(tiles, "tiles"), "key").join(scratch.write(shared.join(sketches, "short"), "whole"), "short")
    rows = rows.withColumns(
        {
            "sketch": F.when(F.col("later"), F.col("next_sketch")).otherwise(F.col("sketch")),
            "tile": F.pmod(F.xxhash64("short"), F.col("tiles")).cast("int"),
        }
    )
    kept = ["key", "short", "root", "n_shingles", "sketch", "shared", "tile"]
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = rows.select(*kept, other).select(*kept, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"))
    work = spread.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return work.mapInArrow(lambda batches: compared(batches, percent), "short long, other long")


def near_duplicates(
    docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the least id reachable by links) of every row.

    A text's set holds its distinct shingles of ``width`` words, or its whole shorter sequence; sets link when
    their Jaccard similarity is at least ``percent`` per cent. NULL, empty and blank texts have an empty set
    and stand alone under their own id. Rows with equal sets (copies, repeated rows) are one node. NULL ids
    do not name a component unless no other id is in it. An empty table gives no rows.
    """
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, width, percent, id_col, text_col)


def _near_duplicates(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-duplicates")
    rows = scratch.write(sketched(docs, width, percent, id_col, text_col), "sketches")
    short = _short("node").alias("short")
    filled = rows.where("n_shingles > 0").withColumn("pick", F.xxhash64("doc_id"))
    # One row stands for a set's copies; a filter of fixed size passes it, and now and then a copy, which does no harm.
    spot = F.xxhash64("node", "pick").alias("spot")
    alone = spark.sparkContext.broadcast(bitmap_of(filled.groupBy("node").agg(F.min("pick").alias("pick")).select(spot), "spot"))
    sketches = filled.select(short, spot, "keys", "lead", "next_keys", "next_lead")

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one = _standing(batch, alone.value)
            yield pa.record_batch([pa.concat_arrays([one.column("keys").flatten(), one.column("next_keys").flatten()])], ["key"])

    # How common each block is: combined before the shuffle.
    common = sketches.mapInArrow(flat, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    table = spark.sparkContext.broadcast(rarity_table(common, "key", "n"))
    leading = sketches.mapInArrow(
        lambda batches: leading_keys(table.value, (_standing(batch, alone.value) for batch in batches)),
        "key long, short long, own long, later boolean",
    )
    leading = scratch.write(leading.distinct(), "leading")
    # The centre of a bucket is its set with the fewest blocks of its own.
    rank = F.shiftleft("own", 48).bitwiseOR(_brief("short"))
    # Tables of one row per key are written before they are joined: Spark can split a hot key of a plain shuffle only.
    centres = leading.groupBy("key").agg(F.min(rank).alias("centre"), F.count(F.lit(1)).alias("members")).where("members > 1")
    centres = scratch.write(centres.select("key", "centre"), "centres")
    members = scratch.write(leading.join(centres, "key").withColumn("rank", rank), "members")
    counted = members.where("rank != centre").groupBy("short", "centre").agg(F.count(F.lit(1)).alias("n"))
    nearest = counted.groupBy("short").agg(F.max_by("centre", F.struct("n", "centre")).alias("most"), F.min("centre").alias("least"))
    brief = F.col("centre").bitwiseAND(F.lit((1 << 48) - 1)).alias("brief")
    first = nearest.select("short", F.explode(F.array_distinct(F.array("most", "least"))).alias("centre")).select("short", brief)
    first = scratch.write(first, "pairs")
    texts = scratch.write(candidate_texts(docs, bitmap_of(members.select("short").distinct(), "short"), width, text_col), "texts")
    edges = scratch.write(verified(first, texts, width, percent).where("a != b"), "links")
    # Then what shares a bucket across components.
    roots = connected_components(edges)
    groups = texts.select("short", "node").join(roots, "node", "left").select("short", F.coalesce("root", "node").alias("root"))
    groups = groups.withColumn("root", F.xxhash64("root"))
    labelled = scratch.write(members.select("key", "short", "later").join(groups, "short"), "labelled")
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    open_ = scratch.write(labelled.join(scratch.write(mixed, "mixed"), "key"), "open")
    wanted = spark.sparkContext.broadcast(bitmap_of(open_.select("short").distinct(), "short"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(wanted.value, batch.column("short").to_numpy().view(np.uint64))))

    whole = filled.select(short, "n_shingles", "sketch", "next_sketch")
    whole = whole.mapInArrow(chosen, whole.schema).distinct()
    across = pairs_across(open_, whole, percent, scratch).select("short", _brief("other").alias("brief")).distinct()
    across = scratch.write(across.join(first, ["short", "brief"], "left_anti"), "across")
    later = scratch.write(verified(across, texts, width, percent), "links")
    roots = connected_components(edges.union(later))
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(scratch.write(named, "names"), "root").select("node", "component_id")
    full = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "node").join(named, "node", "left")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return scratch.finish(full.select("doc_id", "n_shingles", "component_id").union(empty))
