"""Texts of Arrow batches as numpy arrays: blocks of bounded size, runs of bytes, span hashes.

Tasks read Arrow batches and work on one block of whole texts at a time, so memory follows the block
(or the one longest text), not the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_SEED = 20240611
_CODES = np.random.Generator(np.random.PCG64(_SEED)).integers(1, 2**31 - 1, (2, 1 << 16), dtype=np.uint64)
_tables: dict[str, np.ndarray] = {}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the places where its texts begin; NULL is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    data = column.buffers()[2]
    view = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return view, offsets - first


def cuts(offsets: np.ndarray, budget: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold at most ``budget`` bytes together, or one text."""
    start, total = 0, len(offsets) - 1
    while start < total:
        end = int(np.searchsorted(offsets, offsets[start] + budget, side="right")) - 1
        end = min(max(end, start + 1), total)
        yield start, end
        start = end


def blocks(batch: pa.RecordBatch, text: str = "text", budget: int = BLOCK_BYTES) -> Iterator[tuple]:
    """(rows of the block as a batch, bytes, offsets) for blocks of whole texts."""
    data, offsets = text_buffers(batch.column(text))
    for start, end in cuts(offsets, budget):
        first = offsets[start]
        yield batch.slice(start, end - start), data[first : offsets[end]], offsets[start : end + 1] - first


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true bytes, none across texts, and where each text's runs begin."""
    inner = mask.copy()
    after = mask.copy()
    inner[1:] = mask[:-1]
    after[:-1] = mask[1:]
    full = offsets[:-1] < offsets[1:]
    inner[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(mask & ~inner)
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a finaliser without collisions)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


#: Span hashes are residues by this prime, in two lanes of their own bases. A sum of codes times powers of a
#: number modulo 2**64 would give equal hashes to unequal texts of regular form; a prime modulus does not.
PRIME = np.uint64((1 << 31) - 1)
_SHIFT = np.uint64(31)
_BASES = (0x2545F491, 0x5851F42D)


def folded(values: np.ndarray) -> np.ndarray:
    """Smaller values that are the same modulo ``PRIME``: below 2**32 for values below 2**62, below 2**34 for any."""
    high = values >> _SHIFT
    high += values & PRIME
    return high


def residue(values: np.ndarray) -> np.ndarray:
    """Values modulo ``PRIME``."""
    values = folded(folded(values))
    values[values >= PRIME] -= PRIME
    return values


def _powers(size: int, lane: int, down: bool = False) -> np.ndarray:
    name = f"{lane}{down}"
    table = _tables.get(name)
    if table is None or len(table) < size:
        prime = int(PRIME)
        base = pow(_BASES[lane], -1, prime) if down else _BASES[lane] % prime
        table = np.ones(1, np.uint64)
        while len(table) < max(size, 1 << 16):
            table = np.concatenate([table, residue(table * np.uint64(pow(base, len(table), prime)))])
        _tables[name] = table
    return table[:size]


class SpanHash:
    """64-bit hashes of any spans of one sequence, equal for equal content, after one pass over it.

    Two prefix sums of random codes times powers of a base, each modulo a prime. Symbols are small numbers, or
    64-bit hashes themselves. Unequal content of equal hash has a chance of about (length / 2**31) ** 2; where equality
    decides a result, content is compared as well (see :func:`content_ids`).
    """

    def __init__(self, symbols: np.ndarray) -> None:
        self.sums, self.back = [], []
        for lane in (0, 1):
            if symbols.dtype == np.uint64:
                codes = residue((mix(symbols + np.uint64(lane)) if lane else symbols) >> np.uint64(2 * lane) & np.uint64((1 << 62) - 1))
            else:
                codes = _CODES[lane][symbols]
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum(folded(codes * _powers(len(symbols), lane)), out=sums[1:])
            self.sums.append(sums)
            self.back.append(_powers(len(symbols) + 1, lane, True))

    def _joined(self, lanes: list[np.ndarray]) -> np.ndarray:
        return mix((lanes[0] << _SHIFT) | lanes[1])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._joined([residue(folded(sums[ends] - sums[starts]) * back[starts]) for sums, back in zip(self.sums, self.back, strict=True)])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width."""
        total = len(self.sums[0]) - width
        if total <= 0:
            return np.zeros(0, np.uint64)
        lanes = [residue(folded(sums[width:] - sums[:-width]) * back[:total]) for sums, back in zip(self.sums, self.back, strict=True)]
        return self._joined(lanes)


def content_ids(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of spans, equal exactly where their content is.

    Spans of one hash are compared with the first of them, symbol by symbol. Should any differ, all spans are numbered
    by their content itself.
    """
    _, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    like = first[ids]
    lengths = ends - starts
    other = np.flatnonzero(like != np.arange(len(ids)))
    own, its = lengths[other], lengths[like[other]]
    same = np.array_equal(own, its) and np.array_equal(
        symbols[ragged(starts[other], own)], symbols[ragged(starts[like[other]], its)]
    )
    if same:
        return ids
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(symbols[a:b].tobytes(), len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all members of spans, span after span."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def lookup_table(members: str | bytes) -> np.ndarray:
    """A table of 256 flags, true for the given single-byte characters."""
    table = np.zeros(256, bool)
    table[list(members.encode() if isinstance(members, str) else members)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = lookup_table(b" \t\n\x0b\x0c\r")
#: Digits, lower-case ASCII letters, and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


class HashIndex:
    """Finds 64-bit hashes among those added, many at a time (open addressing in arrays)."""

    def __init__(self, capacity: int) -> None:
        """``capacity`` members at most; the table has four places for each."""
        self.bits = max(8, int(capacity - 1).bit_length() + 2)
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.size = 0

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The value of each hash, or -1."""
        places = self._places(hashes)
        held = self.keys[places]
        out = np.where(held == hashes, self.values[places], np.int32(-1))
        open_ = np.flatnonzero((held != hashes) & (held != 0))
        while len(open_):
            places[open_] = (places[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[places[open_]]
            same = held == hashes[open_]
            out[open_[same]] = self.values[places[open_[same]]]
            open_ = open_[~same & (held != 0)]
        return out

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct, absent, non-zero hashes."""
        places = self._places(hashes)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[places[left]] == 0
            self.keys[places[left[free]]] = hashes[left[free]]
            won = self.keys[places[left]] == hashes[left]
            self.values[places[left[won]]] = values[left[won]]
            left = left[~won]
            places[left] = (places[left] + 1) & ((1 << self.bits) - 1)
        self.size += len(hashes)
