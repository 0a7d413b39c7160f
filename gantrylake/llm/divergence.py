"""Quality rules by distribution: how far a text's characters and common words lie from a language's.

The first pass counts, over all documents that pass the base rules, the character classes and hashed
words of each language. The second compares every document's two histograms with each language's by
Jensen-Shannon distance and keeps the nearest. A histogram is judged only on texts long enough to have one, and
the limit leaves room for the distance that chance alone gives a text of that length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import LOWER, SPACE, SpanHash, blocks, content_ids, lookup_table, ragged, runs
from gantrylake.llm.rows import quoted, result_schema, unpacked

SYMBOLS = lookup_table("#*$%&|<>")
#: Character classes: lower case, upper case, digits, beyond ASCII, blank, line end, then single signs and the rest.
CLASS_COUNT = 12
CLASS_OF = np.full(256, 11, np.int64)
CLASS_OF[97:123], CLASS_OF[65:91], CLASS_OF[48:58], CLASS_OF[192:] = 0, 1, 2, 3
CLASS_OF[[32, 9]], CLASS_OF[[10, 11, 12, 13]] = 4, 5
CLASS_OF[list(b".,;:?'\"()-")] = 6
CLASS_OF[ord("!")], CLASS_OF[ord("|")] = 7, 8
CLASS_OF[list(b"#*$%&<>")], CLASS_OF[list(b"/@_=+~^\\{}[]`")] = 9, 10
CLASS_OF[128:192] = -1  # later bytes of a character
#: Hashed words that are counted, and the most common of them that make a language's histogram.
BUCKETS, COMMON = 1 << 12, 64
#: Least lengths for a verdict, in characters and words.
LEAST_CHARS, LEAST_WORDS = 400, 50
#: Largest divergence (bits) beyond what chance gives; chance gives about (cells - 1) / (8 ln 2 n) for n draws.
CLASS_LIMIT, WORD_LIMIT, CHANCE = 0.07, 0.18, 0.6


@dataclass
class Base:
    """Base figures and histograms of a block of texts."""

    words: np.ndarray
    chars: np.ndarray
    symbols: np.ndarray
    lines: np.ndarray
    repeats: np.ndarray
    classes: np.ndarray
    bucket: np.ndarray
    first: np.ndarray

    @property
    def failed(self) -> np.ndarray:
        return (self.words < 10) | (100 * self.repeats > 20 * self.words)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def base_figures(data: np.ndarray, offsets: np.ndarray) -> Base:
    """The base rules' figures of every text, and its histograms."""
    texts = len(offsets) - 1
    starts, ends, first = runs(~SPACE[data], offsets)
    heads = (data & 0xC0) != 0x80
    spans = SpanHash(data)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    kind = CLASS_OF[data]
    classes = np.bincount(owner * (CLASS_COUNT + 1) + kind + 1, minlength=texts * (CLASS_COUNT + 1))
    # Lines with a word that equal an earlier one of the text.
    line_starts, line_ends, line_first = runs(data != 10, offsets)
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    same_lines = content_ids(data, line_starts, line_ends, spans(line_starts, line_ends))
    lines = np.zeros(texts, np.int64)
    bounds = line_first.tolist()
    # Words inside windows of five that the text holds twice.
    hashes = spans(starts, ends)
    words = content_ids(data, starts, ends, hashes)
    counts = np.maximum(np.diff(first) - 4, 0)
    at = ragged(first[:-1], counts)
    windows = content_ids(words, at, at + 5, SpanHash(hashes)(at, at + 5))
    window_bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
    twice = np.zeros(len(windows), bool)
    for n in range(texts):
        own = same_lines[bounds[n] : bounds[n + 1]][worded[bounds[n] : bounds[n + 1]]]
        lines[n] = len(own) - len(np.unique(own)) if len(own) > 1 else 0
        a, b = window_bounds[n], window_bounds[n + 1]
        if b - a > 1:
            order = np.argsort(windows[a:b])
            ordered = windows[a:b][order]
            same = ordered[1:] == ordered[:-1]
            twice[a + order[1:][same]] = True
            twice[a + order[:-1][same]] = True
    marks = np.zeros(len(words) + 1, np.int64)
    repeated = at[twice]
    np.add.at(marks, repeated, 1)
    np.add.at(marks, repeated + 5, -1)
    inside = np.cumsum(marks[:-1]) > 0
    lower = SpanHash(LOWER[data])(starts, ends)
    return Base(
        np.diff(first),
        _sums(heads & ~SPACE[data], offsets),
        _sums(SYMBOLS[data], offsets),
        lines,
        _sums(inside, first),
        classes.reshape(texts, CLASS_COUNT + 1)[:, 1:],
        (lower >> np.uint64(64 - 12)).astype(np.int64),
        first,
    )


@dataclass
class References:
    """Histograms of each language: character classes, and common hashed words with the rest as one cell."""

    classes: np.ndarray
    words: np.ndarray
    place: np.ndarray


def language_references(docs: DataFrame, lang_col: str, text_col: str) -> References:
    """Counts over all documents that pass the base rules and have a language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                base = base_figures(data, offsets)
                langs = np.array(rows.column("lang").to_pylist(), object)
                good = ~base.failed
                for lang in set(langs[good].tolist()):
                    mine = good & (langs == lang)
                    total = totals.setdefault(lang, np.zeros(CLASS_COUNT + BUCKETS, np.int64))
                    total[:CLASS_COUNT] += base.classes[mine].sum(0)
                    chosen = np.repeat(mine, np.diff(base.first))
                    total[CLASS_COUNT:] += np.bincount(base.bucket[chosen], minlength=BUCKETS)
        for lang, total in totals.items():
            cells = np.flatnonzero(total)
            columns = [pa.array([lang] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(total[cells])]
            yield pa.record_batch(columns, ["lang", "cell", "n"])

    selected = docs.where(quoted(lang_col).isNotNull()).select(
        quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text")
    )
    sums = selected.mapInArrow(counted, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    by_lang: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():  # a fixed number of cells per language
        by_lang.setdefault(row["lang"], np.zeros(CLASS_COUNT + BUCKETS))[row["cell"]] = row["n"]
    tables = [by_lang[lang] for lang in sorted(by_lang)]
    place = np.full((len(tables), BUCKETS), COMMON, np.int64)
    classes, words = np.zeros((len(tables), CLASS_COUNT)), np.zeros((len(tables), COMMON + 1))
    for n, cells in enumerate(tables):
        classes[n] = cells[:CLASS_COUNT] / max(cells[:CLASS_COUNT].sum(), 1)
        counts = cells[CLASS_COUNT:]
        top = np.argsort(-counts, kind="stable")[:COMMON]
        place[n, top] = np.arange(COMMON)
        words[n] = np.bincount(place[n], counts, COMMON + 1) / max(counts.sum(), 1)
    return References(classes, words, place)


def divergence(shares: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of each row from one distribution."""
    middle = (shares + reference) / 2

    def part(values: np.ndarray) -> np.ndarray:
        ratio = np.divide(values, middle, out=np.ones_like(middle), where=(values > 0) & (middle > 0))
        return (values * np.log2(ratio)).sum(1)

    return (part(shares) + part(np.broadcast_to(reference, shares.shape))) / 2


def judged(base: Base, references: References) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class and word distance (square root of the divergence) to the nearest language, and the verdict."""
    texts = len(base.words)
    chars = base.classes.sum(1)
    best = np.full(texts, np.inf)
    class_div, word_div = np.zeros(texts), np.zeros(texts)
    owner = np.repeat(np.arange(texts), base.words)
    class_room = CLASS_LIMIT + CHANCE * (CLASS_COUNT - 1) / (8 * np.log(2) * np.maximum(chars, 1))
    word_room = WORD_LIMIT + CHANCE * COMMON / (8 * np.log(2) * np.maximum(base.words, 1))
    class_judged, word_judged = chars >= LEAST_CHARS, base.words >= LEAST_WORDS
    for n in range(len(references.classes)):
        by_class = divergence(base.classes / np.maximum(chars, 1)[:, None], references.classes[n])
        cells = np.bincount(owner * (COMMON + 1) + references.place[n][base.bucket], minlength=texts * (COMMON + 1))
        by_word = divergence(cells.reshape(texts, -1) / np.maximum(base.words, 1)[:, None], references.words[n])
        over = np.maximum(by_class / class_room * class_judged, by_word / word_room * word_judged)
        nearer = over < best
        best[nearer], class_div[nearer], word_div[nearer] = over[nearer], by_class[nearer], by_word[nearer]
    return np.sqrt(np.maximum(class_div, 0)), np.sqrt(np.maximum(word_div, 0)), (best <= 1) | np.isinf(best)


def quality_rules(
    docs: DataFrame, references: References, text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """The carried columns, the base figures, both distances, ``base_failed`` and ``kept`` of every row.

    NULL, empty and blank texts have no words and fail the base rules. Texts below the least lengths are not
    judged by a histogram; without any reference (an empty table, no language known) none is. Repeated rows
    are judged each.
    """
    carry = carry or ["doc_id"]
    frame = docs.select(F.struct(*[quoted(name) for name in carry]).alias("row"), quoted(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(references)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                base = base_figures(data, offsets)
                by_class, by_word, good = judged(base, shared.value)
                figures = [base.words, base.chars, base.symbols, base.lines, base.repeats, by_class, by_word]
                verdicts = [pa.array(base.failed), pa.array(good & ~base.failed)]
                yield pa.record_batch(
                    [rows.column("row"), *map(pa.array, figures), *verdicts], ["row", *names, "base_failed", "kept"]
                )

    kinds = [f"{name} {'double' if name.endswith('distance') else 'long'}" for name in names]
    schema = result_schema(frame, ", ".join([*kinds, "base_failed boolean", "kept boolean"]))
    return unpacked(frame.mapInArrow(ruled, schema), carry, *names, "base_failed", "kept")
