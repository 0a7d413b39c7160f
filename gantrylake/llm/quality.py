"""Ordinal quality regression: shared hashed-text weights and ordered thresholds (cumulative links).

A document's score is the mean weight of its hashed features: words, word shapes and pairs of
neighbouring shapes. P(grade > k) = sigmoid(score - threshold k), with thresholds in order. The weights are fitted on
a bounded sample of graded rows; scoring reads every document once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import SPACE, SpanHash, blocks, mix, runs
from gantrylake.llm.rows import quoted, result_schema, unpacked, with_text
from gantrylake.llm.sampling import labelled_sample
from gantrylake.llm.scratch import Scratch

#: Hashed features, rows that a model is fitted on at most, and passes over them.
FEATURES = 1 << 16
SAMPLE = 8000
EPOCHS = 12
#: Byte classes: 0 other signs, 1 lower case, 2 upper case, 3 digits, 4 beyond ASCII; signs keep their code.
CLASSES = np.zeros(256, np.uint64)
CLASSES[33:127] = np.arange(33, 127)
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 4


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a block of texts, one after the other, and where each text's begin."""
    starts, ends, first = runs(~SPACE[data], offsets)
    words = SpanHash(data)(starts, ends)
    begins = np.zeros(len(words), bool)
    begins[first[:-1][first[:-1] < len(words)]] = True
    again = np.zeros(len(words), np.uint64)
    again[1:] = words[1:] == words[:-1]
    again[begins] = 0
    size = ends - starts
    second = np.where(size > 1, CLASSES[data[np.minimum(starts + 1, len(data) - 1)]] if len(data) else 0, 5)
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.uint64), 6)
    shape = CLASSES[data[starts]] if len(words) else np.zeros(0, np.uint64)
    for part in (second, CLASSES[data[ends - 1]] if len(words) else shape, length, again):
        shape = shape * np.uint64(256) + np.asarray(part, np.uint64)
    shape = mix(shape + np.uint64(1))
    before = np.zeros(len(words), np.uint64)
    before[1:] = shape[:-1]
    before[begins] = 0
    pair = mix(shape ^ (before << np.uint64(1)) ^ np.uint64(0x9999))
    out = np.empty((len(words), 3), np.int64)
    for n, values in enumerate((words, shape, pair)):
        out[:, n] = (values >> np.uint64(48)).astype(np.int64) & (FEATURES - 1)
    return out.ravel(), first * 3


@dataclass
class OrdinalModel:
    """Feature weights, ordered thresholds, and the grades between them."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def scores(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.weights[numbers])])
        counts = np.maximum(np.diff(first), 1)
        return (sums[first[1:]] - sums[first[:-1]]) / counts

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade above each threshold), a row per text."""
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(self.grades)


def fit_ordinal(numbers: list[np.ndarray], counts: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """Fits by AdaGrad on the cumulative-link likelihood; texts are (feature numbers, shares)."""
    kinds = np.unique(grades)
    if len(kinds) < 2:
        # One grade or none: nothing to tell apart, everything passes.
        only = float(kinds[0]) if len(kinds) else 0.0
        return OrdinalModel(np.zeros(FEATURES), np.array([-20.0]), np.array([only, only]))
    place = np.searchsorted(kinds, grades)
    above = np.array([(place > k).mean() for k in range(len(kinds) - 1)])
    base = -np.log(above / (1 - above))
    gaps = np.log(np.maximum(np.diff(base), 1e-3))
    first = base[0]
    weights, seen = np.zeros(FEATURES), np.full(FEATURES, 1e-8)
    bound_seen = np.full(len(kinds) - 1, 1e-8)
    balance = len(grades) / (len(kinds) * np.bincount(place))
    random = np.random.Generator(np.random.PCG64(5))
    for _ in range(EPOCHS):
        order = random.permutation(len(numbers))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            flat = np.concatenate([numbers[n] for n in batch])
            share = np.concatenate([counts[n] for n in batch])
            owner = np.repeat(np.arange(len(batch)), [len(numbers[n]) for n in batch])
            score = np.bincount(owner, share * weights[flat], minlength=len(batch))
            thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            up = 1 / (1 + np.exp(-(score[:, None] - thresholds)))
            full = np.concatenate([np.ones((len(batch), 1)), up, np.zeros((len(batch), 1))], axis=1)
            slope = full * (1 - full)
            rows, mine = np.arange(len(batch)), place[batch]
            chance = np.maximum(full[rows, mine] - full[rows, mine + 1], 1e-9)
            weight = balance[mine] / len(batch)
            lower, upper = slope[rows, mine] / chance * weight, slope[rows, mine + 1] / chance * weight
            # Down the gradient of the negative log likelihood.
            pull = upper - lower
            grad = np.bincount(flat, share * pull[owner], minlength=FEATURES)
            touched = np.flatnonzero(grad)
            grad = grad[touched] + 1e-5 * weights[touched]
            seen[touched] += grad**2
            weights[touched] -= 0.5 * grad / np.sqrt(seen[touched])
            bounds = np.zeros((len(batch), len(kinds) + 1))
            np.add.at(bounds, (rows, mine), lower)
            np.add.at(bounds, (rows, mine + 1), -upper)
            by_threshold = bounds[:, 1:-1].sum(0)
            tail = np.cumsum(by_threshold[::-1])[::-1]
            step = np.concatenate([[tail[0]], tail[1:] * np.exp(gaps)])
            bound_seen += step**2
            move = 0.1 * step / np.sqrt(bound_seen)
            first -= move[0]
            gaps = np.clip(gaps - move[1:], -7, 5)
    thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    return OrdinalModel(weights, thresholds, kinds.astype(float))


def fit_quality(docs: DataFrame, labels: DataFrame, grade: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """A model of the grades, from at most ``SAMPLE`` different graded rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                numbers, first = features(data, offsets)
                own, counts = [], []
                for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
                    found, times = np.unique(numbers[a:b], return_counts=True)
                    own.append(found.astype("<u4").tobytes())
                    counts.append((times / max(b - a, 1)).astype("<f4").tobytes())
                yield pa.record_batch(
                    [pa.array(own, pa.binary()), pa.array(counts, pa.binary()), rows.column("grade")], ["numbers", "shares", "grade"]
                )

    scratch = Scratch(docs.sparkSession, "grades")
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    known = labels.select(quoted(id_col).alias("id"), quoted(grade).cast("double").alias("label"))
    sample = labelled_sample(texts, known, SAMPLE, scratch).select("text", F.col("label").alias("grade"))
    rows = sample.mapInArrow(counted, "numbers binary, shares binary, grade double").toArrow().to_pydict()
    scratch.drop()
    # The order in which rows arrive must not change the model.
    order = sorted(range(len(rows["grade"])), key=lambda n: (rows["numbers"][n], rows["grade"][n]))
    numbers = [np.frombuffer(rows["numbers"][n], "<u4").astype(np.int64) for n in order]
    shares = [np.frombuffer(rows["shares"][n], "<f4").astype(float) for n in order]
    return fit_ordinal(numbers, shares, np.array([rows["grade"][n] for n in order]))


def grade_quality(
    docs: DataFrame,
    model: OrdinalModel,
    least: float = 0.5,
    text_col: str = "text",
    carry: list[str] | None = None,
    rejected: bool = True,
) -> DataFrame:
    """The carried columns, ``expected_grade``, ``tail`` (probability above the first grade) and ``accepted``.

    Accepted are documents with a tail of ``least`` or more; with ``rejected`` false only they are returned. A NULL,
    empty or blank text has the score 0. Rows are judged each by itself; an empty table gives no rows.
    """
    carry = carry or ["doc_id"]
    frame = with_text(docs, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                numbers, first = features(data, offsets)
                tails = shared.value.tails(shared.value.scores(numbers, first))
                good = tails[:, 0] >= least
                columns = [rows.column("row"), pa.array(shared.value.expected(tails)), pa.array(tails[:, 0]), pa.array(good)]
                out = pa.record_batch(columns, ["row", "expected_grade", "tail", "accepted"])
                yield out if rejected else out.filter(pa.array(good))

    schema = result_schema(frame, "expected_grade double, tail double, accepted boolean")
    return unpacked(frame.mapInArrow(graded, schema), carry, "expected_grade", "tail", "accepted")
