"""Toxicity by a convolutional text classifier: hashed word embeddings, several filter widths, max pooling.

A word's embedding is the sum of the embeddings of its hashed forms: the word, its first four and five and its last
four bytes, so that inflected forms share what their stem has learned. Filters over one, two and three
neighbouring words are pooled to their maximum over the whole text. Thresholds are calibrated by language, where
the language is guessed from the text itself by word votes; the score is moved so that 0.5 is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import BLOCK_BYTES, LOWER, WORD, HashIndex, SpanHash, blocks, cuts, mix, ragged, runs, text_buffers
from gantrylake.llm.rows import quoted, result_schema, unpacked, with_text
from gantrylake.llm.sampling import collected, labelled_sample
from gantrylake.llm.scratch import Scratch

#: Hashed forms, embedding size, filters of each width, widths.
FORMS, SIZE, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
#: Labelled rows that are learned from at most, the share of them that calibrates, passes, rows of a step.
SAMPLE, CALIBRATION, EPOCHS, BATCH = 6000, 0.2, 4, 32
#: Hashed words that vote for a language.
VOTERS = 1 << 14
REMEMBERED = 1 << 19


def word_forms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The four form numbers of each word."""
    spans = SpanHash(data)
    shapes = [(starts, ends), (starts, np.minimum(starts + 4, ends)), (starts, np.minimum(starts + 5, ends)), (np.maximum(ends - 4, starts), ends)]
    return np.stack([(mix(spans(*shape) + np.uint64(n * 7919)) >> np.uint64(49)).astype(np.int64) for n, shape in enumerate(shapes)], 1)


@dataclass
class TextCnn:
    """All weights; ``filters[width]`` has one (SIZE, FILTERS) matrix per word of the filter."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    votes: np.ndarray = field(default_factory=lambda: np.zeros((VOTERS, 1), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))

    @classmethod
    def fresh(cls, seed: int) -> TextCnn:
        random = np.random.Generator(np.random.PCG64(seed))
        filters = {w: (random.normal(size=(w, SIZE, FILTERS)) / np.sqrt(w * SIZE)).astype(np.float32) for w in WIDTHS}
        biases = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        out = (random.normal(size=FILTERS * len(WIDTHS)) * 0.1).astype(np.float32)
        return cls((random.normal(size=(FORMS, SIZE)) * 0.1).astype(np.float32), filters, biases, out, 0.0)

    def pooled(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Pooled activations of each text, and where each maximum lies (the window's first word)."""
        texts, total = len(first) - 1, len(words)
        pooled = np.zeros((texts, FILTERS * len(WIDTHS)), np.float32)
        places = {}
        for n, width in enumerate(WIDTHS):
            counts = np.maximum(np.diff(first) - width + 1, 0)
            act = np.zeros((max(total - width + 1, 0), FILTERS), np.float32)
            for step in range(width if len(act) else 0):
                act += words[step : step + len(act)] @ self.filters[width][step]
            act += self.biases[width]
            full = np.flatnonzero(counts)
            places[width] = np.full((texts, FILTERS), -1, np.int64)
            if len(full):
                # Windows across the end of a text are left out by cutting there.
                cuts = np.empty(2 * len(full), np.int64)
                cuts[0::2], cuts[1::2] = first[full], first[full] + counts[full]
                inside = cuts[cuts < len(act)]
                most = np.maximum.reduceat(act, inside, axis=0)[0::2]
                pooled[full, n * FILTERS : (n + 1) * FILTERS] = np.maximum(most, 0)
                places[width] = (act, full, counts)
        return pooled, places

    def logits(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(words, first)[0] @ self.out + self.bias

    def guessed(self, voters: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The language with most votes of each text's words; a text without words takes the first."""
        total = np.concatenate([np.zeros((1, self.votes.shape[1])), np.cumsum(self.votes[voters], 0, dtype=np.float64)])
        return (total[first[1:]] - total[first[:-1]]).argmax(1)


def _step(model: TextCnn, forms: np.ndarray, first: np.ndarray, truth: np.ndarray, weight: np.ndarray, state: dict, rate: float) -> None:
    """One step of AdaGrad on the weighted logistic loss of a batch of texts."""
    words = model.embedding[forms].sum(1)
    pooled, places = model.pooled(words, first)
    chance = 1 / (1 + np.exp(-(pooled @ model.out + model.bias)))
    slope = ((chance - truth) * weight / len(truth)).astype(np.float32)

    def move(name: str, value: np.ndarray, grad: np.ndarray) -> None:
        seen = state.setdefault(name, np.full_like(value, 1e-6))
        seen += grad**2
        value -= rate * grad / np.sqrt(seen)

    back = slope[:, None] * model.out[None, :] * (pooled > 0)
    word_grad: dict[str, list[np.ndarray]] = {"at": [], "by": []}
    filter_grads = {}
    for n, width in enumerate(WIDTHS):
        grad = np.zeros_like(model.filters[width])
        bias_grad = np.zeros(FILTERS, np.float32)
        if isinstance(places[width], tuple):
            act, full, counts = places[width]
            for text, count in zip(full.tolist(), counts[full].tolist(), strict=True):
                pull = back[text, n * FILTERS : (n + 1) * FILTERS]
                live = np.flatnonzero(pull)
                if not len(live):
                    continue
                low = first[text]
                best = low + act[low : low + count][:, live].argmax(0)
                bias_grad[live] += pull[live]
                for step in range(width):
                    # Only the word at the maximum learns.
                    np.add.at(grad[step].T, live, words[best + step] * pull[live][:, None])
                    word_grad["at"].append(best + step)
                    word_grad["by"].append(model.filters[width][step][:, live].T * pull[live][:, None])
        filter_grads[width] = (grad, bias_grad)
    move("out", model.out, pooled.T @ slope)
    bias = np.array([model.bias], np.float32)
    move("bias", bias, np.array([slope.sum()], np.float32))
    model.bias = float(bias[0])
    for width, (grad, bias_grad) in filter_grads.items():
        move(f"filter{width}", model.filters[width], grad)
        move(f"bias{width}", model.biases[width], bias_grad)
    if word_grad["at"]:
        at, by = np.concatenate(word_grad["at"]), np.concatenate(word_grad["by"])
        rows, each = np.unique(forms[at].ravel(), return_inverse=True)
        grad = np.zeros((len(rows), SIZE), np.float32)
        np.add.at(grad, each, np.repeat(by, forms.shape[1], axis=0))
        seen = state.setdefault("embedding", np.full_like(model.embedding, 1e-6))
        seen[rows] += grad**2
        model.embedding[rows] -= rate * grad / np.sqrt(seen[rows])


def forms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Form numbers of all words, small and worked out block by block, and where each text's words begin."""
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    parts, counts = [np.zeros((0, 4), np.uint16)], [np.zeros(1, np.int64)]
    for low, high in cuts(offsets, BLOCK_BYTES):
        block = LOWER[data[offsets[low] : offsets[high]]]
        starts, ends, first = runs(WORD[block], offsets[low : high + 1] - offsets[low])
        parts.append(word_forms(block, starts, ends).astype(np.uint16))
        counts.append(np.diff(first))
    return np.concatenate(parts), np.cumsum(np.concatenate(counts))


def fit_toxicity(rows: list[tuple[str, int, str]]) -> TextCnn:
    """Learns from (text, label 0 or 1, language or '') rows; one part of them only calibrates."""
    model = TextCnn.fresh(23)
    if not rows:
        model.bias = -4.0
        return model
    forms, first = forms_of([text for text, _, _ in rows])
    truth = np.array([label for _, label, _ in rows], np.float32)
    random = np.random.Generator(np.random.PCG64(29))
    order = random.permutation(len(rows))
    held = order[: int(CALIBRATION * len(rows))] if len(rows) >= 50 else order
    used = order[len(held) :] if len(rows) >= 50 else order
    share = min(max(float(truth[used].mean()), 0.02), 0.98)
    model.bias = float(np.log(share / (1 - share)))
    state: dict = {}
    for epoch in range(EPOCHS):
        mixed = used[random.permutation(len(used))]
        for at in range(0, len(mixed), BATCH):
            batch = mixed[at : at + BATCH]
            sizes = np.diff(first)[batch]
            flat = ragged(first[:-1][batch], sizes)
            begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            weight = np.where(truth[batch] > 0, 0.5 / share, 0.5 / (1 - share))
            _step(model, forms[flat], begins, truth[batch], weight, state, 0.1 / (1 + epoch / 2))
    _calibrate(model, rows, forms, first, truth, held, used)
    return model


def _calibrate(model: TextCnn, rows: list, forms: np.ndarray, first: np.ndarray, truth: np.ndarray, held: np.ndarray, used: np.ndarray) -> None:
    langs = sorted({lang for _, _, lang in rows if lang}) or [""]
    counts = np.full((VOTERS, len(langs)), 0.5)
    voters = forms[:, 0] % VOTERS
    for n in used.tolist():
        if rows[n][2]:
            counts[:, langs.index(rows[n][2])] += np.bincount(voters[first[n] : first[n + 1]], minlength=VOTERS)
    chance = counts / counts.sum(0)
    model.votes = np.log(chance / chance.mean(1, keepdims=True)).astype(np.float32)
    sizes = np.diff(first)[held]
    flat = ragged(first[:-1][held], sizes)
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    logits = np.concatenate(
        [
            model.logits(model.embedding[forms[flat[begins[a] : begins[b]]]].sum(1), begins[a : b + 1] - begins[a])
            for a, b in ((k, min(k + 200, len(held))) for k in range(0, len(held), 200))
        ]
    )
    guess = model.guessed(voters[flat], begins)
    every = best_threshold(logits, truth[held])
    model.thresholds = np.full(len(langs), every)
    for n in range(len(langs)):
        mine = guess == n
        if min((truth[held][mine] > 0).sum(), (truth[held][mine] == 0).sum()) >= 10:
            model.thresholds[n] = best_threshold(logits[mine], truth[held][mine])


def best_threshold(logits: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the gap between neighbouring logits that gives the best F1; 0 without both labels."""
    if not (truth > 0).any() or not (truth == 0).any():
        return 0.0
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(truth[order] > 0)
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + hits[-1])
    at = int(f1.argmax())
    below = logits[order[at + 1]] if at + 1 < len(order) else logits[order[at]] - 1
    return float((logits[order[at]] + below) / 2)


class Scorer:
    """Word embeddings as a worker meets the words, each distinct word worked out once."""

    def __init__(self, model: TextCnn) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex(REMEMBERED)
        self.table = np.zeros((1 << 12, SIZE), np.float32)
        self.voters = np.zeros(1 << 12, np.int64)

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = SpanHash(data)(starts, ends)
        slots = self.index.find(hashes)
        missed = np.flatnonzero(slots < 0)
        new, where = np.unique(hashes[missed], return_index=True)
        if self.index.size + len(new) > REMEMBERED:
            self._forget()
            new, where = np.unique(hashes, return_index=True)
            missed = np.arange(len(hashes))
            if len(new) > REMEMBERED:
                forms = word_forms(data, starts, ends)
                return self.model.embedding[forms].sum(1), forms[:, 0] % VOTERS
        if len(new):
            spots = missed[where]
            low = self.index.size
            if low + len(new) > len(self.table):
                self.table = np.resize(self.table, (2 * (low + len(new)), SIZE))
                self.voters = np.resize(self.voters, 2 * (low + len(new)))
            forms = word_forms(data, starts[spots], ends[spots])
            self.table[low : low + len(new)] = self.model.embedding[forms].sum(1)
            self.voters[low : low + len(new)] = forms[:, 0] % VOTERS
            self.index.add(new, np.arange(low, low + len(new), dtype=np.int32))
            slots[missed] = self.index.find(hashes[missed])
        return self.table[slots], self.voters[slots]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        data = LOWER[data]
        starts, ends, first = runs(WORD[data], offsets)
        words, voters = self._words(data, starts, ends)
        moved = self.model.logits(words, first) - self.model.thresholds[self.model.guessed(voters, first)]
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, chosen: F.Column, label: str = "toxic", lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text"
) -> TextCnn:
    """A model from at most ``SAMPLE`` different labelled rows among ``chosen`` (a condition on the id)."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where(chosen).select(quoted(id_col).alias("id"), (quoted(label) > 0).cast("int").alias("label"))
    lang = F.coalesce(quoted(lang_col).cast("string"), F.lit("")).alias("lang")
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"), lang)
    rows = collected(labelled_sample(texts, known, SAMPLE, scratch).select("text", "label", "lang"))
    scratch.drop()
    return fit_toxicity([(row["text"], row["label"], row["lang"]) for row in rows])


def score_toxicity(docs: DataFrame, model: TextCnn, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns, ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    NULL, empty and wordless texts have the score of a text without any activation. Rows are judged each by
    itself; an empty table gives no rows. A model learned from no rows calls nothing toxic.
    """
    carry = carry or ["doc_id"]
    frame = with_text(docs, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for rows, data, offsets in blocks(batch):
                scores = scorer.scores(data, offsets)
                columns = [rows.column("row"), pa.array(scores.astype(float)), pa.array((scores >= 0.5).astype(np.int32))]
                yield pa.record_batch(columns, ["row", "score", "predicted"])

    return unpacked(frame.mapInArrow(scored, result_schema(frame, "score double, predicted int")), carry, "score", "predicted")
