"""Word-level language labels by a linear-chain conditional random field.

Each word has a score per language: the sum of weights of its hashed affixes, character trigrams and the word
itself (the lexicon feature). Learned transitions join neighbouring words, and forward-backward gives every word's
label probabilities, so a text that changes language has a label per word. A document's language is the label
with the largest share of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantrylake.llm.arrays import LOWER, HashIndex, SpanHash, blocks, mix, ragged, runs
from gantrylake.llm.rows import quoted, result_schema, unpacked, with_text
from gantrylake.llm.sampling import collected, sample_of
from gantrylake.llm.scratch import Scratch

#: Hashed features, labelled rows that are learned from at most, words of a training sequence, passes.
FEATURES = 1 << 15
SAMPLE = 2000
SEQUENCE = 64
EPOCHS = 2
#: Weight of the prior that keeps transitions small.
PRIOR = 1e-4
#: Words of a stretch that forward-backward takes in one step of its outer chain.
STRETCH = 32
#: Bytes of texts that are labelled together: the outer chain's steps serve more texts at once.
BLOCK = 2 << 20
#: Distinct words whose scores a worker remembers; then it starts afresh.
REMEMBERED = 1 << 19
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words (spans of lower-case bytes) and the word each belongs to."""
    spans = SpanHash(data)
    found, owners = [], []
    every = np.arange(len(starts))
    sizes = ends - starts
    for salt, (low, high) in enumerate(
        [(starts, ends), *((starts, np.minimum(starts + n, ends)) for n in (1, 2, 3)), *((np.maximum(ends - n, starts), ends) for n in (1, 2, 3, 4))]
    ):
        found.append(mix(spans(low, high) + np.uint64(salt * 7919)))
        owners.append(every)
    counts = np.maximum(sizes - 2, 0)
    at = ragged(starts, counts)
    found.append(mix(spans(at, at + 3) + np.uint64(104729)))
    owners.append(np.repeat(every, counts))
    return (np.concatenate(found) >> np.uint64(49)).astype(np.int64), np.concatenate(owners)


@dataclass
class Crf:
    """Languages, feature weights and transition scores."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Score of each word (row) for each language."""
        numbers, owner = word_features(data, starts, ends)
        out = np.empty((len(starts), len(self.labels)))
        for n in range(len(self.labels)):
            out[:, n] = np.bincount(owner, self.weights[numbers, n], minlength=len(starts))
        return out


def forward_backward(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of many sequences (``first``: where each begins).

    See :func:`messages` for how.
    """
    ahead, behind, _ = messages(scores, first, transitions)
    out = ahead * behind
    return out / out.sum(1, keepdims=True) if len(out) else out


def pair_chances(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities of every word, words that have one before them, and the probability of each pair of labels there."""
    ahead, behind, local = messages(scores, first, transitions)
    chance = ahead * behind
    chance /= np.maximum(chance.sum(1, keepdims=True), 1e-300)
    inside = np.ones(len(scores), bool)
    inside[first[:-1][np.diff(first) > 0]] = False
    later = np.flatnonzero(inside)
    move = np.exp(transitions - transitions.max())
    pairs = ahead[later - 1][:, :, None] * move[None] * (local * behind)[later][:, None, :]
    return chance, later, pairs / pairs.sum((1, 2), keepdims=True)


def messages(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward messages (each word's own score included), backward messages (without it), and the words' own factors.

    Before a sequence's first word stands one of unknown label, each label being as likely. Sequences are cut into stretches. Each stretch's product of transfer matrices carries messages over it
    in one step, so a very long text costs few steps more than a short one; then messages run
    inside all stretches at once.
    """
    count, labels = scores.shape
    move = np.exp(transitions - transitions.max())
    local = np.exp(scores - scores.max(1, keepdims=True)) if count else scores
    sizes = np.diff(first)
    pieces = -(-sizes // STRETCH)
    piece_first = np.concatenate([[0], np.cumsum(pieces)]).astype(np.int64)
    inner = np.arange(piece_first[-1]) - np.repeat(piece_first[:-1], pieces)
    begin = np.repeat(first[:-1], pieces) + inner * STRETCH
    length = np.minimum(STRETCH, np.repeat(first[1:], pieces) - begin)
    # Longest stretches first: those still running are a leading part.
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    running = [int(np.searchsorted(-length, -step, side="left")) for step in range(STRETCH)]
    carry = np.broadcast_to(np.eye(labels), (len(begin), labels, labels)).copy()
    for step in range(STRETCH):
        n = running[step]
        if n:
            part = (carry[:n].reshape(-1, labels) @ move).reshape(n, labels, labels) * local[begin[:n] + step][:, None, :]
            carry[:n] = part / part.sum((1, 2), keepdims=True)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    ahead, behind = np.empty((len(begin), labels)), np.empty((len(begin), labels))
    live = np.argsort(-pieces, kind="stable")
    depth = int(pieces.max()) if len(pieces) else 0
    active = [live[: int(np.searchsorted(-pieces[live], -k, side="left"))] for k in range(depth)]
    message = np.ones((len(sizes), labels)) / labels
    for k in range(depth):
        at = back[piece_first[active[k]] + k]
        ahead[at] = message[active[k]]
        moved = np.matmul(message[active[k]][:, None, :], carry[at])[:, 0, :]
        message[active[k]] = moved / moved.sum(1, keepdims=True)
    message = np.ones((len(sizes), labels))
    for k in reversed(range(depth)):
        at = back[piece_first[active[k]] + k]
        behind[at] = message[active[k]]
        moved = np.matmul(carry[at], message[active[k]][:, :, None])[:, :, 0]
        message[active[k]] = moved / moved.sum(1, keepdims=True)
    forward, backward = np.empty((count, labels)), np.empty((count, labels))
    for step in range(STRETCH):
        n = running[step]
        if n:
            part = (ahead[:n] @ move) * local[begin[:n] + step]
            ahead[:n] = part / part.sum(1, keepdims=True)
            forward[begin[:n] + step] = ahead[:n]
    for step in reversed(range(STRETCH)):
        n = running[step]
        if n:
            at = begin[:n] + step
            backward[at] = behind[:n]
            part = (behind[:n] * local[at]) @ move.T
            behind[:n] = part / part.sum(1, keepdims=True)
    return forward, backward, local


def fit_crf(texts: list[str], langs: list[str]) -> Crf:
    """Learns from whole texts of known language, cut and mixed into sequences that change language."""
    labels = sorted(set(langs))
    count = len(labels)
    weights, seen = np.zeros((FEATURES, max(count, 1))), np.full((FEATURES, max(count, 1)), 1e-6)
    transitions, moved = np.zeros((count, count)), np.full((count, count), 1e-6)
    if count < 2:
        return Crf(labels, weights, transitions)
    raw = [text.encode() for text in texts]
    offsets = np.concatenate([[0], np.cumsum([len(text) for text in raw])]).astype(np.int64)
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    starts, ends, first = runs(LETTER[data], offsets)
    truth = np.repeat([labels.index(lang) for lang in langs], np.diff(first)).astype(np.int64)
    random = np.random.Generator(np.random.PCG64(11))
    for _ in range(EPOCHS):
        # Spans of 8 to 40 words in random order: neighbours often differ in language, as in mixed text.
        spans = []
        for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
            while a < b:
                step = int(random.integers(8, 41))
                spans.append((a, min(a + step, b)))
                a += step
        order = random.permutation(len(spans))
        words = np.concatenate([np.arange(*spans[n]) for n in order]) if len(order) else np.zeros(0, np.int64)
        for at in range(0, len(words), 64 * SEQUENCE):
            batch = words[at : at + 64 * SEQUENCE]
            sizes = ends[batch] - starts[batch]
            upto = np.cumsum(sizes)
            numbers, owner = word_features(data[ragged(starts[batch], sizes)], upto - sizes, upto)
            scores = np.stack([np.bincount(owner, weights[numbers, n], minlength=len(batch)) for n in range(count)], 1)
            begins = np.append(np.arange(0, len(batch), SEQUENCE), len(batch))
            chance, _, pairs = pair_chances(scores, begins, transitions)
            right = truth[batch]
            wrong = chance.copy()
            wrong[np.arange(len(batch)), right] -= 1
            for n in range(count):
                slope = np.bincount(numbers, wrong[owner, n], minlength=FEATURES) / len(batch)
                slope += 1e-7 * weights[:, n]
                seen[:, n] += slope**2
                weights[:, n] -= 0.2 * slope / np.sqrt(seen[:, n])
            slope = transition_slope(chance, pairs, right, begins, transitions) / len(batch) + PRIOR * transitions
            moved += slope**2
            transitions -= 0.1 * slope / np.sqrt(moved)
    return Crf(labels, weights, transitions)


def transition_slope(chance: np.ndarray, pairs: np.ndarray, right: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The gradient of the negative log-likelihood: expected pairs of labels, by the model less by the right labels.

    The label before a sequence's first word is unknown under both.
    """
    begins = first[:-1][np.diff(first) > 0]
    inside = np.ones(len(right), bool)
    inside[begins] = False
    later = np.flatnonzero(inside)
    observed = np.zeros(pairs.shape[1:])
    np.add.at(observed, (right[later - 1], right[later]), 1)
    unknown = np.exp(transitions - transitions.max())
    unknown /= unknown.sum(0)
    return pairs.sum(0) - observed + unknown * (chance[begins].sum(0) - np.bincount(right[begins], minlength=len(unknown)))


class Tagger:
    """Scores of words as a worker meets them, each distinct word worked out once."""

    def __init__(self, crf: Crf) -> None:
        self.crf = crf
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex(REMEMBERED)
        self.table = np.zeros((1 << 12, max(1, len(self.crf.labels))))

    def word_scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = SpanHash(data)(starts, ends)
        slots = self.index.find(hashes)
        missed = np.flatnonzero(slots < 0)
        new, where = np.unique(hashes[missed], return_index=True)
        if self.index.size + len(new) > REMEMBERED:
            self._forget()
            new, where = np.unique(hashes, return_index=True)
            missed = np.arange(len(hashes))
            if len(new) > REMEMBERED:
                return self.crf.scores(data, starts, ends)
        if len(new):
            spots = missed[where]
            low = self.index.size
            if low + len(new) > len(self.table):
                self.table = np.resize(self.table, (2 * (low + len(new)), self.table.shape[1]))
            self.table[low : low + len(new)] = self.crf.scores(data, starts[spots], ends[spots])
            self.index.add(new, np.arange(low, low + len(new), dtype=np.int32))
            slots[missed] = self.index.find(hashes[missed])
        return self.table[slots]

    def label(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of all words, and where each text's words begin."""
        data = LOWER[data]
        starts, ends, first = runs(LETTER[data], offsets)
        return forward_backward(self.word_scores(data, starts, ends), first, self.crf.transitions), first


def learn_languages(docs: DataFrame, chosen: F.Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Crf:
    """A model from at most ``SAMPLE`` different rows among ``chosen`` that have a language, evenly over the languages."""
    known = docs.where(chosen & quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    picked = known.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession, "languages")
    rows = collected(sample_of(picked, SAMPLE, scratch, "lang"))
    scratch.drop()
    return fit_crf([row["text"] for row in rows], [row["lang"] for row in rows])


def identify(docs: DataFrame, crf: Crf, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns, ``lang_pred``, ``score`` (mean probability of that label over the words) and ``shares``.

    ``shares`` has the summed probabilities of all labels, in the order of ``crf.labels``. NULL and empty texts, texts
    without a letter, and all texts under a model without labels are ``und`` with score 0. Rows are judged
    each by itself; an empty table gives no rows.
    """
    carry = carry or ["doc_id"]
    frame = with_text(docs, text_col, carry)
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    labels = crf.labels

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            for rows, data, offsets in blocks(batch, budget=BLOCK):
                if labels:
                    chance, first = tagger.label(data, offsets)
                else:
                    chance, first = np.zeros((0, 1)), np.zeros(len(offsets), np.int64)
                words = np.diff(first)
                total = np.concatenate([np.zeros((1, chance.shape[1])), np.cumsum(chance, 0)])
                shares = total[first[1:]] - total[first[:-1]]
                best = shares.argmax(1)
                named = words > 0
                plain = np.add.reduceat(np.append(LETTER[data] & (data < 128), False), offsets[:-1]) > 0 if len(data) else named
                for n in np.flatnonzero(named & ~plain).tolist():  # no ASCII letter: look for any other
                    named[n] = any(sign.isalpha() for sign in rows.column("text")[n].as_py())
                score = np.where(named, shares[np.arange(len(best)), best] / np.maximum(words, 1), 0.0)
                yield pa.record_batch(
                    [
                        rows.column("row"),
                        pa.array([labels[b] if ok else "und" for b, ok in zip(best.tolist(), named.tolist(), strict=True)], pa.string()),
                        pa.array(np.clip(score, 0, 1)),
                        pa.array(shares.tolist(), pa.list_(pa.float64())),
                    ],
                    ["row", "lang_pred", "score", "shares"],
                )

    schema = result_schema(frame, "lang_pred string, score double, shares array<double>")
    return unpacked(frame.mapInArrow(tagged, schema), carry, "lang_pred", "score", "shares")
