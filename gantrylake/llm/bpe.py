"""Token ids by the ``tokenizers`` library, with each distinct pre-token encoded once per worker.

For a plain byte-level BPE the library first splits a text into letters, digits, white space and other
signs (with a leading blank and English contractions), then encodes each piece by itself. Here the split is
done on arrays and the library encodes only pieces that the worker has not met. Texts with characters
beyond ``PLAIN`` or with a special token's string, and all texts under other kinds of tokenizers, go to
the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

from gantrylake.llm.arrays import HashIndex, SpanHash, ragged

#: Code points below this are split here; above it the library splits.
PLAIN = 0x250
LETTER, NUMBER, SPACE, OTHER = range(4)
#: Pieces that a worker remembers at most; then it starts afresh.
REMEMBERED = 1 << 19
BEYOND = re.compile(f"[^\\x00-{chr(PLAIN - 1)}]")
WHITE = [*range(9, 14), 32, 0x85, 0xA0]


def _kinds() -> np.ndarray:
    kinds = np.full(PLAIN, OTHER, np.int8)
    for code in range(PLAIN):
        group = unicodedata.category(chr(code))[0]
        kinds[code] = SPACE if code in WHITE else LETTER if group == "L" else NUMBER if group == "N" else OTHER
    return kinds


KINDS = _kinds()


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the code points at which a pre-token begins."""
    total = len(codes)
    kinds = KINDS[codes]
    begins = np.zeros(total, bool)
    first = np.zeros(total + 1, bool)
    first[offsets[:-1]] = True
    first = first[:total]
    begins[1:] = kinds[1:] != kinds[:-1]
    begins |= first
    # The last white space before a word stands alone, or joins the word if it is a blank.
    words = np.flatnonzero(begins & ~first & (kinds != SPACE))
    words = words[kinds[words - 1] == SPACE]
    begins[words - 1] = True
    begins[words[codes[words - 1] == 32]] = False
    # An apostrophe that begins a piece takes s, t, m, d, re, ve or ll with it.
    marks = np.flatnonzero(begins & (codes == 39))
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    ends = np.concatenate([first, np.ones(4, bool)])
    one = np.where(ends[marks + 1], 0, padded[marks + 1])
    two = np.where(ends[marks + 2], 0, padded[marks + 2])
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    taken = single | double
    marks = marks[taken]
    begins[marks + 1] = False
    following = marks + 2 + double[taken]
    begins[following[following < total]] = True
    return begins


class Encoder:
    """Encodes lists of texts with one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        split = form.get("pre_tokenizer") or {}
        self.plain = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and form["model"].get("type") == "BPE"
            and not form["model"].get("dropout")
            and not any(form.get(part) for part in ("normalizer", "truncation", "padding"))
        )
        self.specials = [token["content"] for token in form.get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.index = HashIndex(REMEMBERED)
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0
        # The pieces themselves, as code points: a hash finds a piece, its content decides.
        self.kept = np.zeros(1 << 18, np.uint32)
        self.kept_starts = np.zeros(1 << 16, np.int64)
        self.kept_sizes = np.zeros(1 << 16, np.int64)
        self.kept_used = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [code.ids for code in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        for at in range(0, len(pieces), 5000):
            part = pieces[at : at + 5000]
            encoded = self._whole(part)
            lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths.sum()))
            content = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32)
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            slot = self.index.size
            need = slot + len(encoded)
            if need > len(self.starts):
                for name in ("starts", "lengths", "kept_starts", "kept_sizes"):
                    setattr(self, name, np.resize(getattr(self, name), 2 * need))
            if self.used + len(flat) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * (self.used + len(flat)))
            if self.kept_used + len(content) > len(self.kept):
                self.kept = np.resize(self.kept, 2 * (self.kept_used + len(content)))
            self.starts[slot:need] = self.used + np.cumsum(lengths) - lengths
            self.lengths[slot:need] = lengths
            self.ids[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            self.kept_starts[slot:need] = self.kept_used + np.cumsum(sizes) - sizes
            self.kept_sizes[slot:need] = sizes
            self.kept[self.kept_used : self.kept_used + len(content)] = content
            self.kept_used += len(content)
            self.index.add(hashes[at : at + 5000], np.arange(slot, need, dtype=np.int32))

    def _slots(self, joined: str, begins: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Slots of at most ``REMEMBERED`` pieces of a text; earlier slots may be forgotten."""
        slots = self.index.find(hashes)
        missed = np.flatnonzero(slots < 0)
        if self.index.size + len(missed) > REMEMBERED:
            self._forget()
            missed = np.arange(len(hashes))
        new, where = np.unique(hashes[missed], return_index=True)
        where = missed[where]
        spans = zip(begins[where].tolist(), ends[where].tolist(), strict=True)
        self._learn(new, [joined[a:b] for a, b in spans])
        slots[missed] = self.index.find(hashes[missed])
        return slots

    def _strangers(self, codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Pieces whose slot holds another piece of the same hash."""
        sizes = ends - begins
        wrong = sizes != self.kept_sizes[slots]
        alike = np.flatnonzero(~wrong)
        its = self.kept[ragged(self.kept_starts[slots[alike]], sizes[alike])]
        if len(alike) == len(sizes) and len(sizes):  # pieces follow one another without a gap
            own = codes[begins[0] : ends[-1]]
        else:
            own = codes[ragged(begins[alike], sizes[alike])]
        unequal = own != its
        if unequal.any():
            wrong[np.repeat(alike, sizes[alike])[unequal]] = True
        return np.flatnonzero(wrong)

    def _pieces(self, texts: list[str], with_ids: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all pieces of plain texts, their ids if wanted, and where each text's pieces begin.

        More pieces than a worker remembers are looked up in turns, so that a text of any length fits.
        """
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(text) for text in texts], out=offsets[1:])
        begins = np.flatnonzero(piece_starts(codes, offsets))
        ends = np.append(begins[1:], len(codes))
        hashes = SpanHash(codes)(begins, ends)
        lengths, ids = [], [np.zeros(0, np.uint32)]
        for at in range(0, len(begins), REMEMBERED):
            turn = slice(at, at + REMEMBERED)
            slots = self._slots(joined, begins[turn], ends[turn], hashes[turn])
            counts = self.lengths[slots]
            strangers = self._strangers(codes, begins[turn], ends[turn], slots)
            if not len(strangers):
                lengths.append(counts)
                if with_ids:
                    ids.append(self.ids[ragged(self.starts[slots], counts)])
                continue
            encoded = self._whole([joined[begins[at + n] : ends[at + n]] for n in strangers.tolist()])
            counts[strangers] = [len(own) for own in encoded]
            lengths.append(counts)
            if with_ids:
                apart = dict(zip(strangers.tolist(), encoded, strict=True))
                known = zip(self.starts[slots].tolist(), counts.tolist(), strict=True)
                ids += [np.array(apart[n], np.uint32) if n in apart else self.ids[a : a + size] for n, (a, size) in enumerate(known)]
        return np.concatenate(lengths), np.concatenate(ids), np.searchsorted(begins, offsets)

    def _simple(self, texts: list[str]) -> np.ndarray:
        if not self.plain:
            return np.zeros(len(texts), bool)
        kept = [bool(text) and not any(special in text for special in self.specials) for text in texts]
        return np.array([ok and not BEYOND.search(text) for ok, text in zip(kept, texts, strict=True)], bool)

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        simple = self._simple(texts)
        counts = np.zeros(len(texts), np.int64)
        own = [text for text, ok in zip(texts, simple, strict=True) if ok]
        if own:
            lengths, _, first = self._pieces(own, False)
            sums = np.zeros(len(lengths) + 1, np.int64)
            np.cumsum(lengths, out=sums[1:])
            counts[simple] = np.diff(sums[first])
        rest = [text for text, ok in zip(texts, simple, strict=True) if not ok]
        if rest:
            counts[~simple] = [len(ids) for ids in self._whole(rest)]
        return counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        simple = self._simple(texts)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        own = np.flatnonzero(simple)
        if len(own):
            lengths, ids, first = self._pieces([texts[n] for n in own], True)
            sums = np.zeros(len(lengths) + 1, np.int64)
            np.cumsum(lengths, out=sums[1:])
            bounds = sums[first].tolist()
            for n, a, b in zip(own.tolist(), bounds, bounds[1:], strict=False):
                out[n] = ids[a:b]
        rest = np.flatnonzero(~simple).tolist()
        for n, ids in zip(rest, self._whole([texts[n] for n in rest]) if rest else [], strict=True):
            out[n] = np.array(ids, np.uint32)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, so that what it remembers serves later tasks."""
    return Encoder(path)


def version_digest(path: str) -> str:
    """A digest of the tokenizer file and of the library that reads it."""
    import tokenizers

    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()
