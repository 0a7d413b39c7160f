"""Texts that a power-of-two hash cannot tell apart, and hashes that always agree."""

import numpy as np
import pyarrow as pa
import pytest

from gantrylake.llm import arrays, bpe, divergence, parity_join
from gantrylake.llm.arrays import SpanHash, content_ids, text_buffers
from gantrylake.llm.queries import tokenizer_path
from gantrylake.llm.token_counts import count_tokens

SIZES = [1024, 2048, 4096]


def thue_morse(size, letters="ab"):
    """A word and its complement: letter n is the parity of n's binary digits."""
    parity = [bin(n).count("1") % 2 for n in range(size)]
    return "".join(letters[p] for p in parity), "".join(letters[1 - p] for p in parity)


def pairs():
    for size in SIZES:
        yield thue_morse(size)
        one, two = thue_morse(size)
        yield " ".join(one), " ".join(two)


def library_counts(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    return [len(code.ids) for code in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("size", SIZES)
def test_span_hashes_differ(size):
    for one, two in (thue_morse(size), thue_morse(size, "xy")):
        codes = [np.frombuffer(text.encode(), np.uint8) for text in (one, two)]
        start, end = np.array([0]), np.array([size])
        assert SpanHash(codes[0])(start, end) != SpanHash(codes[1])(start, end)
        hashes = [SpanHash(np.array([7, 11], np.uint64)[(code == ord(one[0])).astype(int)])(start, end) for code in codes]
        assert hashes[0] != hashes[1]


def test_span_hashes_agree_wherever_content_does():
    random = np.random.default_rng(3)
    data = random.integers(97, 100, 5000).astype(np.uint8)
    spans = SpanHash(data)
    starts = random.integers(0, 4900, 20000)
    ends = starts + random.integers(0, 100, 20000)
    seen = {}
    for a, b, own in zip(starts.tolist(), ends.tolist(), spans(starts, ends).tolist(), strict=True):
        assert seen.setdefault(data[a:b].tobytes(), own) == own
    assert len(set(seen.values())) == len(seen)
    assert np.array_equal(spans.windows(7), spans(np.arange(4994), np.arange(4994) + 7))
    words = spans(np.arange(4990), np.arange(4990) + 2)
    over = SpanHash(words)
    assert np.array_equal(over.windows(3), over(np.arange(4988), np.arange(4988) + 3))


def test_content_decides_where_hashes_agree():
    data = np.frombuffer(b"abcabdabcab", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 0]), np.array([3, 6, 9, 11, 2])
    for hashes in (np.zeros(5, np.uint64), SpanHash(data)(starts, ends)):
        ids = content_ids(data, starts, ends, hashes).tolist()
        assert ids[0] == ids[2] and ids[3] == ids[4] and len(set(ids)) == 3
    assert len(content_ids(data, starts[:0], ends[:0], np.zeros(0, np.uint64))) == 0


class Agreeing(SpanHash):
    """Hashes that are all the same."""

    def __call__(self, starts, ends):
        return np.ones(len(starts), np.uint64)


def test_encoder_compares_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "SpanHash", Agreeing)
    texts = ["one two three one", "a longer text, with 12 signs!", "", "one"]
    encoder = bpe.Encoder(tokenizer_path())
    assert encoder.counts(texts).tolist() == library_counts(texts)
    whole = [code.ids for code in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole


def test_encoder_on_regular_words_in_both_orders():
    for one, two in pairs():
        for texts in ([one, two], [two, one]):
            encoder = bpe.Encoder(tokenizer_path())
            assert encoder.counts(texts).tolist() == library_counts(texts)
            whole = [code.ids for code in encoder.library.encode_batch(texts, add_special_tokens=False)]
            assert [ids.tolist() for ids in encoder.encode(texts)] == whole


def test_token_counts_of_regular_words(spark):
    texts = [text for pair in pairs() for text in pair]
    for order in (texts, texts[::-1]):
        rows = count_tokens(spark.createDataFrame(list(enumerate(order)), "doc_id long, text string").coalesce(1), tokenizer_path()).collect()
        assert [r.n_tokens for r in sorted(rows)] == library_counts(order)


def figures(text):
    return divergence.base_figures(*text_buffers(pa.array([text])))


@pytest.mark.parametrize("hashing", [SpanHash, Agreeing])
def test_lines_and_windows_are_compared(monkeypatch, hashing):
    monkeypatch.setattr(divergence, "SpanHash", hashing)
    one, two = thue_morse(1024)
    assert figures(f"{one}\n{two}\n").lines.tolist() == [0]
    assert figures(f"{one}\n{two}\n{one}\n \n \n").lines.tolist() == [1]
    assert figures(f"v w x y {one} v w x y {two}").repeats.tolist() == [0]
    assert figures(f"v w x y {one} z v w x y {one}").repeats.tolist() == [10]


@pytest.mark.parametrize("hashing", [SpanHash, Agreeing])
def test_shingles_are_compared_word_by_word(monkeypatch, hashing):
    monkeypatch.setattr(parity_join, "SpanHash", hashing)
    one, two = thue_morse(1024)
    texts = [f"one two {one} four", f"one two {two} four", f"ONE two {one}  four", "a b", "a b c d e a b c d e"]
    members, first = parity_join.shingle_sets(*text_buffers(pa.array(texts)), 4, exact=True)
    sets = [set(members[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    assert sets[0] == sets[2] and not sets[0] & sets[1] and [len(own) for own in sets] == [1, 1, 1, 1, 5]


def test_near_duplicates_of_regular_words(spark):
    one, two = thue_morse(1024)
    texts = [f"one two {one} four", f"one two {two} four", one, two, " ".join(thue_morse(2048)[0]), " ".join(thue_morse(2048, "xy")[0])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in parity_join.near_duplicates(docs).collect()} == {n: n for n in range(6)}


def test_bases_give_long_periods():
    assert len(set(arrays._powers(1 << 16, 0).tolist())) == len(set(arrays._powers(1 << 16, 1).tolist())) == 1 << 16
