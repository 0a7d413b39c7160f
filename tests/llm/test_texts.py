"""Arrays, hashes and the operators that look at one text at a time, against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gantrylake.llm import arrays, bpe, language, quality, toxicity
from gantrylake.llm.decontaminate import contamination, hit_words
from gantrylake.llm.divergence import language_references, quality_rules
from gantrylake.llm.packing import pack_documents
from gantrylake.llm.queries import REGISTRY, tokenizer_path
from gantrylake.llm.token_counts import count_tokens

NO_ITEMS = "item_id long, text string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_blocks_hold_whole_texts():
    column = pa.array(["ab", None, "", "é", "x" * 50, "y"]).slice(1)
    data, offsets = arrays.text_buffers(column)
    assert data.tobytes().decode() == "é" + "x" * 50 + "y"
    assert offsets.tolist() == [0, 0, 0, 2, 52, 53]
    assert list(arrays.cuts(offsets, 10)) == [(0, 3), (3, 4), (4, 5)]


def test_runs_end_with_the_text():
    data, offsets = arrays.text_buffers(pa.array(["ab c", "d", "", " e"]))
    starts, ends, first = arrays.runs(~arrays.SPACE[data], offsets)
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"c", b"d", b"e"]
    assert first.tolist() == [0, 2, 3, 3, 4]


def test_equal_spans_have_equal_hashes():
    data = np.frombuffer(b"abcabcab", np.uint8)
    spans = arrays.SpanHash(data)
    assert spans(np.array([0, 1]), np.array([3, 4])).tolist() == spans(np.array([3, 4]), np.array([6, 7])).tolist()
    assert len(set(spans.windows(3).tolist())) == 3


def test_hash_index():
    index = arrays.HashIndex(1000)
    keys = arrays.mix(np.arange(1, 1001, dtype=np.uint64))
    index.add(keys, np.arange(1000, dtype=np.int32))
    assert index.find(keys).tolist() == list(range(1000))
    assert (index.find(arrays.mix(np.arange(5000, 6000, dtype=np.uint64))) == -1).all()


def test_encoder_equals_the_library():
    encoder = bpe.Encoder(tokenizer_path())
    generator = random.Random(3)
    signs = "aab st're'vell'd'm  \n\t\r\x0b\x1c\x85\xa0é1²½!.?''\"ßñ<|endoftext|> 中"
    texts = ["".join(generator.choice(signs) for _ in range(generator.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "  ", "a<|endoftext|>b", "'s", "'", " 's", "''s", "\n's", "x'sx", "'lla", "a \n b", "it's don't we'll"]
    want = [code.ids for code in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want
    assert encoder.counts(texts).tolist() == [len(ids) for ids in want]


def test_texts_of_more_pieces_than_are_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 64)
    encoder = bpe.Encoder(tokenizer_path())
    generator = random.Random(4)
    texts = [" ".join(str(generator.randrange(10**6)) for _ in range(count)) for count in (5, 64, 65, 1000)] + ["", "a 中 b", "1 2 3"]
    want = [code.ids for code in encoder.library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert encoder.counts(texts).tolist() == [len(ids) for ids in want]
        assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_every_plain_sign_is_split_as_the_library_does():
    split = bpe.Encoder(tokenizer_path()).library.pre_tokenizer.pre_tokenize_str
    for code in range(bpe.PLAIN):
        sign = chr(code)
        kind = [len(split(x + sign + x)) for x in ("a", "1", "!")]
        want = kind.index(1) if 1 in kind else bpe.SPACE
        assert bpe.KINDS[code] == (bpe.LETTER, bpe.NUMBER, bpe.OTHER, bpe.SPACE)[want if 1 in kind else 3]


def whole_ids(texts):
    library = bpe.Encoder(tokenizer_path()).library
    return {key: library.encode(text or "", add_special_tokens=False).ids for key, text in texts.items()}


def test_token_counts_and_cache(spark, documents, texts, tmp_path):
    ids = whole_ids(texts)
    cache = str(tmp_path / "cache")
    for _ in range(2):  # the second time everything is found
        got = count_tokens(documents, tokenizer_path(), cache).collect()
        assert {row.doc_id: row.n_tokens for row in got} == {key: len(own) for key, own in ids.items()}
        assert all(row.n_bytes == len((texts[row.doc_id] or "").encode()) for row in got)
        assert all(row.over_limit == (row.n_tokens > 512) for row in got)
        assert spark.read.parquet(cache).count() == len({text or "" for text in texts.values()})


def test_packing_round_trip(spark, documents, texts):
    ids = whole_ids(texts)
    pieces = REGISTRY["op8_pack_windows"]
    rows = pack_documents(documents, tokenizer_path()).collect()
    whole, windows = {}, {}
    for row in rows:
        own = np.frombuffer(row.ids, "<u4").tolist()
        assert len(own) == row.length
        whole.setdefault(row.doc_id, []).append((row.start, own))
        windows.setdefault(row.sequence_id, []).append((row.offset, row.length))
        assert row.doc_tokens == len(ids[row.doc_id]) + 1
    assert {key: sum((own for _, own in sorted(parts)), []) for key, parts in whole.items()} == {key: own + [1] for key, own in ids.items()}
    for sequence, parts in windows.items():
        parts.sort()
        assert [a for a, _ in parts] == [0, *itertools.accumulate(n for _, n in parts[:-1])]
        assert sum(n for _, n in parts) == 2048 or sequence == max(windows)
    sums = {(row.doc_id, row.start): row.ids_crc32 for row in pieces(spark, "/root/testdata/sf0.001").collect()}
    assert all(sums.get((row.doc_id, row.start), zlib.crc32(row.ids)) == zlib.crc32(row.ids) for row in rows)


def leaks(docs, items, width=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        words = pattern.findall(lower(text))
        size = min(width, len(words))
        for start in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[start : start + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words = pattern.findall(lower(text))
        hit, found = [False] * len(words), set()
        for size in {len(window) for window in windows}:
            for start in range(len(words) - size + 1):
                owners = windows.get(tuple(words[start : start + size]))
                if owners:
                    found |= owners
                    hit[start : start + size] = [True] * size
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), sum(hit), len(found), digest, any(hit)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark, sf_dir, texts):
    items = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = REGISTRY["op5_contamination"](spark, sf_dir).collect()
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(row[c] for c in columns) for row in got), key=str) == leaks(texts.items(), items)
    assert any(row.contaminated for row in got)


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_contamination_of_short_overlapping_and_shared_items(spark, monkeypatch, limit):
    from gantrylake.llm import decontaminate

    monkeypatch.setattr(decontaminate, "ITEM_BYTES", limit)  # several passes
    generator = random.Random(5)
    word = lambda: generator.choice("ab cd ef gh É1".split())
    items = [(n, " ".join(word() for _ in range(generator.choice([1, 2, 4, 10, 13])))) for n in range(30)]
    items += [(30, None), (31, " ... "), (32, items[3][1]), (3, items[3][1])]
    docs = [(n, "! ".join(word() for _ in range(generator.choice([0, 1, 5, 40])))) for n in range(60)] + [(60, None)]
    found = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, NO_ITEMS))
    got = found.select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("d"), (F.size("spans") > 0).alias("c")
    )
    assert sorted(map(tuple, got.collect()), key=str) == leaks(docs, items)


def base_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(words[n : n + 5]) for n in range(len(words) - 4))
    marks = [False] * len(words)
    for n in range(len(words) - 4):
        if windows[tuple(words[n : n + 5])] > 1:
            marks[n : n + 5] = [True] * 5
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, sum(marks), len(words) < 10 or 100 * sum(marks) > 20 * len(words))


def test_base_rules_equal_plain_python(spark, documents, texts, awkward):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    references = language_references(documents, "lang", "text")
    for row in quality_rules(documents, references).collect():
        assert tuple(row[c] for c in columns) == base_rules(texts[row.doc_id])
        assert not (row.base_failed and row.kept)
    rows = quality_rules(awkward, references, carry=["text"]).collect()
    assert [tuple(row[c] for c in columns) for row in rows] == [base_rules(row.text) for row in rows]


def test_clean_texts_stay_and_foreign_distributions_go(spark, sf_dir):
    rows = REGISTRY["op9_quality_rules"](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = rows.where("not base_failed").join(known, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share"))
    assert {row.quality: row.share for row in judged.collect()}[1] == 1.0
    references = language_references(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang", "text")
    odd = spark.createDataFrame([(1, " ".join(f"#{n}%&" for n in range(400)))], "doc_id long, text string")
    assert [row.kept for row in quality_rules(odd, references).collect()] == [False]


def test_divergence_is_jensen_shannon():
    from gantrylake.llm.divergence import divergence

    shares, other = np.array([[0.5, 0.5, 0.0], [0.0, 0.0, 1.0]]), np.array([0.5, 0.5, 0.0])
    assert divergence(shares, other).tolist() == [0.0, 1.0]


def test_forward_backward_equals_all_paths():
    generator = np.random.default_rng(0)
    for total in (1, 2, 5):
        scores, moves = generator.normal(size=(total, 3)), generator.normal(size=(3, 3))
        want = np.zeros((total, 3))
        for path in itertools.product(range(3), repeat=total):
            weight = np.exp(sum(scores[t, path[t]] for t in range(total)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            weight *= np.exp(moves)[:, path[0]].sum()
            for t in range(total):
                want[t, path[t]] += weight
        got = language.forward_backward(scores, np.array([0, total]), moves)
        assert np.allclose(got, want / want.sum(1, keepdims=True))


def test_stretches_change_nothing(monkeypatch):
    generator = np.random.default_rng(1)
    scores, moves, first = generator.normal(size=(500, 3)), generator.normal(size=(3, 3)), np.array([0, 0, 70, 71, 300, 500])
    cut = language.forward_backward(scores, first, moves)
    monkeypatch.setattr(language, "STRETCH", 1000)
    assert np.allclose(cut, language.forward_backward(scores, first, moves))


def test_words_of_mixed_text_are_labelled_apart(spark, documents):
    crf = language.learn_languages(documents, F.lit(True))
    by_lang = {row.lang: row.text for row in documents.where("n_chars > 400").groupBy("lang").agg(F.min("text").alias("text")).collect() if row.lang}
    one, two = sorted(by_lang)[:2]
    mixed = " ".join(by_lang[one].split()[:40] + by_lang[two].split()[:40])
    data, offsets = arrays.text_buffers(pa.array([mixed]))
    chance, _ = language.Tagger(crf).label(data, offsets)
    named = [crf.labels[n] for n in chance.argmax(1)]
    assert named[:30].count(one) >= 27 and named[-30:].count(two) >= 27


def test_language_on_held_out_documents(spark, sf_dir, documents):
    rows = REGISTRY["op3_word_languages"](spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(row.lang == row.lang_pred for row in rows) >= 0.97 * len(rows)
    assert all(0 <= row.score <= 1 for row in rows)


def test_quality_on_graded_documents(spark, sf_dir):
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = REGISTRY["op1_quality_grades"](spark, sf_dir).join(known, "doc_id").collect()
    assert sum(row.accepted == (row.quality == 1) for row in rows) >= 0.95 * len(rows)


def test_ordinal_thresholds_are_in_order():
    generator = np.random.default_rng(2)
    grades = np.repeat([0, 1, 2, 5], 60)
    numbers = [np.array([10 + n, 99]) for n in np.searchsorted([0, 1, 2, 5], grades)]
    order = generator.permutation(len(grades))
    model = quality.fit_ordinal([numbers[n] for n in order], [np.array([0.5, 0.5])] * len(order), grades[order])
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([0.5 * model.weights[10 + n] + 0.5 * model.weights[99] for n in range(4)]))
    assert (np.diff(model.expected(tails)) > 0).all()
    assert (np.diff(tails, axis=1) < 0).all()


def test_toxicity_finds_words_it_has_learned(spark):
    generator = random.Random(8)
    plain = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = []
    for n in range(400):
        words = [generator.choice(plain) for _ in range(30)]
        if n % 5 == 0:
            words[generator.randrange(30)] = "vilest" + generator.choice(["", "ing", "ed", "o"])
        rows.append((" ".join(words), int(n % 5 == 0), "en"))
    model = toxicity.fit_toxicity(rows)
    docs = spark.createDataFrame([(1, "alpha beta gamma vilestik delta"), (2, "alpha beta gamma delta"), (3, None)], "doc_id long, text string")
    got = {row.doc_id: row.predicted for row in toxicity.score_toxicity(docs, model).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("name", ["awkward", "nothing"])
def test_awkward_rows_have_defined_results(request, spark, documents, labels, name):
    docs = request.getfixturevalue(name)
    count = docs.count()
    extra = docs.columns
    model = quality.fit_quality(docs, labels)
    graded = quality.grade_quality(docs, model, carry=extra).collect()
    assert len(graded) == count and all(0 <= row.tail <= 1 for row in graded)
    crf = language.learn_languages(documents, F.lit(True))
    found = language.identify(docs, crf).collect()
    assert sorted(row.lang_pred == "und" for row in found) == sorted(not any(c.isalpha() for c in row.text or "") for row in docs.collect())
    empty = language.identify(docs, language.learn_languages(docs.limit(0), F.lit(True))).collect()
    assert all((row.lang_pred, row.score) == ("und", 0.0) for row in empty) and len(empty) == count
    scored = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, labels, F.lit(True))).collect()
    assert len(scored) == count and all(0 <= row.score <= 1 for row in scored)
    counted = count_tokens(docs, tokenizer_path()).collect()
    assert sorted(row.n_bytes for row in counted) == sorted(len((row.text or "").encode()) for row in docs.collect())
    packed = pack_documents(docs, tokenizer_path()).collect()
    assert sum(row.length for row in packed) == sum(row.n_tokens + 1 for row in counted)
    items = spark.createDataFrame([(1, "one two three"), (None, "many words"), (2, None)], NO_ITEMS)
    hit = contamination(docs, items, carry=extra).collect()
    assert sorted(row.items != [] for row in hit) == sorted(("one two three" in (row.text or "")) or ("many words" in (row.text or "")) for row in hit)
    assert all(row.spans == [] for row in contamination(docs, items.limit(0)).collect())
    assert quality_rules(docs, language_references(docs, "lang", "text")).count() == count
