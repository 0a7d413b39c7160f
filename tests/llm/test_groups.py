"""Operators that compare documents with each other, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gantrylake.llm import licences, parity_join, suffix_dedup
from gantrylake.llm.bitmap import bitmap_of, may_hold, rarity, rarity_table
from gantrylake.llm.components import connected_components
from gantrylake.llm.decontaminate import contamination
from gantrylake.llm.queries import REGISTRY


def word_sets(docs, width):
    out = {}
    for key, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        windows = [tuple(words[n : n + width]) for n in range(len(words) - width + 1)] if len(words) >= width else [tuple(words)] if words else []
        out[key] = frozenset(windows)
    return out


def groups(docs, width, percent):
    sets = word_sets(docs, width)
    least = {key: key for key in sets}

    def root(key):
        while least[key] != key:
            key = least[key]
        return key

    holders = {}
    for key in sorted(sets):
        shared = Counter(other for shingle in sets[key] for other in holders.get(shingle, ()))
        for other, common in shared.items():
            if 100 * common >= percent * (len(sets[key]) + len(sets[other]) - common):
                a, b = sorted((root(key), root(other)))
                least[b] = a
        for shingle in sets[key]:
            holders.setdefault(shingle, []).append(key)
    return {key: (len(sets[key]), root(key)) for key in sets}


def near_copies(seed, count):
    """Chains and stars of edited texts, unrelated texts and copies, short and long."""
    generator = random.Random(seed)
    texts = []
    while len(texts) < count:
        words = [f"w{generator.randrange(3000)}" for _ in range(generator.choice([1, 3, 4, 6, 12, 40, 150, 600]))]
        for _ in range(generator.choice([1, 1, 2, 8])):
            texts.append(" ".join(words))
            if generator.random() < 0.7:
                words = list(words)
                for _ in range(generator.choice([1, 1, 2, 3])):
                    words[generator.randrange(len(words))] = f"n{generator.randrange(10**6)}"
    return list(enumerate(texts[:count]))


def test_near_duplicates_on_the_tables(spark, sf_dir, texts):
    got = {row.doc_id: (row.n_shingles, row.component_id) for row in REGISTRY["op10_near_duplicates"](spark, sf_dir).collect()}
    assert got == groups(texts.items(), 4, 85)


@pytest.mark.parametrize("tile", [2048, 3])
def test_near_duplicates_on_chains_and_stars(spark, monkeypatch, tile):
    monkeypatch.setattr(parity_join, "TILE", tile)
    docs = near_copies(4, 260)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for width, percent in ((4, 85), (5, 80)):
        got = {row.doc_id: (row.n_shingles, row.component_id) for row in parity_join.near_duplicates(frame, width, percent).collect()}
        assert got == groups(docs, width, percent)


def test_sketch_blocks_of_linked_sets_meet():
    generator = np.random.default_rng(3)
    bands = parity_join.Bands(85)
    for size in (7, 30, 200, 1500):
        base = np.unique(generator.integers(1, 2**62, size, dtype=np.uint64))
        room = 15 * 2 * len(base) // 185 // 2
        other = np.unique(np.concatenate([base[room:], generator.integers(1, 2**62, room, dtype=np.uint64)]))
        members, first = np.concatenate([base, other]), np.array([0, len(base), len(base) + len(other)])
        for own, number, lead, keys, sketches in parity_join.sketch_keys(members, first, bands):
            if len(own) == 2 and number[0] == number[1]:
                one, two = set(keys[: number[0]].tolist()), set(keys[number[0] :].tolist())
                assert len(one & two) >= number[0] - (min(lead) - 1)
                apart = (np.frombuffer(sketches[0], np.uint8) ^ np.frombuffer(sketches[1], np.uint8))
                assert np.bitwise_count(apart).sum() <= 2 * room


def test_awkward_rows_have_groups(awkward, nothing):
    rows = parity_join.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert {row.component_id for row in rows if row.doc_id in (4, 10)} == {4}
    assert {row.component_id for row in rows if row.doc_id in (7, 8)} == {7}
    assert all(row.component_id == row.doc_id for row in rows if row.n_shingles == 0)
    assert [row.component_id for row in rows if row.doc_id is None and row.n_shingles] == [4]
    assert parity_join.near_duplicates(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(n, n + 1) for n in range(60)] + [(100, 101), (102, 101), (None, 5), (7, 7)]
    got = {row.node: row.root for row in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 0 for n in range(61)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filters_hold_every_key(spark):
    keys = np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 3000)
    frame = spark.createDataFrame([(int(key), n + 1) for n, key in enumerate(keys)], "key long, n long")
    assert may_hold(bitmap_of(frame, "key"), keys.view(np.uint64)).all()
    assert (rarity(rarity_table(frame, "key", "n"), keys.view(np.uint64)) > 0).all()


def cut_bytes(docs, length):
    bodies = {key: (text or "").encode() for key, text in docs}
    count = Counter(body[n : n + length] for body in bodies.values() for n in range(len(body) - length + 1))
    out = {}
    for key, body in bodies.items():
        gone = bytearray(len(body))
        for n in range(len(body) - length + 1):
            if count[body[n : n + length]] > 1:
                gone[n : n + length] = b"\1" * length
        kept = bytes(x for x, g in zip(body, gone) if not g)
        spans = sum(1 for n, g in enumerate(gone) if g and (n == 0 or not gone[n - 1]))
        out[key] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def digests(frame):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return {row.doc_id: tuple(row[c] for c in columns) for row in frame.collect()}


def query_columns(frame):
    from gantrylake.llm.decontaminate import hit_words

    return frame.select("doc_id", "n_bytes", hit_words().alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@pytest.mark.parametrize("members", [4096, 3])
def test_repeats_on_the_tables(spark, sf_dir, texts, monkeypatch, members):
    monkeypatch.setattr(suffix_dedup, "GROUP_UNITS", members)  # large groups are split
    assert digests(REGISTRY["op6_remove_repeats"](spark, sf_dir)) == cut_bytes(texts.items(), 200)


@pytest.mark.parametrize("members", [4096, 2])
def test_repeats_inside_and_across_texts(spark, monkeypatch, members):
    monkeypatch.setattr(suffix_dedup, "GROUP_UNITS", members)
    generator = random.Random(6)
    letters = lambda count: "".join(generator.choice("abcé ") for _ in range(count))
    hot = [letters(300) for _ in range(3)]
    docs = [(n, letters(generator.randrange(300)) + generator.choice(hot)[generator.randrange(90) :] + letters(generator.randrange(300))) for n in range(40)]
    docs += [(40, "x" * 900), (41, "ab" * 300), (42, hot[0] + hot[0]), (43, None), (44, ""), (45, docs[0][1]), (46, "short")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (200, 120):
        assert digests(query_columns(suffix_dedup.remove_repeats(frame, length))) == cut_bytes(docs, length)


def test_backward_extension_equals_counting():
    generator = random.Random(1)
    for trial in range(60):
        length = generator.choice([1, 2, 3, 5, 8, 20])
        bodies = ["".join(generator.choice("abc") for _ in range(generator.randint(0, 40))).encode() for _ in range(generator.randint(1, 6))]
        if trial % 2:
            bodies += [body[generator.randint(0, len(body)) :] + bodies[0] for body in bodies]
        count = Counter(body[n : n + length] for body in bodies for n in range(len(body) - length + 1))
        for body, flat in zip(bodies, suffix_dedup.repeated_strings(bodies, length)):
            got = [False] * max(len(body) - length + 1, 0)
            for first, end in zip(flat[::2], flat[1::2]):
                got[first:end] = [True] * (end - first)
            assert got == [count[body[n : n + length]] > 1 for n in range(len(body) - length + 1)]


def test_awkward_rows_are_cut(awkward, nothing):
    rows = suffix_dedup.remove_repeats(awkward, carry=awkward.columns, as_text=True).collect()
    assert len(rows) == awkward.count()
    assert all(row.kept == "" for row in rows if row.doc_id in (7, 8))
    assert all(row.kept == (row.text or "") for row in rows if len((row.text or "").encode()) < 200)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_partly_removed_characters_go_whole(spark):
    shared = "é" * 150
    docs = spark.createDataFrame([(1, "a" + shared), (2, "b" + shared + "x")], "doc_id long, text string")
    rows = {row.doc_id: row.kept for row in suffix_dedup.remove_repeats(docs, 201, as_text=True).collect()}
    assert all("�" not in kept for kept in rows.values())


NOTICES = {
    "apache": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "proprietary": "All rights reserved.",
}


def test_licences_of_the_tables(spark, sf_dir, texts):
    rows = REGISTRY["op2_licences"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        lines = (texts[row.doc_id] or "").split("\n")
        assert row.families == sorted({family for family, notice in NOTICES.items() if notice in lines})


def test_licence_scan_has_no_python_in_its_plan(spark, documents, awkward, nothing):
    model = licences.fit_licences(documents)
    plan = licences.scan_licences(documents, model)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert licences.scan_licences(awkward, model).count() == awkward.count()
    assert licences.scan_licences(nothing, model).count() == 0
    lines = ["You must renew the driving license of the car", "The copyright dispute was long", "Licensed under the BSD 3-Clause License, see below"]
    got = licences.classified(spark.createDataFrame([(line,) for line in lines], "paragraph string"), model).collect()
    assert {row.paragraph: (row.family if row.confirmed else None) for row in got} == dict(zip(lines, [None, None, "bsd"]))


def confirmed_families(spark, model, lines):
    rows = licences.classified(spark.createDataFrame([(line,) for line in lines], "paragraph string"), model).collect()
    assert all((row.families != []) == row.confirmed == (row.family in row.families) for row in rows)
    return {row.paragraph: row.families for row in rows}


MIT_TEXT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions:"
)
PROSE = "The results of the study can be found in the appendix, and the people of the town were free to use the land as they wished. "


def test_notices_are_confirmed_whatever_stands_beside_them(spark, documents):
    model = licences.fit_licences(documents)
    frames = [*licences.FRAMES, PROSE + "{} " + PROSE, 20 * PROSE + "{} " + 20 * PROSE]
    want = {frame.format(text): [family] for family, texts in licences.TEMPLATES.items() for text in texts for frame in frames}
    want |= {MIT_TEXT: ["mit"], "MIT License": ["mit"], "BSD License": ["bsd"]}
    plain = [PROSE, 20 * PROSE, "License", "Copyright", "The license fee is reserved for the public.", "any person", "can be found in the"]
    want |= {line: [] for line in plain}
    assert confirmed_families(spark, model, want) == want


def test_notices_without_a_cue_word_are_found(spark, documents):
    notices = {
        "GNU GPL, version 2": "gpl",
        "CC BY-SA 4.0": "cc-by-sa",
        "to any person obtaining a copy of this software and associated documentation files": "mit",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.": "proprietary",
        "public-domain": "public-domain",
        "All rights\nreserved": "proprietary",
    }
    texts = [PROSE + "\n" + notice + "\n" + PROSE for notice in notices] + [PROSE, "any person\ncan be found in the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(licences.scan_licences(docs, licences.fit_licences(documents)).collect())
    assert [row.licence for row in rows] == [*notices.values(), None, None]
    assert [row.cues for row in rows] == [1] * len(notices) + [0, 0]


def test_lines_that_are_looked_at_hold_every_template_gram(spark):
    triples = ["so " + row["gram"].replace(" ", ", ") + " it" for row in licences.template_grams(3)]
    short = [f" - {row['gram']}!" for size in (1, 2) for row in licences.template_grams(size)]
    held = spark.createDataFrame([(text,) for text in triples + short], "text string")
    assert held.where(~licences.candidate(F.col("text"))).collect() == []
    other = spark.createDataFrame([("the results were found",), ("any personal view",), ("my any person",)], "text string")
    assert other.where(licences.candidate(F.col("text"))).collect() == []


def test_pipeline_stages_keep_the_columns_and_take_effect(spark, sf_dir, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == documents.columns
        docs = out.cache()
        kept[name] = {row.doc_id: row.text for row in docs.collect()}
    accepted = kept["quality classifier"]
    alone = {key for key, (_, least) in groups(accepted.items(), 5, 80).items() if key == least}
    assert set(kept["n-gram Jaccard join"]) == alone
    cut = cut_bytes(kept["n-gram Jaccard join"].items(), 200)
    after = kept["suffix-array dedup"]
    assert set(after) == alone
    assert all(len(after[key].encode()) <= cut[key][0] - cut[key][1] for key in alone)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = kept["benchmark decontamination"]
    assert set(clean) < set(after)
    left = spark.createDataFrame(list(clean.items()), "doc_id long, text string")
    assert all(row.spans == [] for row in contamination(left, items).collect())
    assert all(row.quality for row in spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("doc_id").isin(list(clean))).collect())


def test_pipeline_on_awkward_rows(spark, awkward, nothing, sf_dir):
    whole = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (whole, whole.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir).cache()
            docs.count()
    spark.catalog.clearCache()
